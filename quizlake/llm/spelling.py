"""Spelling variants of a vocabulary by search schemes over FM-indexes.

Two words are *near* if they differ by exactly one inserted, deleted or replaced
code point.  The form of a word is its near word of the largest count, if that is
at least ``RATIO`` times its own (ties: the smallest in code-point order).  Forms
are followed to the last one, the root: counts grow tenfold a step, so
pointer doubling ends after a few joins.

Search.  One error leaves the first or the second half of a word as it is (half:
``length // 2`` code points, the second takes the odd one).  So a near word either
begins with the first half or ends with the second.  Words are dealt twice, by
their first HEAD and by their last TAIL code points, which are parts of these
halves; words that are near meet in one of the two.  Each unit is an index and a
query set at once:

1. Its words, delimited, form one text.  The bidirectional FM-index holds the
   Burrows-Wheeler transforms of the text and of its reverse as wavelet matrices.
   An extension by one letter to either side keeps the suffix-rank intervals of both.
2. A query matches one half exactly, letter by letter, then the delimiter at its
   outer end, and extends across the other half with one error allowed: a letter
   replaced, added or left out.  Branches are tried only for letters that occur in
   the interval, and after the error only exact extensions follow.  All queries of
   a unit advance together, one letter at a time.
3. Words found by the first half are left out of the search by the second one, so
   each near pair is counted once.

Memory and skew: units are packed to about UNIT words.  A key with more words than
that is dealt anew by exact halves (a near word is listed under the two half lengths
that a query can have); what is still larger is split into blocks of about UNIT, and its
queries visit each block.  Units return one row a query, never pairs.  Words count
once in a vocabulary, so frequent words weigh nothing here; counting is combined
within tasks before the shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quizlake.llm.common import spread
from quizlake.sources.storage import drop, settle

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, RATIO, ERRORS = 7, 2, 10, 31
HEAD, TAIL, UNIT = 3, 4, 20_000
FLUSH = 200_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


# -- the vocabulary ------------------------------------------------------------------------


def written(doc_id: int | None, run: str) -> str:
    """The lower-cased run as it counts in this document."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % ERRORS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of whole texts.  Null texts have none; a null id
    counts as empty text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            ids = [None if pd.isna(d) else int(d) for d in frame["d"]]
            for d, text in zip(ids, frame["x"], strict=True):
                for w, n in Counter(RUN.findall(text or "")).items():
                    # a shorter run gives no word: it is neither hashed nor counted
                    if len(w) >= LEAST_LENGTH and len(w := written(d, w.translate(_LOWER))) >= LEAST_LENGTH:
                        total[w] += n
                if len(total) > FLUSH:
                    yield pd.DataFrame({"word": total.keys(), "n": total.values()})
                    total = Counter()
        if total:
            yield pd.DataFrame({"word": total.keys(), "n": total.values()})

    rows = docs.select(F.col("doc_id").cast("long").alias("d"), F.col("text").alias("x"))
    counts = rows.mapInPandas(run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# -- the index -----------------------------------------------------------------------------


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of the sorted rotations, by prefix doubling."""
    n, rank, step = len(text), text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank, step = new, step * 2
        if int(rank.max()) == n - 1 or step >= 2 * n:
            return order


class Wavelet:
    """Ranks of symbols below given places, by one bit of the symbols a level."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        level = symbols
        for b in range(bits - 1, -1, -1):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(len(level) - bit.sum()))
            level = np.concatenate([level[bit == 0], level[bit == 1]])
        size = 1 << bits
        every, nothing = np.arange(size), np.zeros(size, np.int64)
        self.begin = np.zeros(size, np.int64)
        self.begin = self._descend(every, nothing, nothing)[0]

    def _descend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(symbol), np.int64)
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros, strict=True):
            low1, high1 = ones[low], ones[high]
            low0, high0 = low - low1, high - high1
            right = (symbol >> b) & 1 == 1
            less += np.where(right, high0 - low0, 0)
            low, high = np.where(right, zeros + low1, low0), np.where(right, zeros + high1, high0)
        return low, high, less

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often ``symbol`` stands before ``low`` and between ``low`` and
        ``high``, and how many smaller symbols stand between them."""
        start, end, less = self._descend(symbol, low, high)
        return start - self.begin[symbol], end - start, less


class Index:
    """Bidirectional FM-index of distinct words; symbol 0 delimits them.  An
    interval is (low among the rotations, low among those of the reverse, size)."""

    def __init__(self, words: list[str]):
        text = np.array([ord(c) for c in "\0".join([*words, ""])], dtype=np.int64)
        self.letters, symbols = np.unique(text, return_inverse=True)
        self.bits = len(self.letters).bit_length()  # one number more, for letters that no word has
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(self.letters)))])
        self.n = len(text)
        self.before, self.trees = [], []
        for t in (symbols, symbols[::-1]):
            order = suffix_order(t)
            last = t[order - 1]
            self.before.append(last)
            self.trees.append(Wavelet(last, self.bits))
            if len(self.trees) == 1:
                # the word that follows each delimiter, by rank of the delimiter's rotation
                starts = np.flatnonzero(symbols == 0)
                rank = np.empty(self.n, np.int64)
                rank[order] = np.arange(self.n)
                self.follows = np.empty(len(words), np.int64)
                self.follows[rank[starts]] = (np.arange(len(words)) + 1) % len(words)

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text whose letters all occur in the words."""
        return np.searchsorted(self.letters, np.array([ord(c) for c in text], dtype=np.int64))

    def whole(self, n: int) -> np.ndarray:
        return np.stack([np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n, np.int64)])

    def extend(self, states: np.ndarray, symbol: np.ndarray, side: int) -> np.ndarray:
        """Intervals (3 x states) with one more letter at side 0 (left) or 1 (right)."""
        own, other, size = states[side], states[1 - side], states[2]
        start, found, less = self.trees[side].ranks(symbol, own, own + size)
        out = np.empty_like(states)
        out[side], out[1 - side], out[2] = self.first[symbol] + start, other + less, found
        return out

    def branches(self, states: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) for each letter that can extend a state at ``side``."""
        width, size = len(self.letters), states[2]
        small = np.flatnonzero(size <= 2 * width)
        many = size[small]
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(states[side][small] - ends + many, many)
        near = np.unique(np.repeat(small, many) * width + self.before[side][at])
        large = np.flatnonzero(size > 2 * width)
        every = (large[:, None] * width + np.arange(width)).ravel()
        found = np.concatenate([near, every])
        found = found[found % width != 0]
        return found // width, found % width


def near_words(index: Index, chars: np.ndarray, begin: np.ndarray, length: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the near words that agree with a query's first half
    (``side`` 1: extended to the right) or second half (``side`` 0: to the left).
    The letters of query q are ``chars[begin[q] :][:length[q]]``."""
    half = length // 2
    n, end = len(length), begin + length
    # letters of the exact part from its inner end outwards, then those of the rest
    exact = half if side else length - half
    inner = begin + half - 1 if side else begin + half
    outwards = -1 if side else 1
    rest = length - exact
    across = begin + half if side else begin + half - 1
    states, alive = index.whole(n), np.arange(n)
    for j in range(int(exact.max(initial=0)) + 1):
        going = j <= exact[alive]
        q = alive[going]
        if not len(q):
            continue
        letter = np.where(j < exact[q], chars[np.clip(inner[q] + outwards * j, 0, len(chars) - 1)], 0)
        states[:, q] = index.extend(states[:, q], letter, 1 - side)
        alive = alive[states[2, alive] > 0]
    step = 1 if side else -1
    free, free_q, free_at = states[:, alive], alive, np.zeros(len(alive), np.int64)
    used = [np.zeros((3, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    found_q, found_w = [], []

    def letters(q: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at < rest[q], chars[np.clip(across[q] + step * at, 0, len(chars) - 1)], 0)

    while len(free_q) or len(used[1]):
        if len(free_q):
            due = letters(free_q, free_at)
            which, letter = index.branches(free, side)
            other = index.extend(free[:, which], letter, side)
            kept = other[2] > 0
            which, letter, other = which[kept], letter[kept], other[:, kept]
            replaced = (letter != due[which]) & (free_at[which] < rest[free_q[which]])
            inside = free_at < rest[free_q]
            used = [
                np.concatenate([used[0], other[:, replaced], other, free[:, inside]], axis=1),
                np.concatenate([used[1], free_q[which[replaced]], free_q[which], free_q[inside]]),
                np.concatenate([used[2], free_at[which[replaced]] + 1, free_at[which], free_at[inside] + 1]),
            ]
            free = index.extend(free[:, inside], due[inside], side)
            left = free[2] > 0
            free, free_q, free_at = free[:, left], free_q[inside][left], free_at[inside][left] + 1
        states, q, at = used
        if len(q):
            states = index.extend(states, letters(q, at), side)
            ended, left = at >= rest[q], states[2] > 0
            done = ended & left
            # a whole word between two delimiters: the left one stands before it
            found_q.append(q[done])
            found_w.append(index.follows[states[0][done]])
            used = [states[:, left & ~ended], q[left & ~ended], at[left & ~ended] + 1]
    pairs = np.stack([np.concatenate(found_q or [np.zeros(0, np.int64)]), np.concatenate(found_w or [np.zeros(0, np.int64)])])
    pairs = np.unique(pairs, axis=1)
    return pairs[0], pairs[1]


# -- units -----------------------------------------------------------------------------------


def halves(word: Column, head: Column) -> Column:
    """Exact halves under which a word is listed: those of all lengths that a near
    query can have.  ``asks`` marks the word's own half."""
    n = F.length(word)
    own = F.when(head, F.floor(n / 2)).otherwise(n - F.floor(n / 2))
    sizes = F.array_distinct(F.transform(
        F.array(n - 1, n, n + 1), lambda m: F.when(head, F.floor(m / 2)).otherwise(m - F.floor(m / 2))))
    part = lambda s: F.when(head, F.substring(word, F.lit(1), s.cast("int"))).otherwise(F.right(word, s.cast("int")))
    return F.transform(sizes, lambda s: F.struct(
        F.concat(F.when(head, F.lit("<")).otherwise(F.lit(">")), part(s)).alias("key"), (s == own).alias("asks")))


def dealt(words: DataFrame) -> DataFrame:
    """(word, n, head, asks, holds, pack, block): the rows of each unit (pack,
    block); ``holds`` marks words of the index, ``asks`` queries.  Keys of more
    than UNIT words are few, so Spark sees a small table and need not sort."""
    side = F.explode(F.array(F.lit(True), F.lit(False)))
    rows = words.select("word", "n", side.alias("head"))
    short = F.when(F.col("head"), F.substring("word", 1, HEAD)).otherwise(F.right("word", F.lit(TAIL)))
    rows = settle(rows.select("*", F.concat(F.when(F.col("head"), F.lit("<")).otherwise(F.lit(">")), short).alias("key")))
    sizes = lambda df: df.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > UNIT)
    large = settle(sizes(rows))
    marked = rows.join(large, "key", "left")
    fine = marked.filter("size is not null").select("word", "n", "head", F.inline(halves(F.col("word"), F.col("head"))))
    fine = settle(fine.select("word", "n", "head", F.concat(F.lit("="), "key").alias("key"), "asks"))
    hot = settle(sizes(fine))
    every = marked.filter("size is null").select("word", "n", "head", "key", F.lit(True).alias("asks"), F.lit(None).cast("long").alias("size"))
    every = every.unionByName(fine.join(hot, "key", "left").select(*every.columns))
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / UNIT).cast("int")
    units = every.withColumn("own", F.pmod(F.xxhash64("word"), blocks).cast("int"))
    visited = F.when(F.col("asks"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array("own"))
    units = units.withColumn("block", F.explode(visited))
    packs = rows.count() // UNIT + 1
    pack = F.when(F.col("size").isNull(), F.pmod(F.xxhash64("key"), F.lit(packs)).cast("string")).otherwise(F.col("key"))
    units = units.select("word", "n", "head", "asks", (F.col("own") == F.col("block")).alias("holds"), pack.alias("pack"), "block")
    return units.repartition(packs, "pack", "block")


def answers(unit: pd.DataFrame) -> pd.DataFrame:
    """(word, n_near, best) of the queries of one unit that have near words; best
    is [-n, word] of the first by count."""
    out = []
    held = unit[unit["holds"]].drop_duplicates("word").sort_values("word")
    words, counts = held["word"].tolist(), held["n"].to_numpy()
    if not words:
        return pd.DataFrame([], columns=["word", "n_near", "form_n", "form"])
    index, place = Index(words), np.array(words, dtype=object)
    for head in (True, False):
        asking = unit[unit["asks"] & (unit["head"] == head)]["word"].drop_duplicates()
        asked = asking.tolist()
        if not asked:
            continue
        # letters that no word of the index has match nothing: one number beyond all others
        text = np.array([ord(c) for c in "".join(asked)], dtype=np.int64)
        at = np.searchsorted(index.letters, text)
        at[at == len(index.letters)] = 0
        strange = index.letters[at] != text
        length = np.array([len(w) for w in asked], dtype=np.int64)
        begin = np.cumsum(length) - length
        at[strange] = len(index.letters)
        q, w = near_words(index, at, begin, length, 1 if head else 0)
        if not head:  # found by the first half already
            also = np.array([words[y].startswith(asked[x][: len(asked[x]) // 2]) for x, y in zip(q.tolist(), w.tolist(), strict=True)], dtype=bool)
            q, w = q[~also], w[~also]
        order = np.lexsort((w, -counts[w], q))
        q, w = q[order], w[order]
        start = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
        many = np.diff(np.append(start, len(q)))
        names = np.array(asked, dtype=object)
        out.append(pd.DataFrame({"word": names[q[start]], "n_near": many, "form_n": counts[w[start]], "form": place[w[start]]}))
    return pd.concat(out) if out else pd.DataFrame([], columns=["word", "n_near", "form_n", "form"])


def near_counts(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): how many near words each word has, and the one
    of the largest count; words without any are left out."""

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        return answers(unit)

    found = dealt(words).groupBy("pack", "block").applyInPandas(run, "word string, n_near long, form_n long, form string")
    first = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("b"))
    return grouped.select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), by pointer doubling.  Forms never form a
    circle, since counts grow."""
    now = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("top"))
        new = settle(now.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        done = new.filter("moved").limit(1).count() == 0
        drop(now)
        now = new.drop("moved")
        if done:
            return now


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each (word, n)."""
    words = settle(words)
    near = near_counts(words)
    chosen = F.col("form_n") >= RATIO * F.col("n")
    made = settle(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")))
    ends = roots(made.filter("form is not null"))
    return made.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs: DataFrame) -> DataFrame:
    return spelling_variants(vocabulary(spread(docs)))


#: The same words from SQL: crc32 byte by byte over a table of its own, near words
#: by the words that one deletion leaves.
SQL = f"""
with recursive crc(i, k, v) as (
  select i, 0, i::ubigint from range(256) t(i)
  union all select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end from crc where k < 8),
tab as (select list(v order by i) t from crc where k = 8),
r as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) x from documents),
low as (select doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') x, count(*) n from r group by all),
hexed as (select *, hex(encode(coalesce(doc_id::varchar, '') || ':' || x)) s from low where length(x) >= {LEAST_LENGTH}),
hashed as (
  select x, n, xor(4294967295::ubigint, list_reduce(
      list_prepend(4294967295::ubigint, list_transform(range(length(s) // 2),
        lambda i: ('0x' || substr(s, 2 * i + 1, 2))::ubigint)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b)::bigint + 1]))) h
  from hexed, tab),
made as (select case when h % {ERRORS} = 0 then substr(x, 1, (h % length(x))::bigint) || substr(x, (h % length(x))::bigint + 2) else x end word, n from hashed),
w as (select word, sum(n)::bigint n from made where length(word) >= {LEAST_LENGTH} group by word having sum(n) >= {LEAST_COUNT}),
gaps as (
  select word, n, unnest(list_distinct(list_transform(range(length(word)), lambda i: substr(word, 1, i) || substr(word, i + 2)))) g from w),
spots as (select word, n, unnest(list_transform(range(length(word)), lambda i: substr(word, 1, i) || chr(0) || substr(word, i + 2))) g from w),
near as (
  select a.word, b.word v, b.n from spots a join spots b on a.g = b.g and a.word != b.word
  union select a.g, a.word, a.n from gaps a join w on w.word = a.g
  union select a.word, w.word, w.n from gaps a join w on w.word = a.g),
best as (select word, count(*) n_near, max(n) top, arg_min(v, (-n, v)) v from near group by word),
f as (
  select w.word, w.n, coalesce(n_near, 0)::bigint n_near, case when top >= {RATIO} * w.n then v end form,
         case when top >= {RATIO} * w.n then top end form_n
  from w left join best on best.word = w.word),
up(word, root) as (
  select word, word from f union all select up.word, f.form from up join f on f.word = up.root where f.form is not null)
select f.word, f.form, up.root, f.n, f.n_near, f.form_n::double form_n
from f join up on up.word = f.word join f e on e.word = up.root and e.form is null
"""
