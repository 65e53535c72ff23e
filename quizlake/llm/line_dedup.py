"""Line dedup: a suffix array over line ids, built by distributed prefix doubling.

A document is the sequence of its lines that hold a word (blank lines carry no
id).  A line goes if it lies in a run of consecutive such lines that has at least
``MIN_WORDS`` words and also starts earlier: in a smaller document, or in the
same document at an earlier line.  Runs are judged on the input and may overlap.
The document order is (doc_id, hash of the text); rows equal in both are one
document and get the same result.  Null texts stay null, null ids come first.

1. Lines whose hash occurs once cannot lie in a repeated run.  The rest falls
   into segments of neighbours; segments of fewer words than ``MIN_WORDS`` go too.
2. Prefix doubling: ``r0`` ranks the lines; ``r(k+1)`` ranks the pairs
   (``rk`` here, ``rk`` 2^k lines on) by a range-partitioned sort of the distinct
   pairs.  Since a line has a word, runs of MIN_WORDS words need at most
   log2(MIN_WORDS) rounds.  The last ranks order the suffixes as a suffix array
   does up to that depth, and equal ``rk`` is a common prefix of 2^k lines.
3. For each line, the shortest run of MIN_WORDS words that starts there, and the
   one that ends there, has c lines.  The suffixes that share those c lines are
   an LCP interval of the array; it is named by ``rk`` at both ends of the run
   (2^k <= c < 2^(k+1)).  All its suffixes but the first are later copies.
   Every line of a repeated run lies in one of these shortest runs, so together
   they cover the maximal repeated runs.

Shuffles carry ids and ranks; texts move once, to meet the lines to delete.
Counts and firsts are combined before each shuffle, and joins put one row per
value against the hot value, which adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from quizlake.functions.text import let
from quizlake.llm.common import fresh, identity
from quizlake.sources.storage import settle

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """(d, t, i, w, h1, h2): place, word count and hash of each line with a word."""
    one = docs.select(*identity(F.col("doc_id"), F.col(text)), F.col(text).alias("x")).filter("x is not null")
    each = one.select("d", "t", F.posexplode(F.split("x", "\n")).alias("i", "x"))
    counted = each.withColumn("w", F.regexp_count("x", F.lit(WORD))).filter("w > 0")
    return counted.select("d", "t", "i", "w", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(7), "x").alias("h2"))


def segments(rows: DataFrame, min_words: int) -> DataFrame:
    """(d, t, s, j, i, w, h1, h2): lines that occur again, in segments ``s`` of
    neighbours with at least ``min_words`` words; ``j`` counts the lines with words."""
    again = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("d", "t", "i")).alias("a"), F.max(F.struct("d", "t", "i")).alias("z"))
    again = again.filter("n > 1 and a != z").select("h1", "h2", F.lit(1).alias("again"))
    doc = W.partitionBy("d", "t").orderBy("i")
    marked = (
        rows.dropDuplicates(["d", "t", "i"])
        .join(again, ["h1", "h2"], "left")
        .withColumn("j", F.row_number().over(doc))
        .filter("again = 1")
        .withColumn("s", F.col("j") - F.row_number().over(doc))
    )
    whole = W.partitionBy("d", "t", "s")
    return marked.withColumn("all", F.sum("w").over(whole)).filter(F.col("all") >= min_words).drop("again", "all")


def rank(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys in order, each with a rank that rises with the order."""
    ordered = pairs.groupBy(*keys).count().drop("count").orderBy(*keys)
    return ordered.withColumn("rank", F.monotonically_increasing_id() + 1)


def doubled(seg: DataFrame, rounds: int) -> DataFrame:
    """``seg`` with ranks r0 .. r(rounds) of the next 2^k lines of the segment,
    null where the segment is shorter."""
    ranks = settle(rank(seg, ["h1", "h2"]))
    out = settle(seg.join(ranks.withColumnRenamed("rank", "r0"), ["h1", "h2"]).drop("h1", "h2"))
    order = W.partitionBy("d", "t", "s").orderBy("j")
    for k in range(rounds):
        ahead = out.withColumn("next", F.lead(f"r{k}", 2**k).over(order))
        pairs = ahead.filter("next is not null").select(F.col(f"r{k}").alias("a"), F.col("next").alias("b"))
        ranks = settle(rank(pairs, ["a", "b"]))
        out = settle(
            ahead.join(ranks, (F.col(f"r{k}") == F.col("a")) & (F.col("next") == F.col("b")), "left")
            .drop("a", "b", "next")
            .withColumnRenamed("rank", f"r{k + 1}")
        )
    return out


def runs_of(segment: list, min_words: int) -> list[tuple]:
    """Shortest runs of ``min_words`` words that start or end at each line of a
    segment [(j, i, w, ranks)], as (j, c, left, right, places)."""
    n, found = len(segment), set()
    upto = list(accumulate((x[2] for x in segment), initial=0))
    z = 0
    for a in range(n):
        while z < n and upto[z] - upto[a] < min_words:
            z += 1
        if upto[z] - upto[a] >= min_words:
            found.add((a, z - a))
    a = n
    for z in range(n, 0, -1):
        a = min(a, z)
        while a > 0 and upto[z] - upto[a] < min_words:
            a -= 1
        if upto[z] - upto[a] >= min_words:
            found.add((a, z - a))
    rows = []
    for a, c in sorted(found):
        k = c.bit_length() - 1
        ends = segment[a][3][k], segment[a + c - 2**k][3][k]
        rows.append((segment[a][0], c, *ends, [x[1] for x in segment[a : a + c]]))
    return rows


def runs(array: DataFrame, min_words: int, rounds: int) -> DataFrame:
    """The runs of all segments; a segment is part of one document."""
    ranks = F.array(*[F.coalesce(f"r{k}", F.lit(0)) for k in range(rounds + 1)])
    row = F.struct("j", "i", "w", ranks.alias("ranks"))
    whole = array.groupBy("d", "t", "s").agg(F.array_sort(F.collect_list(row)).alias("lines"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (d, t, *found)
                for d, t, lines in frame[["d", "t", "lines"]].itertuples(index=False)
                for found in runs_of([(x["j"], x["i"], x["w"], x["ranks"]) for x in lines], min_words)
            ]
            yield pd.DataFrame(rows, columns=["d", "t", "j", "c", "a", "z", "places"])

    return whole.mapInPandas(run, "d long, t long, j long, c long, a long, z long, places array<int>")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """(d, t, gone): for each document that loses lines, their places (from 0)."""
    rounds = max(0, min_words.bit_length() - 1)
    seg = settle(segments(lines(docs, text), min_words))
    named = settle(runs(doubled(seg, rounds), min_words, rounds))
    interval = ["c", "a", "z"]
    firsts = named.groupBy(*interval).agg(F.min(F.struct("d", "t", "j")).alias("f"), F.count("*").alias("n"))
    later = (
        named.join(firsts.filter("n > 1"), interval)
        .filter(F.struct("d", "t", "j") != F.col("f"))
        .select("d", "t", F.explode("places").alias("i"))
    )
    return later.groupBy("d", "t").agg(F.collect_set("i").alias("gone"))


def cleaned(docs: DataFrame, min_words: int = MIN_WORDS, n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` without its repeated lines,
    and two more columns, how many lines with a word there were and how many are
    removed (0 for null); they replace columns of these names."""
    d, t, gone, at = (fresh(c, docs.columns) for c in ("d", "t", "gone", "at"))
    found = repeated_lines(docs, min_words).select(F.col("d").alias(d), F.col("t").alias(t), F.col("gone").alias(gone))
    id_, hash_ = identity(docs["doc_id"], docs["text"])
    rows = docs.withColumns({d: id_, t: hash_}).join(found, [d, t], "left")
    parts = F.split("text", "\n")
    staying = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    kept = let(parts, lambda p: F.transform(staying, lambda i: F.get(p, i)))
    holds_word = F.size(F.filter(parts, lambda x: x.rlike(WORD)))
    return rows.select(
        *[c for c in docs.columns if c not in ("text", n_lines, n_removed)],
        F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.when(F.col("text").isNull(), 0).otherwise(holds_word), F.lit(0)).cast("long").alias(n_lines),
        F.coalesce(F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)), F.lit(0)).cast("long").alias(n_removed),
    )


#: Rows of ``cleaned`` over documents, straight from the definition: a run is any
#: range of lines with a word, found by its first and last line and its words.
SQL = f"""
with l as (
  select doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) i, unnest(string_split(text, chr(10))) x
  from documents),
k as (
  select doc_id, i, x, len(regexp_extract_all(x, '[^ \t-\r]+')) w,
         row_number() over (partition by doc_id order by i) j
  from l where regexp_matches(x, '[^ \t-\r]')),
r as (
  select a.doc_id, a.j, b.j z, string_agg(c.x, chr(10) order by c.j) run
  from k a join k b on a.doc_id = b.doc_id and b.j between a.j and a.j + {MIN_WORDS - 1}
  join k c on c.doc_id = a.doc_id and c.j between a.j and b.j
  group by a.doc_id, a.j, b.j
  having sum(c.w) >= {MIN_WORDS} and (sum(c.w) - max(b.w) < {MIN_WORDS} or sum(c.w) - max(a.w) < {MIN_WORDS})),
f as (select run, min((doc_id, j)) first from r group by run having count(*) > 1),
g as (select distinct r.doc_id, k.i from r join f using (run) join k on k.doc_id = r.doc_id and k.j between r.j and r.z
      where (r.doc_id, r.j) != f.first)
select d.doc_id,
       (select count(*) from k where k.doc_id = d.doc_id) n_lines,
       (select count(*) from g where g.doc_id = d.doc_id) n_removed,
       sha256(coalesce((select string_agg(l.x, chr(10) order by l.i) from l
                        where l.doc_id = d.doc_id and not exists (
                          select 1 from g where g.doc_id = l.doc_id and g.i = l.i)), '')) kept_sha256
from documents d
"""
