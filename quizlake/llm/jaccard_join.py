"""N-gram Jaccard join with Bayesian pruning of candidates.

A text is the set of its runs of five words (words as between ASCII white space,
case kept; one run of all words where there are fewer than five).  Two texts are
linked when the Jaccard similarity of their sets is 0.8 or more.  Texts without
a word, null ones included, link to nothing.  Rows with equal sets are copies:
they count as links of each other and go on as one representative with a count.

1. 200 MinHash values of each set; 40 bands of 5 find candidates: a pair at the
   threshold is missed with probability (1 - 0.8^5)^40 = 1.2e-7, at 0.85 with
   6e-11.  Buckets are not expanded into pairs: the components of texts that share
   buckets are groups that no candidate pair leaves.  They are found with one edge
   a text and round, and buckets of the same texts count once.
2. Within a group, MinHash values are compared 20 at a time.  After n of them
   with m equal, under a uniform prior, the similarity reaches the threshold with
   probability P(Binomial(n + 1, 0.8) <= m); below TOLERANCE the pair is dropped.
   What is left is verified exactly on the sets.
3. Groups of more than BLOCK members are split by a hash into blocks of about
   BLOCK, and each pair of blocks is a unit that is worked on alone, so never more
   than two blocks are held at once.  Smaller groups are packed into bins of about
   BIN members.  A unit returns one row per member (number of links, root of its
   links), never pairs.

Links between different texts are all counted, however large a group is; the
class of a document is the component of the links, keyed by its smallest node.
It is shown as its smallest doc_id (nulls aside); classes that have none, or the
same one as another class, are shown as a negative number made from their key.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from quizlake.llm.common import HASHES, NO_ID, fresh, identity
from quizlake.llm.graph import connected
from quizlake.sources.storage import settle

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 5
STEP, TOLERANCE = 20, 1e-6
BLOCK, BIN, SLICE = 512, 1500, 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_draw = np.random.default_rng(20240607)
_A = (_draw.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _draw.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]


def split_words(text: str | None) -> list[str]:
    """Words between ASCII white space."""
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words."""
    words = split_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(WORDS, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ w[k : len(w) - n + 1 + k]) * _MIX
            h ^= h >> np.uint64(29)
    return np.unique(h)


def minhash(s: np.ndarray) -> np.ndarray:
    low = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for k in range(0, len(low), 2048):
        np.minimum(best, (low[None, k : k + 2048] * _A + _B).min(axis=1), out=best)
    return best


def least_equal(n: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The smallest number of equal values among n that keeps a pair."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n + 1


def similar(a: list[np.ndarray], b: list[np.ndarray] | None) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of ``a`` and ``b`` (of ``a`` with i < j if ``b`` is None) at
    the threshold: incremental pruning on MinHash values, then exact."""
    ha = np.stack([minhash(s) for s in a])
    hb = ha if b is None else np.stack([minhash(s) for s in b])
    sa = [frozenset(s.tolist()) for s in a]
    sb = sa if b is None else [frozenset(s.tolist()) for s in b]
    for i in range(len(a)):
        j = np.arange(i + 1 if b is None else 0, len(hb))
        equal = np.zeros(len(j), np.int32)
        for n in range(STEP, BANDS * ROWS + 1, STEP):
            if not len(j):
                break
            equal += (hb[j, n - STEP : n] == ha[i, n - STEP : n]).sum(axis=1, dtype=np.int32)
            kept = equal >= least_equal(n)
            j, equal = j[kept], equal[kept]
        x = sa[i]
        for k in j.tolist():
            both = len(x & sb[k])
            if both >= THRESHOLD * (len(x) + len(sb[k]) - both):
                yield i, k


def sets(docs: DataFrame) -> DataFrame:
    """(d, t, node, bands) of every document: node is a 128-bit hash of its set,
    null without words; bands are the hashes of its 40 bands."""

    schema = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("node", pa.string()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                nodes, bands = [], []
                for text in part.column("x").to_pylist():
                    s = shingles(text)
                    nodes.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                    found = minhash(s).reshape(BANDS, ROWS) if len(s) else ()
                    bands.append([xxhash.xxh3_64_intdigest(b.tobytes(), seed=k) >> 1 for k, b in enumerate(found)])
                columns = [part.column("d"), part.column("t"), nodes, bands]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = docs.select(*identity(F.col("doc_id"), F.col("text")), F.col("text").alias("x"))
    return rows.mapInArrow(run, "d long, t long, node string, bands array<long>")


def dealt(members: DataFrame) -> DataFrame:
    """The members with their block ``own``, once for each unit (grp, p, q) that
    holds it.  ``pack`` and ``bin`` say which rows are worked on together: the
    units of a group of several blocks each alone, smaller groups in bins."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    units = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    small = F.col("size") <= BLOCK
    n = members.filter(small).count() // BIN + 1
    units = units.select(
        "node", "copies", "x", "grp", "own",
        F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        F.when(~small, F.col("grp")).alias("pack"), small.alias("small"),
    )
    bin_ = F.when(F.col("small"), F.pmod(F.xxhash64("grp"), F.lit(n)))
    return units.withColumn("bin", bin_.cast("int")).drop("small")


def verified(members: DataFrame) -> DataFrame:
    """(node, root, links) for each member (node, copies, x, grp, size) and unit."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for (_, p, q), unit in frame.groupby(["grp", "p", "q"], sort=True):
            rows += unit_links(unit, p, q)
        return pd.DataFrame(rows, columns=["node", "root", "links"])

    return dealt(members).groupBy("pack", "bin", "p", "q").applyInPandas(run, "node string, root string, links long")


def unit_links(unit: pd.DataFrame, p: int, q: int) -> list[tuple[str, str, int]]:
    one, two = unit[unit["own"] == p], unit[unit["own"] == q]
    if p == q:
        two = one.iloc[:0]
    elif one.empty or two.empty:
        return []
    names = [*one["node"], *two["node"]]
    copies = [*one["copies"], *two["copies"]]
    a = [shingles(x) for x in one["x"]]
    b = None if p == q else [shingles(x) for x in two["x"]]
    shift = 0 if p == q else len(a)
    links, root = [0] * len(names), list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in similar(a, b):
        j += shift
        links[i] += copies[j]
        links[j] += copies[i]
        x, y = find(i), find(j)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(names[i], names[find(i)], links[i]) for i in range(len(names)) if links[i]]


def linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(d, t, node, bands) of every row, and (node, root, known, n_links) of every
    set: root is the key of its class, known its smallest doc_id that is not null,
    n_links counts the other linked rows of a row with this set."""
    made = settle(sets(docs))
    groups = settle(made.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct("d", "t")).alias("first"),
        F.min(F.nullif("d", F.lit(NO_ID))).alias("known"), F.first("bands").alias("bands")))
    group = connected(groups.select("node", F.explode("bands").alias("key")))
    sizes = group.groupBy("root").agg(F.count("*").alias("size"))
    chosen = (
        groups.select("node", "copies", "first.d", "first.t")
        .join(group, "node")
        .join(sizes, "root")
        .select("node", "copies", "d", "t", F.col("root").alias("grp"), "size")
    )
    texts = docs.select(*identity(F.col("doc_id"), F.col("text")), F.col("text").alias("x"))
    members = settle(texts.join(chosen, ["d", "t"]).dropDuplicates(["node"]).drop("d", "t"))
    found = settle(verified(members))
    linked = connected(found.select("node", F.col("root").alias("key")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (
        groups.select("node", "copies", "known")
        .join(linked, "node", "left")
        .join(links, "node", "left")
        .select(
            "node", F.coalesce("root", "node").alias("root"), "known",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return made, named


def class_names(named: DataFrame) -> DataFrame:
    """(root, class_id): no two classes share a class_id."""
    own = F.xxhash64("root").bitwiseOR(F.lit(NO_ID))
    classes = settle(named.groupBy("root").agg(F.min("known").alias("known")).select(
        "root", F.coalesce("known", own).alias("class_id")))
    shared = classes.groupBy("class_id").agg(F.count("*").alias("n")).filter("n > 1")
    return classes.join(shared, "class_id", "left").select(
        "root", F.when(F.col("n").isNull(), F.col("class_id")).otherwise(own).alias("class_id"))


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(d, t, class_id, n_links) of every row; n_links counts its other linked
    rows.  A document without a word has its own d for a class_id."""
    made, named = linked_sets(docs)
    by_set = named.join(class_names(named), "root").select("node", "class_id", "n_links")
    return made.select("d", "t", "node").join(by_set, "node", "left").select(
        "d", "t", F.coalesce("class_id", "d").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its class: the smallest
    (doc_id, hash of the text); of rows equal in both, all stay.  Documents
    without a word stay.  Columns as they were."""
    made, named = linked_sets(docs)
    linked = named.filter("n_links > 0").select("node", "root")
    classes = settle(made.select("d", "t", "node").join(linked, "node").select("root", "d", "t").distinct())
    first = classes.groupBy("root").agg(F.min(F.struct("d", "t")).alias("f"))
    later = classes.join(first, "root").filter(F.struct("d", "t") != F.col("f")).select("d", "t")
    d, t = (fresh(c, docs.columns) for c in ("d", "t"))
    id_, hash_ = identity(docs["doc_id"], docs["text"])
    gone = later.select(F.col("d").alias(d), F.col("t").alias(t))
    return docs.withColumns({d: id_, t: hash_}).join(gone, [d, t], "left_anti").drop(d, t)


#: Every pair of different sets that shares a run of words, compared exactly.
SQL = f"""
with recursive w as (
  select doc_id, regexp_extract_all(text, '[^ \\t-\\r]+') w from documents where regexp_matches(text, '[^ \\t-\\r]')),
g as (
  select doc_id, case when len(w) < {WORDS} then [array_to_string(w, ' ')]
    else list_sort(list_distinct(list_transform(generate_series(1, len(w) - {WORDS - 1}),
         lambda i: array_to_string(list_slice(w, i, i + {WORDS - 1}), ' ')))) end s from w),
c as (select s, min(doc_id) rep, count(*) copies from g group by s),
x as (select rep, unnest(s) x, len(s) n from c),
p as (
  select a.rep u, b.rep v from x a join x b on a.x = b.x and a.rep != b.rep
  group by a.rep, b.rep, a.n, b.n having count(*) >= {THRESHOLD} * (a.n + b.n - count(*))),
r as (select rep u, rep v from c union select r.u, p.v from r join p on r.v = p.u),
k as (select u, min(v) class_id from r group by u),
l as (select p.u, sum(c.copies) links from p join c on c.rep = p.v group by p.u)
select d.doc_id, coalesce(k.class_id, d.doc_id) class_id,
       cast(coalesce(l.links, 0) + coalesce(c.copies, 1) - 1 as bigint) n_links
from documents d left join g using (doc_id) left join c on c.s = g.s
left join k on k.u = c.rep left join l on l.u = c.rep
"""
