"""Suffix-array dedup by column-wise construction of the collection's BWT and LCP.

A text is its UTF-8 bytes (null: none).  Every byte covered by a string of WIDTH
bytes that also starts earlier goes: in a smaller document (doc_id, then hash of
the text; rows equal in both are one document) or earlier in the same one.
Matches never cross documents, overlaps count, strings are judged on the input.

1. *Copies.*  Of documents with equal texts all but the first go whole.
2. *Chunks.*  The smallest hash among the 32-byte strings of a window of WIDTH
   bytes is the window's key.  Neighbouring windows with one key form a chunk of
   at most 2 * WIDTH bytes.  Equal windows have equal keys, so keys can be dealt
   to tasks, and a chunk whose key occurs once holds nothing that repeats
   (unless the text is periodic there, which the chunk then says).
3. *Equal chunks.*  Of chunks with equal bytes all but the first go whole; the
   first stands for them below.
4. *BWT and LCP.*  The chunks of a block of keys are the documents of a column-wise
   construction: each round inserts one symbol of every chunk, last symbols
   first.  A new suffix goes where the LF mapping of the transform so far sends
   it, and its common prefix with its neighbour is one more than the smallest
   value between the two places that it comes from.  Both arrays are files that
   a round reads once in order and writes once in order.  A block is bounded, so
   its files are memory files; no folder of one machine is used.
5. Suffixes of WIDTH bytes or more that are neighbours with a common prefix of
   WIDTH form an interval: one repeated string.  All but its first place go.

Keys with more than HOT different chunks are dealt by whole windows instead (one
chunk for each window, the key is the hash of its bytes), so no key is too large
for a task.  Shuffles carry keys and places; texts move twice (to cut the chunks
that matter, and to be cut themselves), equal chunks are combined before the
shuffle.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quizlake.llm.common import identity
from quizlake.sources.storage import settle

WIDTH, GRAM = 100, 32
MOST = WIDTH - GRAM + 1
BLOCK, HOT = 1_500, 20_000
_draw = np.random.default_rng(20240611)
_BYTE = _draw.integers(0, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_STEP = _draw.integers(0, 2**63, 8, dtype=np.uint64) | np.uint64(1)


def window_keys(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hash of a 32-byte string in each window of WIDTH bytes, and
    the keys that may stand twice in one chunk (as in periodic texts)."""
    if len(text) < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, n = _BYTE[text], 1
    while n < GRAM:
        h = h[:-n] * _STEP[n.bit_length()] + h[n:]
        n *= 2
    h ^= h >> np.uint64(32)
    h *= _STEP[0]
    h ^= h >> np.uint64(29)
    low = sliding(np.minimum, h)
    # a string is some window's smallest if it equals the largest of the minima
    # of the windows that hold it
    edge = np.zeros(MOST - 1, np.uint64)
    chosen = np.flatnonzero(sliding(np.maximum, np.concatenate([edge, low, edge])) == h)
    twice = (h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) <= MOST)
    return low.view(np.int64), np.unique(h[chosen[:-1][twice]]).view(np.int64)


def prefix_hashes(text: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of a text."""
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE[text] * powers(len(text), _BASE), out=out[1:])
    return out


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 17), base, np.uint64)
        factors[0] = 1
        known = _POWERS[base] = np.multiply.accumulate(factors)
    return known[:n]


def sliding(smaller: np.ufunc, values: np.ndarray) -> np.ndarray:
    """Minimum or maximum of each run of MOST values, by doubling."""
    n = 1
    while 2 * n <= MOST:
        values = smaller(values[:-n], values[n:])
        n *= 2
    rest = MOST - n
    return smaller(values[: len(values) - rest], values[rest:]) if rest else values


def chunk_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each chunk."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    size = np.diff(np.append(cuts, len(keys)))
    if size.max() > MOST:
        cuts = np.concatenate([np.arange(a, a + n, MOST) for a, n in zip(cuts, size, strict=True)])
        size = np.diff(np.append(cuts, len(keys)))
    return cuts, size


def bwt_and_lcp(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk, suffix length, LCP with the suffix before) of all suffixes of the
    chunks in order, by inserting one symbol of every chunk each round."""
    n = len(chunks)
    length = np.array([len(c) for c in chunks])
    width = int(length.max(initial=0))
    # columns from the right; 0 ends a chunk, other symbols keep the order of bytes
    # (UTF-8 leaves some bytes unused, so 255 symbols are enough)
    every = np.frombuffer(b"".join(chunks), np.uint8)
    symbol_of = np.cumsum(np.bincount(every, minlength=256) > 0).astype(np.uint8)
    table = np.zeros((width + 1, n), np.uint8)
    for i, c in enumerate(chunks):
        table[: len(c), i] = symbol_of[np.frombuffer(c, np.uint8)[::-1]]
    # the empty suffixes, in the order of the chunks
    bwt, lcp = table[0].copy(), np.zeros(n, np.uint8)
    name = np.arange(n, dtype=np.int32) << 8
    alive = np.flatnonzero(bwt)
    who = alive.copy()
    ended = n - len(alive)
    for j in range(1, width + 1):
        # the sorted order of the symbols is the LF mapping of all suffixes
        source = np.argsort(bwt, kind="stable")[ended:]
        counts = np.bincount(bwt, minlength=256)
        counts[0] = 0
        keys = np.repeat(np.arange(256) << 40, counts)
        keys += source
        wanted = (bwt[alive].astype(np.int64) << 40) + alive
        turn = np.argsort(wanted)
        new, who = n + np.searchsorted(keys, wanted[turn]), who[turn]
        # places of new suffixes in the grown arrays; the old ones keep their order
        total = len(bwt) + len(new)
        old = np.ones(total, bool)
        old[new] = False
        # common prefixes change at new suffixes and right behind them
        touched = np.empty(2 * len(new), np.int64)
        touched[::2], touched[1::2] = new, np.minimum(new + 1, total - 1)
        touched = touched[np.append(True, touched[1:] != touched[:-1])]
        came = source[touched - n]
        before = source[np.maximum(touched - n - 1, 0)]
        same = (touched > n) & (bwt[before] == bwt[came])
        values = np.zeros(len(touched), np.uint8)
        if same.any():
            values[same] = np.minimum(range_min(lcp, before[same] + 1, came[same] + 1), 253) + 1
        lcp = inserted(lcp, old, touched, values)
        next_symbol = table[j, who]
        bwt = inserted(bwt, old, new, next_symbol)
        name = inserted(name, old, new, (who.astype(np.int32) << 8) + j)
        going = next_symbol > 0
        alive, who = new[going], who[going]
        ended += len(new) - len(alive)
        if not len(alive):
            break
    return name >> 8, name & 255, lcp


def inserted(column: np.ndarray, old: np.ndarray, new: np.ndarray, values) -> np.ndarray:
    """``column`` read in order and written in order, with ``values`` at ``new``."""
    wide = np.empty(len(old), column.dtype)
    wide[old] = column
    wide[new] = values
    return wide


def range_min(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Minimum of values[start:stop] for each range (none is empty)."""
    at = np.empty(2 * len(start), np.int64)
    at[::2], at[1::2] = start, stop
    return np.minimum.reduceat(np.append(values, np.uint8(255)), at)[::2]


def repeated_windows(chunks: list[bytes], position: list[int]) -> list[tuple[int, int]]:
    """(chunk, window) of all windows whose bytes also start at a smaller
    position; ``position`` is that of each chunk's first byte."""
    owner, size, lcp = bwt_and_lcp(chunks)
    length = np.array([len(c) for c in chunks])
    # suffixes of WIDTH or more with a neighbour that shares WIDTH bytes
    linked = (lcp >= WIDTH).astype(np.int8)
    inside = np.flatnonzero(linked | np.append(linked[1:], 0).astype(np.int8))
    if not len(inside):
        return []
    starts = np.flatnonzero(linked[inside] == 0)
    offset = length[owner[inside]] - size[inside]
    at = np.array(position, np.int64)[owner[inside]] + offset
    first = np.minimum.reduceat(at, starts)
    later = at > np.repeat(first, np.diff(np.append(starts, len(inside))))
    return list(zip(owner[inside][later].tolist(), offset[later].tolist(), strict=True))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def places(docs: DataFrame) -> DataFrame:
    """(key, d, t, s, n, twice, same): the chunks of all documents, without their
    bytes; ``twice`` if windows of the chunk may be equal among themselves, and
    ``same`` a hash of its bytes beside the key and the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, t, x = (batch.column(c) for c in ("d", "t", "x"))
            for start in range(0, len(x), 512):
                keys, s, n, row, twice, same = [], [], [], [], [], []
                for k, text in enumerate(x.slice(start, 512)):
                    symbols = np.frombuffer(text.as_buffer(), np.uint8)
                    found, double = window_keys(symbols)
                    if len(found):
                        a, size = chunk_places(found)
                        sums = prefix_hashes(symbols)
                        same.append((sums[a + size + WIDTH - 1] - sums[a]) * powers(len(symbols), _BACK)[a])
                        twice.append(np.isin(found[a], double) if len(double) else np.zeros(len(a), bool))
                        keys.append(found[a])
                        s.append(a)
                        n.append(size)
                        row.append(np.full(len(a), start + k))
                if keys:
                    row = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), d.take(row), t.take(row),
                         pa.array(np.concatenate(s).astype(np.int32)), pa.array(np.concatenate(n).astype(np.int16)),
                         pa.array(np.concatenate(twice)), pa.array(np.concatenate(same).view(np.int64))],
                        names=["key", "d", "t", "s", "n", "twice", "same"])

    return docs.mapInArrow(run, "key long, d long, t long, s int, n short, twice boolean, same long")


def cut_chunks(wanted: DataFrame) -> DataFrame:
    """(key, d, t, s, twice, x): the bytes x of the chunks ``at`` of each text."""
    kinds = pa.schema([("key", pa.int64()), ("d", pa.int64()), ("t", pa.int64()), ("s", pa.int32()), ("twice", pa.bool_()), ("x", pa.binary())])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in zip(*(batch.column(c) for c in ("d", "t", "x", "at")), strict=True):
                d, t, text = r[0].as_py(), r[1].as_py(), r[2].as_buffer().to_pybytes()
                for a in r[3].as_py():
                    rows.append((a["key"], d, t, a["s"], a["twice"], text[a["s"] : a["s"] + a["n"] + WIDTH - 1]))
                if len(rows) > 20_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    return wanted.mapInArrow(run, "key long, d long, t long, s int, twice boolean, x binary")


def hot_windows(chunks: DataFrame) -> DataFrame:
    """The windows of chunks, each a chunk of its own, dealt by its bytes."""
    windows = F.transform(
        F.sequence(F.lit(0), F.length("x") - WIDTH),
        lambda i: F.struct(i.alias("i"), F.substring(F.col("x"), i + 1, F.lit(WIDTH)).alias("x")),
    )
    each = chunks.select("d", "t", "s", F.explode(windows).alias("w"))
    first = each.groupBy(F.col("w.x").alias("x")).agg(F.min(F.struct("d", "t", (F.col("s") + F.col("w.i")).alias("s"))).alias("f"))
    mine = each.select("d", "t", (F.col("s") + F.col("w.i")).alias("s"), F.col("w.x").alias("x"))
    later = mine.join(first, "x").filter(F.struct("d", "t", "s") != F.col("f"))
    return later.select("d", "t", F.col("s").alias("a"), (F.col("s") + WIDTH).alias("z"))


def within_blocks(chunks: DataFrame) -> DataFrame:
    """(d, t, a, z): ranges of bytes that repeat, from the blocks of keys."""
    dealt = chunks.select("key", "d", "t", "s", "x", "twice").repartition("key").sortWithinPartitions("key", "d", "t", "s")
    kinds = pa.schema([("d", pa.int64()), ("t", pa.int64()), ("a", pa.int32()), ("z", pa.int32())])

    def solve(block: list[tuple]) -> pa.RecordBatch:
        docs = {dt: k for k, dt in enumerate(sorted({r[1:3] for r in block}))}
        position = [(docs[r[1:3]] << 32) + r[3] for r in block]
        found: dict[int, list] = {}
        for chunk, window in repeated_windows([r[4] for r in block], position):
            s = block[chunk][3] + window
            found.setdefault(chunk, []).append((s, s + WIDTH))
        rows = [(*block[c][1:3], a, z) for c, ranges in found.items() for a, z in merged(ranges)]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        held: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("key", "d", "t", "s", "x", "twice")), strict=True):
                if held and held[0][0] != r[0]:
                    if len(held) > 1 or held[0][5]:
                        block += held
                    held = []
                    if len(block) >= BLOCK:
                        yield solve(block)
                        block = []
                held.append(r)
        block += held if len(held) > 1 or held and held[0][5] else []
        if block:
            yield solve(block)

    return dealt.mapInArrow(run, "d long, t long, a int, z int")


def release(df: DataFrame) -> None:
    """Let Spark remove the shuffle files of plans that are not used any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(d, t, ranges): byte ranges (a, z) to remove from each document."""
    texts = docs.select(*identity(F.col("doc_id"), F.col("text")), F.col("text").alias("x")).filter(F.octet_length("x") >= WIDTH)
    seen = texts.select("d", "t", F.xxhash64(F.lit(7), "x").alias("g"), F.octet_length("x").alias("size"))
    first = seen.groupBy("t", "g", "size").agg(F.min("d").alias("f"), F.max("d").alias("l")).filter("f != l")
    copies = settle(seen.join(first.drop("l"), ["t", "g", "size"]).filter("d != f").select("d", "t", "size").distinct())
    # the chunks whose key occurs again
    again = places(texts).groupBy("key").agg(F.count("*").alias("k"), F.max("twice").alias("w")).filter("k > 1 or w").select("key")
    wanted = settle(places(texts).join(again, "key").join(copies.select("d", "t"), ["d", "t"], "left_anti"))
    release(docs)
    # equal chunks, and their firsts
    equal = ["key", "same", "n"]
    classes = wanted.groupBy(*equal).agg(F.min(F.struct("d", "t", "s")).alias("f"), F.max(F.struct("d", "t", "s")).alias("l"), F.max("twice").alias("twice"))
    classes = settle(classes)
    later = (
        wanted.join(classes.filter("f != l").select(*equal, "f"), equal)
        .filter(F.struct("d", "t", "s") != F.col("f"))
        .select("d", "t", F.col("s").alias("a"), (F.col("s") + F.col("n") + (WIDTH - 1)).alias("z"))
    )
    later = settle(later)
    release(docs)
    # firsts that share their key with others
    per_key = classes.groupBy("key").agg(F.count("*").alias("k"), F.max("twice").alias("w")).filter("k > 1 or w")
    firsts = classes.join(per_key.select("key", "k"), "key").select("key", "k", "f.*", "n", "twice")
    at = firsts.groupBy("d", "t").agg(F.collect_list(F.struct("key", "s", "n", "twice")).alias("at"))
    bytes_of = texts.select("d", "t", F.col("x").cast("binary").alias("x"))
    hot = per_key.filter(F.col("k") > HOT).select("key", F.lit(True).alias("hot"))
    chunks = settle(cut_chunks(bytes_of.join(at, ["d", "t"]).select("d", "t", "x", "at")).join(hot, "key", "left"))
    found = within_blocks(chunks.filter("hot is null")).union(hot_windows(chunks.filter("hot")))
    found = settle(found)
    release(docs)
    whole = copies.select("d", "t", F.lit(0).alias("a"), F.col("size").alias("z"))
    ranges = whole.union(later).union(found)
    ranges = settle(ranges.groupBy("d", "t").agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("ranges")))
    release(docs)
    return ranges


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans) of every row: the remaining
    bytes and the counts of what went.  A null text counts as empty."""
    return _cut(docs, lambda kept: kept, "kept binary", pa.binary())


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    made = _cut(docs, lambda kept: hashlib.sha256(kept).hexdigest(), "kept_sha256 string", pa.string())
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _cut(docs: DataFrame, give, column: str, kind: pa.DataType) -> DataFrame:
    one = docs.select("doc_id", *identity(F.col("doc_id"), F.col("text")), F.col("text").alias("x"))
    joined = one.join(repeated_ranges(docs), ["d", "t"], "left").select("doc_id", "x", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                part, rows = batch.slice(start, 1000), []
                for text, ranges in zip(part.column("x"), part.column("ranges"), strict=True):
                    whole = text.as_buffer().to_pybytes() if text.is_valid and text.as_buffer() else b""
                    spans = merged([(r["a"], r["z"]) for r in ranges.as_py() or ()])
                    edges = [0, *(e for s in spans for e in s), len(whole)]
                    kept = b"".join(whole[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                    rows.append((give(kept), len(whole), len(whole) - len(kept), len(spans)))
                values = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(values[0], kind), *(pa.array(v, pa.int64()) for v in values[1:])],
                    names=["doc_id", column.split()[0], "n_bytes", "n_removed", "n_spans"])

    kind_of_id = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind_of_id}, {column}, n_bytes long, n_removed long, n_spans long")
