"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters or digits, lower-cased.  A passage is scored against a
test item by Smith-Waterman over words (match 2, else and gap -1); the score is the
share of the best possible one, and THRESHOLD and more is a leak.

Seeds are words and pairs of neighbouring words, the rarest ones of each item by
their counts over all documents.  They lose nothing: let an item have m words, and let
an alignment match M of them in R runs.  It has R - 1 errors or more, so its score
is at most 2 M - (R - 1), and it holds M - R pairs.  If it reaches 2 T m (T the
threshold), then M + (M - R) >= 2 T m - 1.  Of the 2 m - 1 places of words and pairs
any ``2 m - ceil(2 T m) + 1`` must therefore hold one that is matched: the rarest
ones are chosen, however frequent they are.  Common words open windows only where
an item has nothing else.

A passage around a seed is aligned only if the words and pairs that it shares with
the item allow the threshold: with M words and B pairs the score is at most
2 M - (M - B - 1) and 2 M.  No alignment that reaches the threshold is left out.

Items are a query set: they are taken in blocks of about BLOCK items, one after
another.  A block numbers the words of its items, one pass writes the documents as
these numbers, their counts are added up by Spark, and the seeds, chosen by them,
are broadcast and searched; the broadcast is removed before the next block.
Documents are read whole and their texts are never shuffled.

Null and empty texts have no leaks; items of fewer than LEAST words cannot leak;
items equal in id and text count once, a null item_id is a value like others.  Of
equal scores of an item in one text the first one by place is reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from quizlake.llm.common import NO_ID, fresh, identity
from quizlake.sources.storage import drop, settle

LEAST, THRESHOLD = 3, 0.5
MATCH, MISS = 2, -1
BLOCK = 5_000
WORD = regex.compile(r"[\p{L}\p{N}]+")


def split_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pair_keys(words: np.ndarray) -> np.ndarray:
    """One number for each word and the next one."""
    return (words[:-1].astype(np.uint64) << np.uint64(32)) | words[1:].astype(np.uint64)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and where in ``passage`` it ends."""
    place = np.arange(1, len(passage) + 1)
    above, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        row = np.maximum(above[:-1] + np.where(passage == word, MATCH, MISS), above[1:] + MISS)
        # a gap along the row costs one a step: a running maximum of row + place
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + place) - place, 0)
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above[1:] = row
    return best, end


def best_possible(words: int, pairs: int) -> int:
    """The most that an alignment of so many shared words and pairs can score."""
    return MATCH * words + MISS * max(0, words - pairs - 1)


@dataclass
class Index:
    """A block of items.  ``known`` numbers the words of the items from 1; no other
    word can match, so in a text all others are 0.  ``pairs`` holds the pairs of
    neighbouring words, sorted; a pair's number is its place from 1 on.  A *feature*
    is a word (its number) or a pair (its number after the words'); seed features
    occur in the items at ``places`` from ``first[feature]`` on (item and place)."""

    items: list[tuple[int | None, np.ndarray, np.ndarray]]
    known: dict[str, int]
    pairs: np.ndarray
    sizes: np.ndarray
    first: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, texts: list[tuple[int | None, str]]) -> Index:
        """Items without seeds yet."""
        known: dict[str, int] = {}
        split = [(name, w) for name, text in texts if len(w := split_words(text)) >= LEAST]
        words = [np.array([known.setdefault(w, len(known) + 1) for w in own], dtype=np.int64) for _, own in split]
        pairs = np.unique(np.concatenate([pair_keys(w) for w in words] or [np.zeros(0, np.uint64)]))
        items = [(name, w, np.searchsorted(pairs, pair_keys(w)) + 1) for (name, _), w in zip(split, words, strict=True)]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        return cls(items, known, pairs, sizes, np.zeros(1, np.int64), np.zeros((0, 2), np.int64))

    @property
    def features(self) -> int:
        return len(self.known) + len(self.pairs) + 1

    def seeded(self, counts: np.ndarray) -> Index:
        """With the seeds of each item: its rarest features by ``counts``."""
        found = []
        for i, (_, words, pairs) in enumerate(self.items):
            features = np.concatenate([words, pairs + len(self.known)])
            places = np.concatenate([np.arange(len(words)), np.arange(len(pairs))])
            needed = 2 * len(words) - int(np.ceil(2 * THRESHOLD * len(words) - 1e-9)) + 1
            order = np.lexsort((places, features, counts[features]))
            seeds = np.unique(features[order[:needed]])
            held = np.isin(features, seeds)
            found.append(np.stack([features[held], np.full(held.sum(), i), places[held]]))
        rows = np.concatenate(found or [np.zeros((3, 0), np.int64)], axis=1)
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        first = np.searchsorted(rows[0], np.arange(self.features + 1))
        return replace(self, first=first, places=rows[1:].T)

    def read(self, text: str | None) -> np.ndarray:
        """Numbers of the words of a text, 0 for those of no item."""
        found = split_words(text)
        return np.fromiter(map(self.known.get, found, repeat(0)), dtype=np.int64, count=len(found))

    def numbered(self, read: np.ndarray) -> np.ndarray:
        """Number of the pair that starts at each place, 0 for those of no item."""
        pair = np.zeros(len(read), np.int64)
        place, which = _among(self.pairs, pair_keys(read))
        pair[place] = which + 1
        return pair

    def windows(self, read: np.ndarray, pair: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, start, stop) of the passages around the seeds, each once."""
        both = np.concatenate([read, np.where(pair > 0, pair + len(self.known), 0)])
        many = self.first[both + 1] - self.first[both]
        hit = np.flatnonzero(many)
        if not len(hit):
            return []
        many, start = many[hit], self.first[both[hit]]
        at = np.arange(many.sum()) + np.repeat(start - np.cumsum(many) + many, many)
        item, p = self.places[at].T
        size = self.sizes[item]
        block = (np.repeat(hit % len(read), many) - p) // size
        found = np.unique(np.stack([item, np.maximum(0, (block - 1) * size), (block + 3) * size]), axis=1)
        return list(zip(*found.tolist(), strict=True))

    def leaks(self, read: np.ndarray) -> list[tuple[int | None, float, int, int]]:
        """(item_id, score, first and last word) of the best alignment of each
        item that reaches the threshold."""
        if not read.any():
            return []
        pair = self.numbered(read)
        has_word, has_pair = np.zeros(len(self.known) + 1, bool), np.zeros(len(self.pairs) + 1, bool)
        best: dict[int, tuple[int, int]] = {}
        for item, start, stop in self.windows(read, pair):
            _, wanted, both = self.items[item]
            near, near_pair = read[start:stop], pair[start : min(stop, len(read)) - 1]
            has_word[near], has_pair[near_pair] = True, True
            has_word[0] = has_pair[0] = False
            most = best_possible(int(has_word[wanted].sum()), int(has_pair[both].sum()))
            has_word[near], has_pair[near_pair] = False, False
            least = THRESHOLD * MATCH * len(wanted)
            if most < least:
                continue
            score, end = align(wanted, near)
            if score >= least and score > best.get(item, (0,))[0]:
                best[item] = (score, start + end)
        return [
            (self.items[i][0], s / (MATCH * len(self.items[i][1])), max(0, end - len(self.items[i][1]) + 1), end)
            for i, (s, end) in best.items()
        ]


def _among(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``h`` whose value is one of the sorted ``keys``, and which."""
    if not len(keys) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(keys, h)
    at[at == len(keys)] = 0
    place = np.flatnonzero(keys[at] == h)
    return place, at[place]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Items in blocks of about BLOCK, chosen by a hash."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").alias("x")).distinct()
    rows = rows.filter("x is not null")
    n = -(-rows.count() // BLOCK)
    for b in range(n):
        part = rows.filter(F.pmod(F.xxhash64("i", "x"), F.lit(n)) == b).collect()
        yield [(r["i"], r["x"]) for r in sorted(part, key=lambda r: (r["i"] is None, r["i"], r["x"]))]


def coded(docs: DataFrame, shared) -> DataFrame:
    """(d, t, doc_id, codes) of the documents that hold a word of an item."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for frame in frames:
            read = [index.read(x if isinstance(x, str) else None) for x in frame["x"]]
            made = frame.drop(columns="x").assign(codes=[r.astype("<u4").tobytes() for r in read])
            yield made[[bool(r.any()) for r in read]]

    rows = docs.select(*identity(F.col("doc_id"), F.col("text")), F.col("text").alias("x"))
    return rows.mapInPandas(run, "d long, t long, codes binary")


def decoded(codes: bytes) -> np.ndarray:
    return np.frombuffer(codes, "<u4").astype(np.int64)


def counts(rows: DataFrame, shared) -> np.ndarray:
    """How often each feature occurs in all documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        total = np.zeros(index.features, np.int64)
        for frame in frames:
            for codes in frame["codes"]:
                read = decoded(codes)
                pair = index.numbered(read)
                total += np.bincount(read, minlength=index.features)
                total += np.bincount(pair[pair > 0] + len(index.known), minlength=index.features)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"f": seen, "n": total[seen]})

    total = np.zeros(shared.value.features, np.int64)
    added = rows.mapInPandas(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n"))
    for r in added.collect():  # at most the words and pairs of one block of items
        total[r["f"]] = r["n"]
    return total


def searched(rows: DataFrame, shared) -> DataFrame:
    """(d, t, item_id, score, first_word, last_word) of all leaks of a block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for frame in frames:
            found = [(d, t, *x) for d, t, codes in frame[["d", "t", "codes"]].itertuples(index=False) for x in index.leaks(decoded(codes))]
            made = pd.DataFrame(found, columns=["d", "t", "item_id", "score", "first_word", "last_word"])
            yield made.astype({"item_id": "Int64"})

    return rows.mapInPandas(run, "d long, t long, item_id long, score double, first_word long, last_word long")


def found_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, t, item_id, score, first_word, last_word), a row for each leak of each row."""
    spark, parts = docs.sparkSession, []
    for items in blocks(benchmark):
        plain = spark.sparkContext.broadcast(Index.of(items))
        rows = settle(coded(docs, plain))
        seeded = spark.sparkContext.broadcast(plain.value.seeded(counts(rows, plain)))
        plain.destroy()
        parts.append(settle(searched(rows, seeded)))
        seeded.destroy()
        drop(rows)
    empty = spark.createDataFrame([], "d long, t long, item_id long, score double, first_word long, last_word long")
    return reduce(DataFrame.unionByName, parts, empty) if len(parts) != 1 else parts[0]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word), one row for each leak."""
    return found_leaks(docs.select("doc_id", "text"), benchmark).select(
        F.nullif("d", F.lit(NO_ID)).alias("doc_id"), "item_id", "score", "first_word", "last_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak, columns as they were."""
    d, t = (fresh(c, docs.columns) for c in ("d", "t"))
    id_, hash_ = identity(docs["doc_id"], docs["text"])
    gone = settle(found_leaks(docs.select("doc_id", "text"), benchmark).select(F.col("d").alias(d), F.col("t").alias(t)).distinct())
    return docs.withColumns({d: id_, t: hash_}).join(gone, [d, t], "left_anti").drop(d, t)
