"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the distinct hashes of its words, pairs of neighbours and
pairs with one word between them (skip-grams); a word is a run of letters or
digits, lower-cased.  Hashes have 64 bits, so a text of any length practically
never meets a weight by chance.

Training takes at most ``TRAIN_ROWS`` labelled rows (chosen by a hash of the id;
fewer: all of them).  FTRL is sequential, so one task makes the passes over this
bounded sample.  Each coordinate has its own learning rate, and L1 leaves only
the features that carry weight; at most ``MAX_WEIGHTS`` of them, the largest,
are broadcast.  Features seen in fewer than three training texts are left out, and
steps whose gradient is below ``IDLE`` are passed over.

Scoring is a map over the documents: no shuffle, one pass, whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from quizlake.llm.common import HASHES, bucket, fresh, sampled

TRAIN_ROWS = 10_000
MAX_WEIGHTS = 200_000
IDLE = 0.01
BLOCK = 2_048
WORD = regex.compile(r"[\p{L}\p{N}\p{M}]+")
NEXT, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(text: str | None) -> np.ndarray:
    """Hashes of words, word pairs and skip pairs; may repeat."""
    words = WORD.findall((text or "").lower())
    one = np.fromiter(map(HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        pair = (one[:-1] * NEXT) ^ one[1:]
        skip = (one[:-2] * SKIP) ^ one[2:]
    return np.concatenate([one, pair, skip])


@dataclass
class Ftrl:
    """FTRL-proximal for logistic loss over sets of feature indices."""

    size: int
    alpha: float = 5.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    z: np.ndarray = field(init=False)
    n: np.ndarray = field(init=False)

    def __post_init__(self):
        self.z = np.zeros(self.size + 1)
        self.n = np.zeros(self.size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        """Weights at the indices; the last index is the bias, without L1."""
        z, l1 = self.z[at], np.where(at == self.size, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def step(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, self.size)
        w = self.weights(at)
        g = _sigmoid(w.sum()) - label
        if abs(g) < IDLE:
            return
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def fit(rows: list[np.ndarray], labels: list[int], epochs: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature hashes (sorted), their weights, and the bias, from the distinct
    features of each text and its label."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0), 0.0
    seen = np.zeros(2**24, np.uint8)
    low = np.uint64(2**24 - 1)
    for f in rows:
        at = np.unique(f & low)
        seen[at] = np.minimum(seen[at], 2) + 1
    common = lambda f: f[seen[f & low] > 2]
    keys, ends = np.zeros(0, np.uint64), [0]
    for start in range(0, len(rows), BLOCK):
        block = [common(f) for f in rows[start : start + BLOCK]]
        ends += (ends[-1] + np.cumsum([len(f) for f in block])).tolist()
        keys = np.union1d(keys, np.concatenate(block))
    # places in one array for all texts: its memory goes back to the system when it is freed
    flat = np.empty(ends[-1], np.int32)
    for f, start, end in zip(rows, ends, ends[1:], strict=False):
        flat[start:end] = np.searchsorted(keys, common(f))
    rows.clear()
    del seen
    rows = [flat[start:end] for start, end in zip(ends, ends[1:], strict=False)]
    model = Ftrl(len(keys))
    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            model.step(at, label)
    w = model.weights(np.arange(len(keys) + 1))
    kept = np.flatnonzero(w[:-1])
    if len(kept) > MAX_WEIGHTS:
        kept = np.sort(kept[np.argsort(-np.abs(w[kept]), kind="stable")[:MAX_WEIGHTS]])
    return keys[kept], w[kept], float(w[-1])


def train(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on rows (k string, x text, y 0 or 1) that the caller has bounded:
    features in all tasks, the passes of FTRL in one.  Without rows there are no
    weights, and every score is 0.5."""

    row = pa.schema([("h", pa.int64()), ("k", pa.string()), ("f", pa.binary()), ("y", pa.int32())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                made = [np.unique(features(x)).tobytes() for x in part.column("x").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("h"), part.column("k"), pa.array(made, pa.binary()), part.column("y")], schema=row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            columns = batch.column("h").to_pylist(), batch.column("k").to_pylist(), batch.column("f"), batch.column("y").to_pylist()
            found += [(h, k, np.frombuffer(f.as_buffer(), np.uint64) if f.as_buffer() else np.zeros(0, np.uint64), y)
                      for h, k, f, y in zip(*columns, strict=True)]
        found.sort(key=lambda r: r[:2])
        texts, labels = [r[2] for r in found], [r[3] for r in found]
        found = columns = batch = None  # ``fit`` frees the texts' hashes before the passes
        keys, weights, bias = fit(texts, labels)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(keys.view(np.int64), 0)), pa.array(np.append(weights, bias))], names=["f", "w"])

    made = rows.select(F.xxhash64("k").alias("h"), "k", "x", "y").mapInArrow(extract, "h long, k string, f binary, y int")
    found = made.repartition(1).mapInArrow(run, "f long, w double").toPandas()
    if found.empty:
        return np.zeros(0, np.uint64), np.zeros(0), 0.0
    keys = found["f"].to_numpy()[:-1].view(np.uint64)
    return keys, found["w"].to_numpy()[:-1], float(found["w"].iloc[-1])


def score_text(text: str | None, model: tuple[np.ndarray, np.ndarray, float]) -> float:
    keys, weights, bias = model
    total = bias
    if len(keys):
        f = features(text)
        at = np.searchsorted(keys, f)
        at[at == len(keys)] = 0
        total += weights[np.unique(at[keys[at] == f])].sum()
    return _sigmoid(total)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; null and empty texts get that
    of the bias.  Other columns pass through, ``out`` is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judged(texts: pd.Series) -> pd.Series:
        return pd.Series([score_text(t if isinstance(t, str) else None, shared.value) for t in texts], dtype=float)

    return docs.withColumn(out, judged(F.col(text)))


def learn(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5):
    """Weights from labelled documents outside the held-out fold.  Several labels
    of a document count by their largest, several texts by their smallest.  The
    ids are sampled first; this bounded list is sent to the texts."""
    one = labels.groupBy(F.col("doc_id").cast("string").alias("k")).agg(F.max("toxic").alias("y"))
    one = one.filter(F.col("y").isin(0, 1) & (bucket(F.col("k"), folds) != held_out))
    chosen = sampled(one, TRAIN_ROWS, F.col("k"))
    texts = docs.select(F.col("doc_id").cast("string").alias("k"), F.col("text").alias("x"))
    found = texts.join(F.broadcast(chosen), "k")
    return train(found.groupBy("k").agg(F.min("x").alias("x"), F.max(F.col("y").cast("int")).alias("y")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    rows = score(docs.select("doc_id", "text"), learn(docs, labels))
    return rows.select(
        "doc_id",
        (bucket(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, columns as they were.
    Where nothing was learned (no document outside the held-out fold has a usable
    label: no weights, bias 0), no row is judged and all stay."""
    out = fresh("score", docs.columns)
    model = learn(docs, labels)
    if not len(model[0]) and model[2] == 0:
        return docs
    return score(docs, model, out=out).filter(F.col(out) < threshold).drop(out)
