"""Language identification, word first with backoff to character n-grams.

Words are runs of letters, lower-cased.  A word that the training texts know
scores each language by its log frequency there.  An unseen word is read from
left to right: at each place the longest known character n-gram, of ORDERS[0]
letters down to one, gives its log frequency, and their mean is the word's score
(word borders count as a letter).  The language of the highest sum wins, ties go
to the first in order; the score is its share after a softmax.

Learned from at most TRAIN_ROWS labelled rows, chosen by a hash of the id (fewer:
all).  Counting is spread over the tasks and summed by Spark; the MAX_WORDS most
frequent words and MAX_GRAMS n-grams of each order make the model, which is the
only thing broadcast.  Texts that are null or hold no letter are ``und`` with
score 0; so is every text if nothing was learned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from quizlake.llm.common import bucket, sampled
from quizlake.sources.storage import settle

TRAIN_ROWS = 12_000
MAX_WORDS, MAX_GRAMS = 60_000, 20_000
ORDERS = (5, 4, 3, 2, 1)
#: Words of a text scored at a time.
SLICE = 50_000
WORD = regex.compile(r"\p{M}*\p{L}[\p{L}\p{M}]*")
EDGE = "\n"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(word: str, n: int) -> list[str]:
    framed = EDGE + word + EDGE
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


@dataclass
class Model:
    """Log frequencies over ``langs``: a row of ``logs`` for each word and n-gram."""

    langs: list[str]
    word: dict[str, int]
    gram: dict[str, int]
    logs: np.ndarray

    @classmethod
    def of(cls, counts: list[tuple[int, str, str, int]]) -> Model:
        """From (order, 0 for words; lang; token; count)."""
        langs = sorted({c[1] for c in counts})
        at = {name: i for i, name in enumerate(langs)}
        tables: dict[int, dict[str, np.ndarray]] = {n: {} for n in (0, *ORDERS)}
        for n, lang, token, count in counts:
            tables[n].setdefault(token, np.zeros(len(langs)))[at[lang]] += count
        rows, word, gram = [], {}, {}
        for n, found in tables.items():
            total = sum(found.values(), np.zeros(len(langs)))
            share = np.log(total + 0.5 * (len(found) + 1))
            for token, c in found.items():
                (gram if n else word)[token] = len(rows)
                rows.append(np.log(c + 0.5) - share)
        return cls(langs, word, gram, np.array(rows).reshape(len(rows), len(langs)))

    def backoff(self, word: str) -> list[int]:
        """The longest known n-gram at each place of the word, if there is one."""
        framed, found, get = EDGE + word + EDGE, [], self.gram.get
        for i in range(len(framed)):
            for n in ORDERS:
                at = get(framed[i : i + n])
                if at is not None:
                    found.append(at)
                    break
        return found

    def score(self, ws: list[str]) -> np.ndarray:
        """Sum of the scores of some words."""
        at = np.fromiter(map(self.word.get, ws, repeat(-1)), dtype=np.int64, count=len(ws))
        unseen = Counter(ws[i] for i in np.flatnonzero(at < 0).tolist())
        total = self.logs[at[at >= 0]].sum(axis=0)
        found, starts, often = [], [], []
        for w, n in unseen.items():
            if own := self.backoff(w):
                starts.append(len(found))
                often.append(n)
                found += own
        if found:
            sums = np.add.reduceat(self.logs[found], starts, axis=0)
            total += (sums * (np.array(often) / np.diff([*starts, len(found)]))[:, None]).sum(axis=0)
        return total

    def judge(self, text: str | None) -> tuple[str, float]:
        ws = words(text)
        if not ws or not self.langs:
            return "und", 0.0
        total = np.zeros(len(self.langs))
        for k in range(0, len(ws), SLICE):
            total += self.score(ws[k : k + SLICE])
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def learn(rows: DataFrame) -> Model:
    """From bounded rows (x text, lang)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            total: dict[tuple[int, str], Counter] = {}
            for text, lang in zip(frame["x"], frame["lang"], strict=True):
                total.setdefault((0, lang), Counter()).update(words(text if isinstance(text, str) else None))
            for (_, lang), found in list(total.items()):
                for n in ORDERS:
                    c = total.setdefault((n, lang), Counter())
                    for word, k in found.items():
                        for g in grams(word, n):
                            c[g] += k
            for (n, lang), found in total.items():
                yield pd.DataFrame({"n": n, "lang": lang, "token": list(found), "k": list(found.values())})

    counted = rows.mapInPandas(run, "n int, lang string, token string, k long")
    counted = counted.groupBy("n", "lang", "token").agg(F.sum("k").alias("k"))
    whole = settle(counted.groupBy("n", "token").agg(F.sum("k").alias("all"), F.collect_list(F.struct("lang", "k")).alias("by")))
    found = []
    for n in (0, *ORDERS):
        own = whole.filter((F.col("n") == n) & ((F.col("all") > 1) if n == 0 else F.lit(True)))
        top = own.orderBy(F.desc("all"), "token").limit(MAX_GRAMS if n else MAX_WORDS)
        found += [(n, b["lang"], r["token"], b["k"]) for r in top.collect() for b in r["by"]]
    return Model.of(found)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        rows = [shared.value.judge(t if isinstance(t, str) else None) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, F.inline(F.array(judged(F.col(text)))))


def language_id(docs: DataFrame, held_out: int = 2, folds: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    known = docs.filter(F.col("lang").isNotNull() & (bucket(F.col("doc_id"), folds) != held_out))
    # among the chosen ids a repeated one counts once for each text and language
    few = sampled(known.select("doc_id", F.col("text").alias("x"), "lang"), TRAIN_ROWS, F.col("doc_id"), F.col("lang"), F.col("x"))
    model = learn(few.distinct().select("x", "lang"))
    rows = predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", (bucket(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")
