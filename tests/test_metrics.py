"""Metrics against brute force."""

import random

import pytest

from quizlake.operators import metrics as M


def area(rows):
    pos, neg = ([s for y, s in rows if y == want] for want in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else 0.0


def scored(n, values):
    rng = random.Random(n)
    draw = (lambda: rng.random()) if values is None else (lambda: rng.choice(values))
    return [(int(rng.random() < 0.3), draw()) for _ in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        scored(600, None),
        scored(600, [0.1, 0.2, 0.9]),
        [(y, 0.5 + s * 1e-9) for y, s in scored(400, None)],
        [(1, 0.3), (1, 0.4)],
        [],
    ],
    ids=["distinct", "ties", "close", "one class", "empty"],
)
def test_roc_auc_is_exact(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double").repartition(5)
    assert M.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(area(rows), abs=1e-12)
