"""Curves of the calibrated SVM are fitted on all rows of a fold."""

from __future__ import annotations

import random

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quizlake.plans import models as ML


def test_curves_see_every_row_however_many_ranges_there_are(spark, monkeypatch):
    rng, weights = random.Random(7), []
    points = [(f"r{i:03d}", "A", rng.gauss(0, 1)) for i in range(600)]
    rows = [(k, o, int(x + rng.gauss(0, 1) > 0), Vectors.dense([x, rng.gauss(0, 1)])) for k, o, x in points]
    train = spark.createDataFrame(rows, ["row_id", "option", "label", "features"]).cache()
    fit = ML.IsotonicRegression.fit

    def seen(curve, known, params=None):
        weights.append(known.agg(F.sum("weight")).first()[0])
        return fit(curve, known)

    monkeypatch.setattr(ML.IsotonicRegression, "fit", seen)
    keys = ("row_id", "option")
    few, many = (ML.train_svm_calibrated(train, keys, max_iter=20, curve_rows=n) for n in (1_000_000, 40))
    assert weights == [200.0] * 6
    a, b = ({r["row_id"]: r["p"] for r in m.probability(train, "p").collect()} for m in (few, many))
    assert len(a) == 600 and max(abs(a[k] - b[k]) for k in a) < 1e-6
