"""Terms meet the vocabulary inside a task: no term of a text is a row of its own."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quizlake.operators import features as X
from quizlake.plans import clusters as CL

IDF = {"stone": 1.5, "river": 2.0, "old": 1.25, "town": 3.0}
OPTIONS = "array<struct<label:string,text:string>>"


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(t, 1, x) for t, x in IDF.items()], "term string, df long, idf double")


def weights(text):
    return {t: (1 + math.log(n)) * IDF[t] for t, n in Counter(text.lower().split()).items() if t in IDF}


def wanted(article, question, option):
    a, q = weights(article), weights(f"{question} {option}")
    dot = sum(w * a.get(t, 0.0) for t, w in q.items())
    norm = math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in q.values()))
    return dot / norm if norm else 0.0, sum(IDF[t] for t in weights(option) if t in a)


def items(spark, rows):
    return spark.createDataFrame(rows, f"row_id string, article string, question string, options {OPTIONS}")


def test_cosines_of_single_repeated_and_keyless_questions(spark, vocab):
    rows = [
        ("a", "Old stone old river hill", "which river", [("A", "stone stone"), ("B", "hill"), ("C", "town river"), ("D", "")]),
        ("b", "", "old town", [("A", "old"), ("B", None)]),
        ("c", None, None, []),
        ("twice", "stone river", "old town", [("A", "river")]),
        ("twice", "stone town", "old", [("A", "stone"), ("B", "town")]),
        (None, "stone", "stone", [("A", "stone")]),
    ]
    made = X.verifier_features(items(spark, rows).repartition(3), vocab)
    got = {(r["row_id"], r["label"]): (r["tfidf_cosine_sim"], r["idf_weighted_score"]) for r in made.collect()}
    want = {(k, o): wanted(a or "", q or "", t or "") for k, a, q, options in rows[:3] for o, t in options}
    # rows of one question are one article and one question
    want["twice", "A"] = wanted("stone river stone town", "old town old", "river stone")
    want["twice", "B"] = wanted("stone river stone town", "old", "town")
    want[None, "A"] = (0.0, 0.0)
    assert set(got) == set(want)
    for key, (cosine, shared) in want.items():
        assert math.isclose(got[key][0], cosine, abs_tol=1e-12)
        assert (got[key][1] > 0) == (shared > 0)
    assert math.isclose(got["a", "C"][1], 2.0)


def test_no_question_and_no_vocabulary(spark, vocab):
    one = [("a", "old stone", "river", [("A", "stone")])]
    assert X.tfidf_features(items(spark, []), vocab).count() == 0
    r = X.verifier_features(items(spark, one), vocab.limit(0)).first()
    assert (r["tfidf_cosine_sim"], r["idf_weighted_score"]) == (0.0, 0.0)


def test_terms_are_not_rows(spark, vocab):
    one = items(spark, [("a", "old stone", "river", [("A", "stone")])])
    plan = X.tfidf_features(one, vocab)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    known = spark.createDataFrame([(t, x, [x, -x]) for t, x in IDF.items()], "term string, idf double, axes array<double>")
    options = spark.createDataFrame([("a", "A", ["old"])], "row_id string, label string, terms array<string>")
    made = CL.projected(options, ["row_id", "label"], known, 2)
    assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_points_of_repeated_keyless_and_unknown_options(spark):
    known = spark.createDataFrame([(t, x, [x, -2.0]) for t, x in IDF.items()], "term string, idf double, axes array<double>")
    rows = [("a", "A", ["old", "town", "old"]), ("a", "B", ["new"]), ("b", "A", None), (None, "A", ["old"]),
            ("twice", "A", ["stone"]), ("twice", "A", ["stone", "river"])]
    options = spark.createDataFrame(rows, "row_id string, label string, terms array<string>").withColumn("n", F.lit(7))
    got = [(r["row_id"], r["label"], r["n"], r["point"]) for r in CL.projected(options, ["row_id", "label"], known, 2).collect()]

    def point(words):
        w = weights(" ".join(words))
        norm = math.sqrt(sum(x * x for x in w.values()))
        return [sum(x * IDF[t] for t, x in w.items()) / norm, sum(x * -2.0 for x in w.values()) / norm] if w else [0.0, 0.0]

    both = point(["stone", "stone", "river"])
    want = [point(rows[0][2]), [0.0, 0.0], [0.0, 0.0], [0.0, 0.0], both, both]
    assert len(got) == 6
    order = lambda r: (r[0] is None, r[0] or "", r[1])
    for (key, label, n, p), w in zip(sorted(got, key=order), [want[0], want[1], want[2], *want[4:], want[3]], strict=True):
        assert n == 7 and all(math.isclose(x, y, abs_tol=1e-12) for x, y in zip(p, w, strict=True)), (key, label)
