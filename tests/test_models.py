"""The model layer: truncated SVD, folds, votes, kept and loaded models."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizlake.catalog import models as M
from quizlake.catalog.options import records
from quizlake.catalog.corpora import vocabulary
from quizlake.operators import options as OP, questions as Q, retrieval as RT
from quizlake.plans import clusters as CL, model_quizzes as MQ, models as ML, store as ST
from quizlake.sources import storage, tables as S
from quizlake.functions import text as T, values as V

WORDS = [f"w{i:02d}" for i in range(30)]


@pytest.fixture(scope="module")
def options(spark):
    rng = random.Random(4)
    rows = [(f"r{i:03d}", "ABCD"[i % 4], [rng.choice(WORDS[: rng.choice([4, 30])]) for _ in range(rng.randint(0, 8))]) for i in range(120)]
    rows += [("none", "A", None), ("new", "A", ["unknown", "words"])]
    return rows, spark.createDataFrame(rows, "row_id string, label string, terms array<string>")


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(w, 1, 1.0 + i / 7) for i, w in enumerate(WORDS)], "term string, df long, idf double")


def dense(rows):
    out = np.zeros((len(rows), len(WORDS)))
    for i, (_, _, terms) in enumerate(rows):
        for w, n in Counter(terms or []).items():
            if w in WORDS:
                out[i, WORDS.index(w)] = (1 + math.log(n)) * (1.0 + WORDS.index(w) / 7)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1.0)


@pytest.mark.parametrize("components", [3, 8, 64])
def test_singular_values_equal_a_dense_svd(spark, options, vocab, components):
    rows, df = options
    sparse = CL.unit_rows(df.repartition(3), ["row_id", "label"], CL.numbered(vocab))
    got, vectors = CL.truncated_svd(sparse, len(WORDS), components, passes=12)
    u, s, vt = np.linalg.svd(dense(rows))
    k = min(components, len(WORDS))
    assert np.allclose(got, s[:k], rtol=1e-5)
    assert np.allclose(np.abs((vt[:3] * vectors[:, :3].T).sum(axis=1)), 1.0, atol=1e-4)


def test_clusters_assign_the_nearest_center_of_dense_points(spark, options, vocab):
    rows, df = options
    model = CL.fit_clusters(df, vocab, components=5)
    axes = {r["term"]: r["axes"] for r in model.terms.collect()}
    basis = np.array([axes[w] for w in WORDS])
    points = dense(rows) @ basis
    got = {(r["row_id"], r["label"]): r for r in CL.cluster_features(model, df).collect()}
    assert len(got) == len(rows) and len(model.centers) == 2
    for (key, label, _), p in zip(rows, points, strict=True):
        far = [np.linalg.norm(p - np.array(c)) for c in model.centers]
        r = got[key, label]
        assert math.isclose(r["kmeans_centroid_dist"], min(far), abs_tol=1e-9)
        assert far[int(r["kmeans_cluster_label"])] <= min(far) + 1e-9


@pytest.mark.parametrize("parts", [1, 7])
def test_folds_of_a_class_differ_by_at_most_one(spark, parts):
    rows = spark.range(503).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    made = ML.stratified_folds(rows.repartition(parts), 5, "row_id").collect()
    sizes = Counter((r["label"], r["_fold"]) for r in made)
    assert len(made) == 503 == len({r["row_id"] for r in made})
    for label in (0, 1):
        own = [sizes[label, f] for f in range(5)]
        assert max(own) - min(own) <= 1
    test_folds_of_a_class_differ_by_at_most_one.seen = getattr(test_folds_of_a_class_differ_by_at_most_one, "seen", [])
    test_folds_of_a_class_differ_by_at_most_one.seen.append(sorted((r["row_id"], r["_fold"]) for r in made))
    assert all(s == test_folds_of_a_class_differ_by_at_most_one.seen[0] for s in test_folds_of_a_class_differ_by_at_most_one.seen)


def test_folds_with_repeated_rows_null_labels_and_no_rows(spark):
    rows = spark.createDataFrame([("a", 1)] * 7 + [("b", None)] * 3, "row_id string, label int")
    made = ML.stratified_folds(rows, 3, "row_id").collect()
    assert sorted(Counter(r["_fold"] for r in made if r["label"] == 1).values()) == [2, 2, 3]
    assert ML.stratified_folds(rows.limit(0), 3, "row_id").count() == 0


# -- the quiz job on given scores -------------------------------------------------------------------


@pytest.fixture(scope="module")
def given(spark, folder):
    """Texts, selections, index and scores of the small tables, without trained models."""
    passages = S.passages(spark, folder).where("doc_id like 'd1%' or doc_id like 'p1%'")
    texts = MQ.quiz_texts(passages)
    rows = Q.question_rows(texts, 8).where(~T.bad_question(F.col("question")))
    scored = rows.withColumn("question_score", F.round(F.least(F.length("question") / F.lit(200.0), F.lit(1.0)) * OP.question_bias(F.col("template")), 9))
    selections = storage.settle(MQ.placed_selections(scored))
    index = RT.build_index(records(spark, folder), vocabulary(spark, folder), fill=V.RETRIEVAL_LIMIT)
    return texts, selections, index, MQ.given_scores(OP.fixed_scorer, OP.fixed_probability)


def quizzes(made):
    return {r["doc_id"]: r.asDict(recursive=True) for r in made.collect()}


@pytest.fixture(scope="module")
def built(given):
    return quizzes(MQ.quizzes_of(*given))


def test_rounds_do_not_change_the_quizzes(given, built):
    texts, selections, index, scores = given
    at_once = quizzes(MQ.quizzes_of(texts, selections, index, scores, ((0, 6),)))
    one_by_one = quizzes(MQ.quizzes_of(texts.repartition(3), selections.repartition(5), index, scores, tuple((i, i + 1) for i in range(6))))
    assert built == at_once == one_by_one and len(built) > 50


def test_only_undecided_passages_are_judged_again(spark):
    rows = [(f"d{i}", place, place >= i % 4) for i in range(40) for place in range(6)]
    selections = spark.createDataFrame(rows, "doc_id string, place int, good boolean")
    seen = []

    def judge(open_):
        seen.append({(r["doc_id"], r["place"]) for r in open_.collect()})
        quality = F.when(F.col("good"), "strict").otherwise("relaxed")
        key = OP.bundle_order(quality, F.col("good"), F.lit(0.5), F.col("place"))
        return open_.select("doc_id", "place", F.struct("place").alias("bundle"), key.alias("key"))

    got = {r["doc_id"]: r["bundle"]["place"] for r in MQ.frontier(selections, judge).collect()}
    assert got == {f"d{i}": i % 4 for i in range(40)}
    assert seen[0] == {(f"d{i}", 0) for i in range(40)}
    assert seen[1] == {(f"d{i}", p) for i in range(40) if i % 4 for p in (1, 2)}
    assert seen[2] == {(f"d{i}", p) for i in range(40) if i % 4 == 3 for p in (3, 4, 5)}
    assert MQ.frontier(selections.limit(0), judge).count() == 0


def test_quizzes_are_well_formed(given, built):
    for q in built.values():
        assert len(q["options"]) == 4 == len({o.lower() for o in q["options"]})
        assert q["options"]["ABCD".index(q["correct_label"])].lower() == q["correct_answer"].lower()
        assert len(q["hints"]) == 3 and q["predicted_label"] in "ABCD"
        assert q["predicted_answer"] == q["options"]["ABCD".index(q["predicted_label"])]
        assert q["verifier_matches"] == (q["predicted_answer"].lower() == q["correct_answer"].lower())
        assert len(q["scores"]) == 4 and all(0 <= p <= 1 for p in q["scores"])
        assert q["fallback_used"] == (len(q["selected"]) < 3) and q["n_considered"] >= len(q["selected"])
        assert sum(q["stage_counts"].values()) == len(q["selected"])
        texts = {o.lower() for o in q["options"]}
        assert {e["text"].lower() for e in q["selected"]} <= texts and q["option_quality"] in V.STAGES


# -- kept and loaded models ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def small_models(spark, folder):
    """The whole model set with small forests, kept and loaded."""
    from pyspark.ml.classification import RandomForestClassifier

    fit, before = RandomForestClassifier.fit, dict(storage._BUILT)
    RandomForestClassifier.fit = lambda forest, rows, params=None: fit(forest.copy().setNumTrees(5).setMaxDepth(4), rows)
    storage._BUILT.clear()
    try:
        path = M.model_store(spark, folder)
        yield path, M.trained_verifier(spark, folder), M._ranker(spark, folder), ST.load(spark, path)
    finally:
        RandomForestClassifier.fit = fit
        storage._BUILT.clear()
        storage._BUILT.update(before)


def test_loaded_models_vote_like_the_trained_ones(spark, folder, small_models):
    rows = M.write_models(spark, folder).collect()
    assert len(rows) == 7 and all(r["n_rows"] == r["n_equal"] > 0 for r in rows)


def test_probabilities_and_features_are_in_range(small_models):
    _, (verifier, votes), (_, scored), _ = small_models
    names = ["p_lr", "p_svm", "p_rf", "p_nb", "p"]
    for r in votes.select(*names).collect():
        assert all(0 <= r[n] <= 1 for n in names)
        assert math.isclose(r["p"], (r["p_lr"] + r["p_svm"] + r["p_rf"]) / 3, abs_tol=1e-12)
    assert all(0 <= r["predicted"] <= 1 for r in scored.select("predicted").collect())
    assert votes.select("features").first()["features"].size == 12 and len(verifier.clusters.centers) == 2


def test_no_article_is_on_both_sides(spark, folder, small_models):
    from quizlake.catalog.tables import usable
    from quizlake.operators import reshape as R

    _, (_, votes), (_, scored), _ = small_models
    marked = R.split_two(usable(spark, folder), F.col("article"), 85)
    sides = marked.groupBy("article").agg(F.count_distinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0
    test = {r["row_id"] for r in marked.where("split = 'test'").collect()}
    assert {r["row_id"] for r in votes.select("row_id").collect()} == test


def test_metadata(spark, folder, small_models):
    about = ST.metadata(spark, small_models[0])
    ranker = about["question_ranker"]
    assert ranker["feature_names"] == V.RANKER_FEATURES and len(ranker["top_importances"]) == 20
    assert ranker["rows"] == ranker["positive_rows"] + ranker["negative_rows"] > 0
    assert 0 <= ranker["binary_metrics"]["roc_auc"] <= 1 and set(about["verifier"]) >= {"p_lr", "p_svm", "p_rf", "p"}
    values = {(r["model"], r["name"]): r["value"] for r in M.write_metadata(spark, folder).collect()}
    assert values["question_ranker", "n_preview"] == 1000 and values["question_ranker", "rows"] == ranker["rows"]


def test_a_version_that_is_not_published_is_not_loaded(spark, small_models, monkeypatch):
    path, _, _, models = small_models

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(storage, "publish", lost)
    with pytest.raises(RuntimeError):
        ST.save(models, path)
    assert ST.load(spark, path).verifier.clusters.centers == models.verifier.clusters.centers
    with pytest.raises(ValueError):
        ST.load(spark, f"{path}/nothing")


def test_constant_classifiers_vote_their_mean(spark):
    from quizlake.operators.verdicts import soft_vote

    row = spark.createDataFrame([(0.2, 0.4, 0.9, None)], "a double, b double, c double, d double")
    assert math.isclose(row.select(soft_vote(F.col("a"), F.col("b"), F.col("c"))).first()[0], 0.5)
    assert math.isclose(row.select(soft_vote(F.col("a"), F.col("d"))).first()[0], 0.2)
    assert row.select(soft_vote(F.col("d"))).first()[0] is None


@pytest.mark.parametrize("name", ["build_quizzes"])
def test_full_job_with_trained_models(spark, folder, small_models, name):
    from quizlake.catalog import QUERIES

    rows = QUERIES[name](spark, folder).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) > 300
    assert all(len(r["options"].split(" | ")) >= 4 and r["predicted_label"] in "ABCD" for r in rows)


def test_jobs_at_the_same_time_do_not_share_properties(spark):
    def job(i):
        return [spark.range(50 + i).agg(F.sum("id")).first()[0] for _ in range(15)]

    for _ in range(3):
        found = ML.together(*[lambda i=i: job(i) for i in range(8)])
        assert found == [[sum(range(50 + i))] * 15 for i in range(8)]
