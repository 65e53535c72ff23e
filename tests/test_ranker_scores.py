"""Verifier scores as features of the question ranker."""

import math

import pytest
from pyspark.sql import functions as F

from quizlake.catalog.corpora import scored_rows, training_questions
from quizlake.catalog.tables import usable
from quizlake.functions import values as V
from quizlake.operators import corpus as K, features as X, reshape as R
from quizlake.plans import model_quizzes as MQ, models as ML
from quizlake.sources import storage, tables as S

NAMES = V.RANKER_FEATURES[-5:]


def test_many_questions_on_an_article_have_the_features_of_each_alone(spark, folder):
    questions = storage.settle(usable(spark, folder))
    vocab = storage.settle(K.vocabulary(K.question_documents(questions)))
    items = X.option_items(questions)
    odd = [
        ("empty", "", "Who?", [("A", ""), ("B", "x")]),
        ("none", None, None, [("A", "the the the")]),
        ("twice", "The town is old. The town is old.", "What is old old?", [("A", "town"), ("B", "town"), ("C", "zzzz 1999")]),
    ]
    items = items.unionByName(spark.createDataFrame(odd, "row_id string, article string, question string, options array<struct<label: string, text: string>>"))
    one = F.struct(F.col("row_id").alias("item"), "question", "options")
    groups = items.groupBy(F.coalesce(F.md5("article"), F.lit("none")).alias("group_id")).agg(F.first("article").alias("article"), F.collect_list(one).alias("asked"))
    wanted = {(r["row_id"], r["label"]): r for r in X.verifier_features(items, vocab).collect()}
    got = {(r["item"], r["label"]): r for r in X.asked_features(groups.repartition(3), vocab).collect()}
    assert got.keys() == wanted.keys() and len(got) > 1000
    for key, r in got.items():
        for n in X.BASE_COLUMNS:
            same = r[n] == wanted[key][n] if r[n] is None or wanted[key][n] is None else math.isclose(r[n], wanted[key][n], abs_tol=1e-9)
            assert same, (key, n)
    assert X.asked_features(groups.limit(0), vocab).count() == 0


@pytest.mark.parametrize(
    "scores, wanted",
    [
        ([0.5, 0.2, 0.9, 0.5], [0.5, 0.9, -0.4, 2.0, 0.7]),
        ([0.7, 0.7, 0.7, 0.1], [0.7, 0.7, 0.0, 1.0, 0.6]),
        ([0.3], [0.3, 0.0, 0.3, 1.0, 0.0]),
        ([], [0.0] * 5),
        (None, [0.0] * 5),
    ],
)
def test_score_columns(spark, scores, wanted):
    row = spark.createDataFrame([(scores,)], "s array<double>").select(*X.score_columns(F.col("s"))).first()
    assert list(row.asDict()) == NAMES
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(row, wanted, strict=True))


def test_options_of_a_question(spark):
    rows = [("Paris", ["paris", "Rome", None, "Oslo"]), ("x", []), ("x", ["a", "b", "c", "d"]), ("related detail", ["Rome"])]
    made = spark.createDataFrame(rows, "a string, o array<string>").select(R.options_for_candidate(F.col("a"), F.col("o")).alias("t"))
    f = V.FIXED_FILLERS
    assert [r["t"] for r in made.collect()] == [
        ["Paris", "Rome", "Oslo", f[0]], ["x", *f[:3]], ["x", "a", "b", "c"], ["related detail", "Rome", f[1], f[2]]]


@pytest.fixture(scope="module")
def verifiers(spark, folder):
    """Cross-fitted verifiers with small forests and few rounds, and the articles each was trained on."""
    seen, train, svm = [], ML.train_verifier, ML.train_svm_calibrated

    def watched(questions, trees, depth):
        seen.append({r["article"] for r in questions.select("article").collect()})
        return train(questions, 5, 4)

    ML.train_verifier, ML.train_svm_calibrated = watched, lambda rows, keys: svm(rows, keys, max_iter=10)
    try:
        yield ML.cross_fitted(storage.settle(usable(spark, folder))), seen
    finally:
        ML.train_verifier, ML.train_svm_calibrated = train, svm


@pytest.fixture(scope="module")
def scored(spark, folder, verifiers):
    return storage.settle(scored_rows(spark, folder, verifiers[0].scores).select("group_id", "candidate_index", "label", *V.RANKER_FEATURES))


def test_no_verifier_judges_an_article_it_was_trained_on(spark, folder, verifiers):
    made, seen = verifiers
    every = {r["article"] for r in usable(spark, folder).select("article").distinct().collect()}
    assert len(seen) == len(made.parts) == 2 and not seen[0] & seen[1] and seen[0] | seen[1] == every

    class Marked:
        def __init__(self, place):
            self.place = place

        def scores(self, groups):
            return groups.select("group_id", "article", F.lit(self.place).alias("place"))

    groups = usable(spark, folder).select(F.col("row_id").alias("group_id"), "article")
    judged = ML.CrossFitted([Marked(0), Marked(1)]).scores(groups).collect()
    assert len(judged) == groups.count()
    folds = spark.createDataFrame([(a,) for a in every], "article string").select("article", ML.article_fold(2).alias("f")).collect()
    held = {r["article"]: r["f"] for r in folds}
    assert all(r["place"] == held[r["article"]] for r in judged)
    for trained in seen:  # all of one fold, none of the other
        assert len({held[a] for a in trained}) == 1


def test_scored_training_rows_keep_every_question(spark, folder, scored):
    rows = scored.select("group_id", "candidate_index", *NAMES).collect()
    assert len(rows) == len({(r[0], r[1]) for r in rows}) == training_questions(spark, folder).count()
    for n in NAMES:
        assert len({r[n] for r in rows}) > 1
    for r in rows:
        own, other, margin, rank, spread = r[2:]
        assert 0 <= own <= 1 and 0 <= other <= 1 and 0 <= spread <= 1 and rank in (1.0, 2.0, 3.0, 4.0)
        assert math.isclose(margin, own - other, abs_tol=1e-12) and (rank == 1.0) == (margin >= 0)


def test_the_quiz_job_can_rank_with_scores(spark, folder, verifiers, scored):
    texts = MQ.quiz_texts(S.passages(spark, folder).where("doc_id like 'd1%'"))
    ranker = ML.train_rf(ML.assemble(scored, V.RANKER_FEATURES), 5, 4)
    plain = {(r["doc_id"], r["place"]) for r in MQ.ranked_selections(texts, ranker).collect()}
    judged = MQ.ranked_selections(texts, ranker, verifiers[0].parts[0]).collect()
    assert plain == {(r["doc_id"], r["place"]) for r in judged} and len(judged) == len(plain) > 100
