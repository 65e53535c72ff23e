"""Spark against DuckDB on the smallest tables."""

import pytest

from check import canonical
from quizlake.catalog import ORACLES, QUERIES

# one or two per module; check.py compares all of them
FAST = [
    "load_questions", "reject_sink", "explode_options", "split_rows", "balance_classes", "titles",
    "sentences", "candidates", "retag_person", "best_source_sentence", "answer_category",
    "q_definition", "q_where", "question_candidates", "hints", "rule_based_quizzes", "quiz_rejects",
    "tokens", "token_phrase", "length_compatibility", "idf", "tfidf", "corpus_vocabulary",
    "verifier_features", "label_group", "distractor_training_rows", "confusion", "roc_auc",
    "mcq_accuracy", "ranking_metrics", "length_stats", "label_distribution", "predict_answer",
    "choose_bundle", "embedding_neighbours",
]


@pytest.mark.parametrize("name", FAST)
def test_equals_duckdb(spark, duck, folder, name):
    got = QUERIES[name](spark, folder).toPandas()
    want = duck.execute(ORACLES[name]).fetch_df()
    assert sorted(got.columns) == sorted(want.columns)
    assert [repr(r) for r in canonical(got)] == [repr(r) for r in canonical(want)]


def test_every_check_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
