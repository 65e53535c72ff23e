"""The share of a question's pairs of words that its sentence holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.operators import features as X


def test_pairs_of_a_question_in_its_sentence(spark):
    texts = ["", "one", "a b a b", "b a it's it's it's", "ab a", "a ba b", None, "the a b c"]
    pairs = [(i * 10 + j, q, s) for i, q in enumerate(texts) for j, s in enumerate(texts)]
    df = spark.createDataFrame(pairs, "doc_id int, question string, sentence string").select(
        "*", F.lit("a").alias("answer_text"), F.lit("date").alias("answer_kind"), F.lit(0.5).alias("answer_score"),
        F.lit(0).alias("sent_idx"), F.lit("cloze").alias("template"), F.lit("").alias("wh_word"),
        F.lit(1).alias("n_sentences"), F.lit(0.0).alias("article_overlap"),
    )
    rows = X.ranker_features(df).select("question", "sentence", "question_source_bigram_overlap").collect()
    tokens = lambda t: t.lower().split()
    two = lambda t: {p for p in zip(tokens(t), tokens(t)[1:])}
    assert len(rows) == len(pairs)
    for q, s, made in rows:
        mine = two(q) if q is not None else set()
        want = 0.0 if not mine else None if s is None else len(mine & two(s)) / len(mine)
        assert made == want, (q, s)
    plan = X.ranker_features(df).select("question_source_bigram_overlap")._jdf.queryExecution().optimizedPlan().toString()
    # the pairs of the sentence are not built for each of its questions
    assert "array_intersect" not in plan
