"""The search for options of the same passage ends with the last option needed."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.operators import candidates as C, metrics as M, questions as Q

CANDIDATES = "array<struct<text:string,kind:string,score:double,sent_idx:int>>"


def test_no_candidate_is_judged_after_the_last_option(spark, monkeypatch):
    """A category that fails on "stop" is asked for it only where options are still missing."""

    def category(text, kind, sentence, question):
        return F.when(text == "stop", F.raise_error(F.lit("judged"))).otherwise(F.lit("term"))

    monkeypatch.setattr(C, "answer_category", category)
    texts = ["slab", "Slab", "the slab", None, "stone", "STONE", "script", "valley", "stop"]
    rows = [(["A slab."], [(t, "keyword", 1.0, 0) for t in texts])]
    df = spark.createDataFrame(rows, f"ss array<string>, cs {CANDIDATES}")
    found = Q.compatible_entries(F.col("ss"), F.col("cs"), F.get("cs", F.lit(0)), F.lit(""), 3)
    assert df.select(found.alias("o")).first().o == ["stone", "script", "valley"]


def test_all_fitting_texts_where_there_is_no_limit(spark):
    rows = [(["A slab of 12."], [(t, "keyword", 1.0, 0) for t in ["slab", "stone", "12", "stone", None]])]
    df = spark.createDataFrame(rows, f"ss array<string>, cs {CANDIDATES}")
    found = Q.compatible_entries(F.col("ss"), F.col("cs"), F.get("cs", F.lit(0)), F.lit(""), None)
    assert df.select(found.alias("o")).first().o == ["stone", "stone"]


def test_gold_questions_are_read_once_a_passage(spark):
    """A target reads what is given of the human question, and equals the one made from its text."""
    rows = [("q?", "Who found it?", "slab", "slab", "cloze"), (None, "Fill in", "a", "b", "suffix_wh"), ("Who found a slab?", None, "a", None, "x"),
            ("Who has found it here?", "Who found it?", "Slab", "slab", "suffix_wh")]
    df = spark.createDataFrame(rows, "question string, gold_question string, answer_text string, correct_answer string, template string")
    plain = M.training_target(df)
    given = M.training_target(df.withColumn("gold", M.gold_parts(F.col("gold_question"))))
    assert plain.columns == given.columns == [*df.columns, "target"]
    assert plain.collect() == given.collect()
    other = df.withColumn("gold", M.gold_parts(F.lit("Who has found it here?")))
    assert round(M.training_target(other).collect()[3].target, 9) == 1.0
