"""Entries of a question read its answer and article once, and give what whole texts give."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog import options as CO
from quizlake.functions import text as T
from quizlake.operators import candidates as C, features as X, options as OP

ANSWERS = ["the slab", "Slab of 1912", "!", None, "ΣΑΣ slab"]
TEXTS = ["Slab", "the  slab of\tstone", "none", "", "a " * 40, "x" * 221, " " * 300 + "stone", "Script, of the valley", "İ K 12"]
ARTICLES = ["A Slab. The script of the valley was found in 1912.", "", None]


def test_bound_parts_equal_the_expressions_on_whole_texts(spark):
    rows = [(a, t, c) for a in ANSWERS for t in TEXTS for c in ARTICLES]
    df = spark.createDataFrame(rows, "answer string, text string, article string").withColumn("option_key", T.option_key(F.col("text")))
    answer, text, e = F.col("answer"), F.col("text"), F.struct("text", "option_key")
    x = OP._text_parts(e)
    asked = OP._question(answer, F.col("article"))
    bound = T.let(asked, lambda a: T.let(x, lambda p: F.struct(
        *X.answered_features(a, text, p["low"], a["low"]),
        T.lengths_compatibility(a["answer_size"], T.log_length(p["n_tokens"])).alias("length_score"),
        T.usable_entry(text, F.col("option_key"), p["n_tokens"], a["answer_key"]).alias("usable"),
        T.contains_padded(a["padded"], F.col("option_key")).alias("in_passage"))))
    plain = F.struct(
        *X.distractor_features(answer, text, F.lower("article")),
        T.length_compatibility(answer, text).alias("length_score"),
        T.usable_option(text, answer).alias("usable"),
        T.contains_key(T.option_key(F.col("article")), F.col("option_key")).alias("in_passage"))
    for r in df.select("answer", "text", "article", bound.alias("a"), plain.alias("b")).collect():
        assert r["a"] == r["b"], r


def test_no_step_of_a_question_is_repeated_for_its_entries(spark, folder):
    """The article and the answer stand outside the expression that is run for each entry."""
    drafts = spark.createDataFrame(
        [("q", "A slab. A stone.", [("slab", "keyword", 1.0, 0)], ("slab", "keyword", 1.0, 0), "Who?", "term")],
        "q_id string, article string, candidates array<struct<text:string,kind:string,score:double,sent_idx:int>>, "
        "correct struct<text:string,kind:string,score:double,sent_idx:int>, question string, category string")
    found = spark.createDataFrame(
        [("q", [("stone", "o1", "stone", "term", 0.5), ("slab", "o2", "slab", "term", 0.4)])],
        "q_id string, found array<struct<option_key:string,opt_id:string,text:string,option_category:string,score:double>>")
    made = OP.with_entries(drafts, found)
    assert [(e["text"], e["usable"], e["in_passage"]) for e in made.first()["pool"]] == [("stone", True, True), ("slab", False, True)]
    pool = made.select("q_id", F.inline("pool")).select("key", "in_passage")
    plan = pool._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("levenshtein(") == 1
