"""Worked passages and invariants of the quizzes made of them."""

import pytest
from pyspark.sql import functions as F

from quizlake.functions import text as T
from quizlake.operators import candidates as C, questions as Q, reshape as R
from quizlake.plans import quizzes as P

TELESCOPE = "The James Webb Space Telescope was launched in December 2021."


def passages(spark, *texts):
    return spark.createDataFrame([(f"t{i}", t) for i, t in enumerate(texts)], "doc_id string, article string")


def one(spark, *columns, **row):
    schema = ", ".join(f"{k} string" for k in row)
    return spark.createDataFrame([tuple(row.values())], schema).select(*columns).first()


def test_named_entity_is_a_candidate(spark):
    rows = C.candidate_rows(passages(spark, TELESCOPE)).collect()
    assert "James Webb Space Telescope" in [r.text for r in rows]


@pytest.mark.parametrize(
    "text,kind,sentence,question",
    [
        (
            "Mitochondria", "properNoun",
            "The Mitochondria is a double-membrane-bound organelle found in most eukaryotic organisms.",
            "What is a double-membrane-bound organelle found in most eukaryotic organisms?",
        ),
        (
            "Pierre-Francois Bouchard", "person",
            "A French soldier named Pierre-Francois Bouchard discovered a large granite slab in the city of Rosetta.",
            "Who discovered a large granite slab in the city of Rosetta?",
        ),
        (
            "two years", "keyword", "The visa is valid for two years from now.",
            "Which answer best completes this sentence: The visa is valid for _____ from now?",
        ),
    ],
)
def test_template_question(spark, text, kind, sentence, question):
    made = Q.template_question(F.col("text"), F.col("kind"), F.col("sentence"))
    assert one(spark, made.alias("q"), text=text, kind=kind, sentence=sentence).q == question


def test_phrases_match_whole_tokens(spark):
    asked = T.contains_phrase(F.col("a"), F.col("b")).alias("hit")
    assert one(spark, asked, a="Students discussed RNA in biology class.", b="RNA").hit
    assert not one(spark, asked, a="I have many fellow international classmates.", b="RNA").hit


def test_definition_and_where_questions(spark):
    made = Q.definition_question(F.col("s"), F.lit(""))
    got = one(spark, made.alias("q"), s="The Mitochondria is famously known as the powerhouse of the cell")
    assert got.q == "What is the Mitochondria is famously known as?"
    where = Q.where_question(F.col("a"), F.col("s"))
    got = one(spark, where.alias("q"), a="University of Rome", s="The treaty was signed at the University of Rome.")
    assert got.q == "Where was the treaty signed at the?"


def test_edge_passages(spark):
    rows = passages(spark, "", "a b c.", "wonderful whispering windmills", None)
    found = {r.doc_id: [c.text for c in r.candidates] for r in C.with_candidates(rows).collect()}
    assert found["t0"] == [] and found["t1"] == [] and found["t3"] == []
    assert found["t2"] == ["wonderful", "whispering", "windmills"]
    assert {r.doc_id for r in P.quiz_rejects(rows).collect()} == {"t0", "t1", "t2", "t3"}


def test_quiz_invariants(spark, folder):
    from quizlake.sources import tables as S

    for r in P.rule_based_quizzes(S.passages(spark, folder)).collect():
        keys = {o.lower() for o in r.options}
        assert len(keys) == 4 and r.correct_answer.lower() in keys
        assert r.options["ABCD".index(r.correct_label)] == r.correct_answer
        assert r.correct_answer.lower() not in r.hints[2].lower()


def test_given_answer(spark):
    text = "In 1990 Anna Berg met Carl Dahl. Emil Falk and Greta Holm left Oslo Harbor. NASA saw Ivan Juhl."
    rows = passages(spark, text).withColumn("given", F.lit("nasa"))
    drafts = P.quiz_drafts(rows, "given").select("correct.text", "correct.kind").first()
    assert (drafts.text, drafts.kind) == ("NASA", "acronym")
    rows = passages(spark, text).withColumn("given", F.lit("someone else"))
    drafts = P.quiz_drafts(rows, "given").select("correct.kind", "correct.score").first()
    assert (drafts.kind, drafts.score) == ("manual", 10.0)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="'answer', 'question'"):
        R.load_questions(spark.createDataFrame([("x", "1", "2", "3", "4")], "article string, A string, B string, C string, D string"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitions_do_not_change_candidates(spark, folder, parts):
    from quizlake.sources import tables as S

    rows = C.candidate_rows(S.passages(spark, folder).repartition(parts))
    got = rows.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64(*rows.columns), F.lit(2**40))).alias("h")).first()
    test_partitions_do_not_change_candidates.seen = getattr(test_partitions_do_not_change_candidates, "seen", got)
    assert got == test_partitions_do_not_change_candidates.seen
