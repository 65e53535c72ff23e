"""Quizzes of whole passage tables without trained models."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quizlake.functions import text as T
from quizlake.operators import candidates as C, questions as Q


def quiz_drafts(passages: DataFrame, given_answer: str | None = None) -> DataFrame:
    """One draft per passage that has candidates: chosen answer and options."""
    given = None if given_answer is None else F.col(given_answer)
    rows = C.with_candidates(passages).withColumn(
        "correct", Q.choose_candidate(F.col("candidates"), given)
    )
    return rows.withColumn(
        "options",
        F.when(
            F.col("correct").isNotNull(),
            Q.answer_options(F.col("sentences"), F.col("candidates"), F.col("correct")),
        ),
    )


def rule_based_quizzes(passages: DataFrame, given_answer: str | None = None) -> DataFrame:
    """Best candidate, template question, options of the same passage, hints.

    A map over passages: no shuffle.  A passage without candidates or without
    four options gives no quiz and appears in ``quiz_rejects``.
    """
    drafts = quiz_drafts(passages, given_answer)
    answer = F.col("correct.text")
    sentence = F.get("sentences", F.col("correct.sent_idx"))
    seed = F.concat(F.md5("article"), answer)
    shaped = drafts.select(
        "doc_id",
        answer.alias("correct_answer"),
        F.when(
            F.size("options") == 4,
            T.let(
                Q.shuffled(F.col("options"), seed),
                lambda o: F.struct(
                    o.alias("options"),
                    Q.label_of(o, answer).alias("correct_label"),
                    Q.template_question(answer, F.col("correct.kind"), sentence).alias("question"),
                    Q.hints(F.col("sentences"), answer, F.col("correct.sent_idx")).alias("hints"),
                ),
            ),
        ).alias("quiz"),
    )
    # a generator drops the empty drafts; a filter would compute each quiz twice
    return (
        shaped.select(
            "doc_id",
            "correct_answer",
            F.explode(F.filter(F.array("quiz"), lambda q: q.isNotNull())).alias("quiz"),
        )
        .select("doc_id", "correct_answer", "quiz.*")
        .withColumn("option_quality", F.lit("strict"))
    )


def quiz_rejects(passages: DataFrame) -> DataFrame:
    reason = (
        F.when(F.col("correct").isNull(), "no answer candidates")
        .when(F.size("options") < 4, "no four answer options")
    )
    shaped = quiz_drafts(passages).select("doc_id", reason.alias("reason"))
    return shaped.select(
        "doc_id", F.explode(F.filter(F.array("reason"), lambda r: r.isNotNull())).alias("reason")
    )


def flat_quizzes(quizzes: DataFrame) -> DataFrame:
    """Options and hints as plain columns."""
    return quizzes.select(
        "doc_id",
        "question",
        "correct_answer",
        "correct_label",
        *[F.get("options", F.lit(i)).alias(f"option_{n}") for i, n in enumerate("abcd")],
        *[F.get("hints", F.lit(i)).alias(f"hint_{i + 1}") for i in range(3)],
        "option_quality",
    )
