"""Votes, predictions and grades."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions import text as T, values as V


def soft_vote(*probabilities: Column) -> Column:
    """Mean of the probabilities that are present; null if none is."""
    known = F.filter(F.array(*probabilities), lambda p: p.isNotNull())
    return T.let(
        known,
        lambda k: F.when(
            F.size(k) > 0, F.aggregate(k, F.lit(0.0), lambda a, p: a + p) / F.size(k)
        ),
    )


def predict_label(
    options: Column,
    article: Column | None,
    sentence: Column,
    tolerance: float = V.TIE_TOLERANCE,
    spot: Callable[[Column], Column] | None = None,
) -> Column:
    """``options``: array of ``label, text, p``.  The best-scored label; scores
    within the tolerance are settled by presence in the source sentence, then
    the earliest place in the article, then a length near two words, then the
    earlier label.  ``spot`` gives an option's place (from 1, 0 if absent) where
    it is known and no article is at hand."""

    def settle(scope: Column) -> Column:
        best = F.array_max(F.transform(options, lambda o: o["p"]))
        tied = F.filter(options, lambda o: o["p"] >= best - F.lit(tolerance))

        def key(o: Column) -> Column:
            low = F.lower(o["text"])
            at = F.call_function("instr", scope["article"], low) if spot is None else spot(o)
            return F.struct(
                (~F.contains(scope["sentence"], low)).cast("int").alias("absent"),
                F.when(at == 0, F.lit(10**9)).otherwise(at - 1).alias("spot"),
                F.abs(F.size(T.split_words(T.strip(o["text"]))) - 2).alias("length"),
                o["label"].alias("label"),
            )

        return F.array_min(F.transform(tied, key))["label"]

    return T.let(
        F.struct(F.lower(F.lit("") if article is None else article).alias("article"), F.lower(sentence).alias("sentence")), settle
    )


def rank_of_correct(scored: DataFrame, key: str) -> DataFrame:
    """Per question: the right option's score, the best other, margin, rank and
    spread.  A question has four options, so its scores fit one small array."""
    one = scored.groupBy(key).agg(
        F.max(F.when(F.col("is_correct") == 1, F.col("p"))).alias("correct_score"),
        F.max(F.when(F.col("is_correct") == 0, F.col("p"))).alias("best_other"),
        (F.max("p") - F.min("p")).alias("spread"),
        F.collect_list("p").alias("_all"),
    )
    return one.where("correct_score is not null").select(
        key,
        "correct_score",
        "best_other",
        (F.col("correct_score") - F.col("best_other")).alias("margin"),
        (F.size(F.filter("_all", lambda p: p > F.col("correct_score"))) + 1).alias("rank"),
        "spread",
    )


def grade_attempts(attempts: DataFrame, keys: DataFrame) -> DataFrame:
    """``attempts(event_id, row_id, selected)`` against the answer key."""
    graded = attempts.join(keys, "row_id")
    choice = F.when(F.col("selected") == "A", F.col("A"))
    for name in V.LABELS[1:]:
        choice = choice.when(F.col("selected") == name, F.col(name))
    return graded.select(
        *attempts.columns,
        F.col("answer").alias("correct_label"),
        "correct_answer",
        choice.alias("selected_option"),
        (F.col("selected") == F.col("answer")).cast("int").alias("is_correct"),
    )
