"""Evaluation metrics and corpus reports as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quizlake.functions import text as T, values as V
from quizlake.sources.storage import settle


def confusion(df: DataFrame, label: str, predicted: Column, *by: str) -> DataFrame:
    y, p = F.col(label) == 1, predicted
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(y & ~p).alias("fn"),
    )


def binary_metrics(counts: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    out = counts.withColumn("accuracy", safe(tp + tn, tp + fp + tn + fn))
    out = out.withColumn("precision", safe(tp, tp + fp)).withColumn("recall", safe(tp, tp + fn))
    return out.withColumn("f1", safe(F.lit(2) * tp, F.lit(2) * tp + fp + fn))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Rank statistic with ties counted half; 0 when a class is missing.

    Exact for any number of distinct scores: these are range-partitioned, each
    range adds up its own counts, and the totals of the ranges before it come
    from a table with one row per range.
    """
    steps = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    steps = settle(steps.repartitionByRange("s").withColumn("part", F.spark_partition_id()))
    before = lambda w: F.coalesce(F.sum("neg").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = steps.groupBy("part").agg(F.sum("neg").alias("neg"))
    ranges = ranges.select("part", before(Window.orderBy("part")).alias("lower"))
    inside = steps.withColumn("below", before(Window.partitionBy("part").orderBy("s")))
    parts = inside.join(ranges, "part").withColumn(
        "wins", F.col("pos") * (F.col("lower") + F.col("below") + F.col("neg") * 0.5)
    )
    return parts.agg(
        F.coalesce(
            F.try_divide(F.sum("wins"), (F.sum("pos") * F.sum("neg")).cast("double")), F.lit(0.0)
        ).alias("roc_auc")
    )


def mcq_accuracy(df: DataFrame, key: str, option: str, label: str, score: str) -> DataFrame:
    """Share of questions whose best-scored option is the right one; the
    earliest option wins a tie."""
    best = df.groupBy(key).agg(
        F.max_by(label, F.struct(F.col(score), -F.ascii(option))).alias("hit")
    )
    return best.agg(F.count("*").alias("n_questions"), F.avg("hit").alias("accuracy"))


def ranking_metrics(df: DataFrame) -> DataFrame:
    """``df``: ``group_id, candidate_index, template, target, predicted``.
    Both picks of a group come from one aggregation, without ranking rows."""
    row = F.struct("candidate_index", "target", "template")
    tie = -F.col("candidate_index")
    picks = df.groupBy("group_id").agg(
        F.max_by(row, F.struct(F.col("predicted"), tie)).alias("chosen"),
        F.max_by(row, F.struct(F.col("target"), tie)).alias("oracle"),
    )
    share = lambda c: F.avg(c.cast("double"))
    return picks.agg(
        F.count("*").alias("n_groups"),
        share(F.col("chosen.candidate_index") == F.col("oracle.candidate_index")).alias("top1_match"),
        F.avg("chosen.target").alias("chosen_mean_target"),
        F.avg("oracle.target").alias("oracle_mean_target"),
        share(F.col("chosen.template") == "cloze").alias("chosen_cloze_rate"),
        share(F.col("oracle.template") == "cloze").alias("oracle_cloze_rate"),
    )


def gold_parts(question: Column) -> Column:
    """What ``training_target`` compares of a human question."""
    return T.let(
        T.apostrophe_tokens(question),
        lambda tokens: F.struct(
            F.array_distinct(tokens).alias("tokens"),
            T.bigrams(tokens).alias("pairs"),
            T.wh_type(question).alias("wh"),
            F.lower(question).rlike("_|complete|fill").alias("cloze"),
        ),
    )


def training_target(df: DataFrame) -> DataFrame:
    """Add ``target``: how close a generated question is to the human one.
    ``gold``: ``gold_parts(gold_question)``, given where many questions share it; it goes."""
    w = V.TARGET_WEIGHTS
    q, g = F.col("question"), F.col("gold")
    staged = df if "gold" in df.columns else df.withColumn("gold", gold_parts(F.col("gold_question")))
    staged = staged.withColumn("_qt", T.apostrophe_tokens(q)).withColumn("_wq", T.wh_type(q))
    qt = F.col("_qt")
    similar = (
        T.tokens_f1(F.array_distinct(qt), g["tokens"]) * F.lit(w["unigram"])
        + T.share_of(T.bigrams(qt), g["pairs"]) * F.lit(w["bigram"])
        + F.when((F.col("_wq") != "") & (F.col("_wq") == g["wh"]), F.lit(w["wh"])).otherwise(F.lit(0.0))
    )
    right = F.lower("answer_text") == F.lower("correct_answer")
    gold_cloze = g["cloze"]
    factor = lambda cond, f: F.when(cond, F.lit(f)).otherwise(F.lit(1.0))
    target = (
        similar
        * factor(~right, V.WRONG_ANSWER_FACTOR)
        * factor((F.col("template") == "cloze") & ~gold_cloze, V.CLOZE_FACTOR)
        * factor(T.bad_question(q, qt), V.BAD_QUESTION_FACTOR)
    )
    return staged.withColumn("target", target).drop("gold", "_qt", "_wq")


def label_group(
    df: DataFrame,
    group: str = "group_id",
    positive: float = V.POSITIVE_THRESHOLD,
    negative: float = V.NEGATIVE_THRESHOLD,
) -> DataFrame:
    """Add ``label``.  A group is the questions of one row: at most the answers
    considered times the templates, so its window is small."""
    order = Window.partitionBy(group).orderBy(F.desc("target"), "candidate_index")
    clear = max(positive + V.CLEAR_POSITIVE_STEP, V.CLEAR_POSITIVE_FLOOR)
    label = (
        F.when(F.col("target") <= negative, 0)
        .when((F.col("_r") == 1) & (F.col("target") >= positive), 1)
        .when(F.col("target") >= clear, 1)
        .otherwise(0)
    )
    return df.withColumn("_r", F.row_number().over(order)).withColumn("label", label).drop("_r")


# -- reports ---------------------------------------------------------------------------


def word_count(c: Column) -> Column:
    return F.size(T.split_words(F.coalesce(c, F.lit(""))))


def describe(df: DataFrame, column: str, name: str) -> DataFrame:
    """Count, mean, deviation and exact quartiles of whole numbers, from the
    counts of distinct values: the percentile reads (value, frequency) pairs."""
    counted = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    n, v = F.col("n"), F.col("v").cast("double")
    total = F.sum("n")
    mean = F.sum(v * n) / total
    var = (F.sum(v * v * n) - F.sum(v * n) * F.sum(v * n) / total) / (total - 1)
    q = lambda p: F.percentile("v", p, F.col("n"))
    return counted.agg(
        total.alias("n_rows"),
        mean.alias("mean"),
        F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"),
        F.min("v").alias("min"),
        q(0.25).alias("q25"),
        q(0.5).alias("median"),
        q(0.75).alias("q75"),
        F.max("v").alias("max"),
    ).select(F.lit(name).alias("column"), "*")


def histogram(df: DataFrame, column: str, bins: int, name: str) -> DataFrame:
    """Equal bins between the smallest and largest value, the last one closed.
    Works on counts of distinct values, which are few for token counts."""
    counted = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    edge = counted.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
    place = F.floor((F.col("v") - lo) * F.lit(bins) / F.greatest(hi - lo, F.lit(1)))
    return (
        counted.groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("n").alias("n_rows"))
        .select(F.lit(name).alias("column"), "bin", "n_rows")
    )
