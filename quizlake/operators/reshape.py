"""Question table: checks, answer resolution, option rows, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quizlake.functions import text as T, values as V

REQUIRED = ["article", "question", "A", "B", "C", "D", "answer"]


def check_columns(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def answer_label() -> Column:
    return T.strip(F.coalesce(F.col("answer"), F.lit("")))


def resolve_answer(df: DataFrame) -> DataFrame:
    """Attach ``correct_answer``: the option named by the label, else empty."""
    label = answer_label()
    picked = F.when(label == "A", F.col("A"))
    for name in V.LABELS[1:]:
        picked = picked.when(label == name, F.col(name))
    return df.withColumn("correct_answer", F.coalesce(picked, F.lit("")))


def load_questions(df: DataFrame) -> DataFrame:
    return resolve_answer(check_columns(df))


def load_clean_questions(df: DataFrame) -> DataFrame:
    return check_columns(df).dropna(subset=["article", "question", "answer"])


def reject_reason() -> Column:
    """Why a question row cannot be used; null when it can."""
    return (
        F.when(F.col("article").isNull(), "missing article")
        .when(F.col("question").isNull(), "missing question")
        .when(F.col("answer").isNull(), "missing answer")
        .when(~answer_label().isin(V.LABELS), "unknown answer label")
        .when(F.col("correct_answer") == "", "missing answer text")
    )


def usable_questions(df: DataFrame) -> DataFrame:
    """Rows every later step can use, with the label trimmed."""
    checked = load_questions(df)
    return checked.where(reject_reason().isNull()).withColumn("answer", answer_label())


def rejected_questions(df: DataFrame) -> DataFrame:
    return (
        load_questions(df).select("row_id", reject_reason().alias("reason")).where("reason is not null")
    )


def explode_options(df: DataFrame, keep: list[str]) -> DataFrame:
    """Four rows per question: ``label, option_text, is_correct``."""
    parts = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.col(name).alias("option_text"),
                (answer_label() == name).cast("int").alias("is_correct"),
            )
            for name in V.LABELS
        ]
    )
    return df.select(*keep, F.inline(parts))


def clean_option_rows(df: DataFrame) -> DataFrame:
    return explode_options(
        df.withColumn("clean_article", T.clean_text(F.col("article"))).withColumn(
            "clean_question", T.clean_text(F.col("question"))
        ),
        ["row_id", "clean_article", "clean_question"],
    ).select(
        "row_id",
        "label",
        "clean_article",
        "clean_question",
        T.clean_text(F.col("option_text")).alias("clean_option"),
        "is_correct",
    )


def starts_with_wh(question: Column) -> Column:
    return F.lower(question).rlike("^(" + "|".join(V.WH_FILTER_WORDS) + ")")


def sample_key(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(k) for k in keys]))


def sample_rows(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` rows in an order fixed by the seed: a top-k, no full sort."""
    return df.orderBy(sample_key(seed, *keys), *keys).limit(n)


def bucket(key: Column) -> Column:
    """0..99 from the hash of a key; the same in every engine with md5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100


def split_three(df: DataFrame, key: Column) -> DataFrame:
    b = bucket(key)
    return df.withColumn(
        "split", F.when(b < 80, "train").when(b < 90, "validation").otherwise("test")
    )


def split_two(df: DataFrame, key: Column, train_share: int) -> DataFrame:
    return df.withColumn("split", F.when(bucket(key) < train_share, "train").otherwise("test"))


def balance_classes(df: DataFrame, label: str, seed: int, *keys: str) -> DataFrame:
    """All positives and exactly as many negatives, chosen by hash order.

    The negatives are a global top-k by hash, found by a threshold: hash buckets
    are counted, whole buckets below the border are taken without ranking and
    only the border bucket is ranked.  No task sees a whole class.
    """
    order = sample_key(seed, *keys)
    keyed = df.withColumn("_h", order).withColumn("_b", F.substring("_h", 1, 4))
    sizes = keyed.groupBy("_b").agg(
        F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
    )
    # at most 65,536 buckets whatever the input size, so one task may order them
    running = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_b").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    border = (
        sizes.select(
            "_b",
            "n0",
            F.coalesce(F.sum("n0").over(running), F.lit(0)).alias("before"),
            F.sum("n1").over(everything).alias("wanted"),
        )
        .where("before < wanted")
        .select("_b", (F.col("wanted") - F.col("before")).alias("room"), "n0")
    )
    negatives = keyed.where(F.col(label) == 0).join(border, "_b")
    whole = negatives.where("n0 <= room")
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys))
    part = negatives.where("n0 > room").withColumn("_r", rank).where("_r <= room").drop("_r")
    return (
        keyed.where(F.col(label) == 1)
        .select(df.columns)
        .unionByName(whole.unionByName(part).select(df.columns))
    )


def seq2seq_rows(df: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """Training pairs of all Wh questions, or of ``n`` of them chosen by hash order.
    Only the keys are ranked; the texts stay where they are.  Rows that share the
    last chosen key all stay."""
    picked = df.where(starts_with_wh(F.col("question")))
    if n is not None:
        keys = sample_rows(picked.select("row_id"), n, seed, "row_id").select(F.col("row_id").alias("_k"))
        picked = picked.join(keys, F.col("row_id").eqNullSafe(F.col("_k")), "left_semi")
    return picked.select(
        "row_id",
        F.concat(
            F.lit("generate question: context: "),
            T.clean_text(F.col("article")),
            F.lit(" answer: "),
            T.clean_text(F.col("correct_answer")),
        ).alias("input_text"),
        T.clean_text(F.col("question")).alias("target_text"),
    )


def titles(df: DataFrame) -> DataFrame:
    """``(title, article)`` per distinct title; the last row of a title wins.

    A passage too short for a title gets its key instead of a row number.
    """
    text = T.strip(F.coalesce(F.col("article"), F.lit("")))
    first = T.strip(F.substring_index(text, ".", 1))
    short = F.when(F.length(first) > 55, F.concat(F.substring(first, 1, 55), F.lit("…"))).otherwise(first)
    named = df.select(
        "doc_id",
        text.alias("article"),
        F.when(F.length(short) < 5, F.concat(F.lit("Passage "), F.col("doc_id")))
        .otherwise(short)
        .alias("title"),
    )
    return named.groupBy("title").agg(F.max_by("article", "doc_id").alias("article"))


def options_for_candidate(answer: Column, others: Column | None = None) -> Column:
    """The candidate answer, then ``others`` (the human options if not given), then
    fixed fillers: the first four texts that differ when lower-cased."""
    human = F.array(*[F.col(n) for n in V.LABELS]) if others is None else others
    pool = F.concat(F.array(answer), human, F.array(*[F.lit(f) for f in V.FIXED_FILLERS]))
    pool = F.filter(pool, lambda x: x.isNotNull())
    return F.slice(
        F.aggregate(
            pool,
            F.array().cast("array<string>"),
            lambda acc, x: F.when(
                F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc
            ).otherwise(F.concat(acc, F.array(x))),
        ),
        F.lit(1),
        F.lit(4),
    )
