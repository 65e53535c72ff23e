"""Input tables: the given parquet files and the passage and question tables
derived from them without any shuffle of the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quizlake.functions import text as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core work when a table lies in fewer splits than there are
    cores; a table of many files is left as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _part_names(spark: SparkSession, folder: str) -> DataFrame:
    """Part rows with the names used in their passage.  ``region`` has a fixed
    handful of rows; the join side is left to the size check of Spark."""
    part = spread(table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_size"))
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    name = F.col("p_name")
    gap = F.call_function("instr", name, F.lit(" "))
    cap = lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))
    return (
        part.join(region, (F.col("p_partkey") % 5).cast("int") == F.col("r_regionkey"))
        .select(
            "p_partkey",
            "p_name",
            "p_type",
            F.substr(name, F.lit(1), gap - 1).alias("first"),
            F.concat(
                cap(F.substr(name, F.lit(1), gap - 1)), F.lit(" "), cap(F.substr(name, gap + 1))
            ).alias("nm"),
            F.concat(F.substring("r_name", 1, 1), F.lower(F.substr("r_name", F.lit(2)))).alias("rg"),
            (F.col("p_size") + 1900).cast("string").alias("yr"),
        )
        .withColumn("first", cap(F.col("first")))
    )


def _part_article() -> Column:
    c = F.col
    return F.concat(
        F.lit("In July "), c("yr"), F.lit(", during "), c("first"),
        F.lit("'s campaign, a soldier named "), c("nm"),
        F.lit(" discovered a large slab in the city of "), c("rg"),
        F.lit(". It is widely known as the "), c("p_name"),
        F.lit(" of the valley, because it generates most of the supply. The "), c("p_type"),
        F.lit(" panel provided the translation needed to unlock the script. "), c("nm"),
        F.lit(" Agency was launched near "), c("rg"), F.lit(" Harbor in "), c("yr"),
        F.lit(". The treaty was signed at the University of "), c("rg"), F.lit("."),
    )


def passages(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, article)``: one row per part and one per document."""
    parts = _part_names(spark, folder).select(
        F.concat(F.lit("p"), F.col("p_partkey")).alias("doc_id"), _part_article().alias("article")
    )
    docs = spread(table(spark, folder, "documents").select("doc_id", "text")).select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"),
        T.ascii_only(F.col("text")).alias("article"),
    )
    return parts.unionByName(docs)


def _place_options(df: DataFrame) -> DataFrame:
    """Put ``ans`` in the column named by ``label`` and d1..d3 in the others."""
    cols = []
    for i, name in enumerate("ABCD"):
        # left of the answer the i-th wrong option, right of it the (i-1)-th
        cols.append(
            F.when(F.col("label") == name, F.col("ans"))
            .when(F.col("label") > name, F.col(f"d{min(i + 1, 3)}"))
            .otherwise(F.col(f"d{max(i, 1)}"))
            .alias(name)
        )
    row = F.struct("row_id", "article", "question", *cols, "answer")
    # emitted by a generator, so that filters of later steps read the finished
    # columns and do not pull the expressions behind them into their conditions
    return df.select(F.inline(F.array(row)))


def raw_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Seven string columns and a key, with bad rows: an unknown label, padded
    labels, missing questions, missing articles and missing options."""
    docs = spread(table(spark, folder, "documents").select("doc_id", "text"))
    docs = docs.select("doc_id", T.ascii_only(F.col("text")).alias("article"))
    docs = docs.withColumn("tk", T.alnum_tokens(F.col("article")))
    t = lambda i: F.get("tk", F.lit(i))
    three = lambda *cols: F.when(F.size("tk") >= 20, F.concat_ws(" ", *cols))
    blank = F.concat_ws(" ", t(0), t(1), t(2), F.lit("_____"), t(6), t(7))
    kind = F.col("doc_id") % 6
    question = (
        F.when(kind == 0, F.concat(F.lit("Which answer best completes this sentence: "), blank, F.lit("?")))
        .when(kind == 1, F.concat(F.lit("What comes between "), t(2), F.lit(" and "), t(6), F.lit("?")))
        .when(kind == 2, F.concat(F.lit("Who wrote "), blank, F.lit(" ?")))
        .when(kind == 3, F.concat(F.lit("Where is "), blank, F.lit(" found?")))
        .when(kind == 4, F.concat(F.lit("Complete the sentence: "), blank))
        .otherwise(F.concat(F.lit("How does the passage continue after "), t(0), F.lit(" "), t(1), F.lit("?")))
    )
    label = F.substr(F.lit("ABCD"), (F.col("doc_id") % 4 + 1).cast("int"), F.lit(1))
    marker = F.col("doc_id") % 50
    from_docs = _place_options(
        docs.select(
            F.concat(F.lit("d"), F.col("doc_id")).alias("row_id"),
            F.when(marker != 13, F.col("article")).alias("article"),
            F.when(marker != 11, question).alias("question"),
            three(t(3), t(4), t(5)).alias("ans"),
            three(t(9), t(12), t(15)).alias("d1"),
            three(t(10), F.reverse(t(13)), t(16)).alias("d2"),
            three(F.reverse(t(11)), t(14), F.reverse(t(17))).alias("d3"),
            label.alias("label"),
            F.when(marker == 7, F.lit("E"))
            .when(marker == 9, F.concat(F.lit(" "), label, F.lit(" ")))
            .otherwise(label)
            .alias("answer"),
        )
    )
    key = F.col("p_partkey")
    part_label = F.substr(F.lit("ABCD"), (key % 4 + 1).cast("int"), F.lit(1))
    part_kind = key % 3
    from_parts = _place_options(
        _part_names(spark, folder).select(
            F.concat(F.lit("p"), key).alias("row_id"),
            _part_article().alias("article"),
            F.when(part_kind == 0, F.lit("Which name was given to the soldier?"))
            .when(part_kind == 1, F.concat(F.lit("Who discovered a large slab in the city of "), F.col("rg"), F.lit("?")))
            .otherwise(F.concat(F.lit("What agency was launched near "), F.col("rg"), F.lit(" Harbor?")))
            .alias("question"),
            F.col("nm").alias("ans"),
            F.when(part_kind == 2, F.concat(F.lit("the "), F.col("p_name"), F.lit(" of the valley")))
            .otherwise(F.concat(F.col("rg"), F.lit(" Harbor")))
            .alias("d1"),
            F.when(part_kind == 0, F.col("p_type")).otherwise(F.col("yr")).alias("d2"),
            F.concat(F.col("first"), F.lit(" "), F.col("rg")).alias("d3"),
            part_label.alias("label"),
            part_label.alias("answer"),
        )
    )
    return from_docs.unionByName(from_parts)
