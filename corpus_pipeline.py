"""The corpus pipeline: stages applied one after another to ``documents``.

Each stage gets all rows that the one before kept, reread from Parquet, and
returns the columns of ``documents``; the last one adds the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quizlake.llm import bpe, decontaminate, jaccard_join, line_dedup, toxicity
from quizlake.llm.common import fresh, spread, table
from quizlake.llm.queries import tokenizer_file
from quizlake.sources.storage import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.keep_clean(spread(docs), table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut from the texts.  A document that
    loses every line with a word is a copy of earlier text as a whole, and goes;
    one that had none stays."""
    lines, removed = (fresh(c, docs.columns) for c in ("n_lines", "n_removed"))
    cut = line_dedup.cleaned(docs, n_lines=lines, n_removed=removed)
    cut = cut.filter((F.col(removed) == 0) | (F.col(removed) < F.col(lines)))
    length = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the first document stays."""
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a test item go."""
    return decontaminate.keep_clean(spread(docs), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the text that they decode to."""
    return bpe.encode(spread(docs), tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Training, alignment and encoding are beyond SQL; tests/llm compares each stage
#: with a plain form of it, and the whole run with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
