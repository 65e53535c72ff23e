"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Stands for a missing document id in join keys, so that null ids meet too.
NO_ID = -(2**63)
#: Entries of a worker's memo of word hashes; it is emptied when full, which
#: changes no result.
MEMO = 100_000


class WordHashes(dict):
    """Hash of each word, computed when first met."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


#: One memo for all operators of a worker.
HASHES = WordHashes()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that clashes with none of ``taken`` (case aside)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def identity(doc_id: Column, text: Column) -> list[Column]:
    """Key of a document: its id (null has a value of its own) and two hashes
    of its text.  Rows equal in id and text are one document."""
    return [
        F.coalesce(doc_id.cast("long"), F.lit(NO_ID)).alias("d"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("t"),
    ]


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo n; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def sampled(rows: DataFrame, bound: int, *key: Column) -> DataFrame:
    """At most about ``bound`` rows, chosen by a hash of ``key``: all rows while
    there are no more than that.  For training rows of classifiers only."""
    n = rows.count()
    if n <= bound:
        return rows
    return rows.filter(F.pmod(F.xxhash64(*key, F.lit(n)), F.lit(1_000_000)) < int(1_000_000 * bound / n))


def spread(rows: DataFrame, least: int = 1) -> DataFrame:
    """Deal rows evenly over the cores where there are fewer input splits."""
    cores = max(least, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
