"""Corpus statistics and TF-IDF weights as long tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from quizlake.functions import text as T, values as V

# A vocabulary of at most this many rows (about 3 MB) may be broadcast.
BROADCAST_TERMS = 100_000


def question_documents(questions: DataFrame) -> DataFrame:
    """Articles and questions as separate cleaned documents."""
    return questions.select(
        F.explode(
            F.array(T.clean_text(F.col("article")), T.clean_text(F.col("question")))
        ).alias("text")
    )


def term_statistics(documents: DataFrame) -> DataFrame:
    """``(term, tf, df)`` in one pass.  Both counts ride on one explode and are
    combined before the shuffle, so a frequent term costs one row per task."""
    terms = T.let(
        T.term_tokens(F.col("text")),
        lambda tk: F.concat(
            F.transform(tk, lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
            F.transform(
                F.array_distinct(tk),
                lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df")),
            ),
        ),
    )
    return (
        documents.select(F.inline(terms))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )


def vocabulary(documents: DataFrame, size: int = V.VOCABULARY_SIZE) -> DataFrame:
    """``(term, df, idf)`` of the ``size`` most frequent terms; smooth IDF."""
    n = documents.agg(F.count(F.lit(1))).scalar()
    top = term_statistics(documents).orderBy(F.desc("tf"), "term").limit(size)
    return top.select(
        "term", "df", (F.log((n + F.lit(1)) / (F.col("df") + F.lit(1))) + F.lit(1.0)).alias("idf")
    )


def join_terms(rows: DataFrame, vocab: DataFrame, size: int = V.VOCABULARY_SIZE) -> DataFrame:
    """Inner join on ``term``.  The vocabulary has at most ``size`` rows by its
    definition; it is broadcast only when that bound is small."""
    side = vocab.select("term", "idf")
    return rows.join(F.broadcast(side) if size <= BROADCAST_TERMS else side, "term")


def sublinear(tf: Column, idf: Column) -> Column:
    return (F.lit(1.0) + F.log(tf.cast("double"))) * idf


def places_in(terms: list[str]):
    """A function of a column of lists of lists of terms: their places in ``terms``,
    those of unknown ones left out, repeated ones kept.  For vocabularies, whose size is
    bounded: the list is sent to every task."""

    @F.arrow_udf("array<array<int>>")
    def places(lists: pa.Array) -> pa.Array:
        inner = lists.flatten()
        words = inner.flatten()
        found = pc.index_in(words, value_set=pa.array(terms, words.type))
        before = np.concatenate([[0], np.cumsum(found.is_valid().to_numpy(zero_copy_only=False))])
        starts = lambda a: a.offsets.to_numpy() - a.offsets[0].as_py()
        kept = pa.ListArray.from_arrays(pa.array(before[starts(inner)], pa.int32()), found.drop_null())
        return pa.ListArray.from_arrays(pa.array(starts(lists), pa.int32()), kept)

    return places


def counted(rows: np.ndarray, places: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct ``row * len(idf) + place`` with the row and the sublinear weight of each."""
    keys, tf = np.unique(rows.astype(np.int64) * max(1, len(idf)) + places, return_counts=True)
    row, place = np.divmod(keys, max(1, len(idf)))
    return keys, row, (1.0 + np.log(tf)) * idf[place]


def dealt(texts: DataFrame, key: str) -> DataFrame:
    """``texts`` distributed by ``key`` in as many parts as the session sets for shuffles.
    A number that is named is kept: left to itself Spark joins small parts by the size
    of their texts, and the terms counted in a joined part take many times that memory."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(parts, key)


def weights(texts: DataFrame, key: str, vocab: DataFrame, size: int = V.VOCABULARY_SIZE) -> DataFrame:
    """``(key, term, weight)`` with unit norm per key.

    The texts are distributed by key once; counting and the norm then need no
    further exchange.
    """
    counted = (
        dealt(texts.select(key, "text"), key)
        .select(key, F.explode(T.term_tokens(F.col("text"))).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )
    raw = join_terms(counted, vocab, size).withColumn("raw", sublinear(F.col("tf"), F.col("idf")))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("raw") / norm).alias("weight"))


def corpus_records(questions: DataFrame) -> DataFrame:
    """Wrong options of all questions, normalised, usable, with categories."""
    from quizlake.operators.candidates import option_category
    from quizlake.operators.reshape import explode_options

    rows = explode_options(
        questions.select(
            "row_id", "question", "correct_answer", "A", "B", "C", "D", "answer",
            T.clean_end(F.col("article")).alias("snippet"),
        ),
        ["row_id", "question", "correct_answer", "snippet"],
    ).where("is_correct = 0")
    rows = rows.withColumn("text", T.normalise_candidate(F.coalesce("option_text", F.lit(""))))
    rows = rows.where(T.usable_option(F.col("text"), F.col("correct_answer")))
    tokens = T.alnum_tokens(F.col("text"))
    return rows.select(
        F.concat_ws("-", "row_id", "label").alias("opt_id"),
        "text",
        F.array_join(tokens, " ").alias("option_key"),
        F.size(tokens).alias("n_tokens"),
        F.col("question").alias("source_question"),
        F.col("correct_answer").alias("source_answer"),
        "snippet",
        option_category(F.col("correct_answer"), F.col("question")).alias("answer_category"),
        option_category(F.col("text"), F.col("question")).alias("option_category"),
        T.clean_text(F.concat_ws(" ", "text", "question", "correct_answer")).alias("document"),
    )


def corpus_vocabulary(
    documents: DataFrame,
    min_df: int = 2,
    size: int = V.CORPUS_VOCABULARY_SIZE,
    stop_words: list[str] = V.STOP_WORDS,
) -> DataFrame:
    """One- and two-word terms without stop words that occur in enough documents."""

    def grams(words: Column) -> Column:
        pairs = F.zip_with(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
            F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
            lambda a, b: F.concat_ws(" ", a, b),
        )
        return F.concat(words, pairs)

    def counted(found: Column) -> Column:
        return F.concat(
            F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
            F.transform(
                F.array_distinct(found),
                lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df")),
            ),
        )

    words = F.filter(T.term_tokens(F.col("text")), lambda t: ~t.isin(stop_words))
    n = documents.agg(F.count(F.lit(1))).scalar()
    return (
        documents.select(F.inline(T.let(T.let(words, grams), counted)))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        .where(F.col("df") >= min_df)
        .orderBy(F.desc("tf"), "term")
        .limit(size)
        .select(
            "term", "df", (F.log((n + F.lit(1)) / (F.col("df") + F.lit(1))) + F.lit(1.0)).alias("idf")
        )
    )
