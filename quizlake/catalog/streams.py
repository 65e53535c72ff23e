"""Streaming queries: each equals the batch result of the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog.registry import query
from quizlake.catalog.reports import answer_key
from quizlake.functions import text as T
from quizlake.sources import storage, tables as S
from quizlake.streaming import jobs as J


@query(
    "stream_candidates",
    """select doc_id, rank, text, kind, round(score, 6) as score, sent_idx from v_cand
       where doc_id in (select 'd' || doc_id from documents)""",
)
def stream_candidates(spark, folder):
    docs = J.read_stream(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("doc_id"), T.ascii_only(F.col("text")).alias("article")
    )
    rows = J.stream_candidates(docs).select(
        "doc_id", "rank", "text", "kind", F.round("score", 6).alias("score"), "sent_idx"
    )
    return J.run_to_parquet(rows, "candidates")


@query(
    "stream_attempts",
    """select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, count(*) as n_attempts,
       sum(is_correct)::bigint as n_correct from v_graded group by 1""",
)
def stream_attempts(spark, folder):
    n = S.table(spark, folder, "part").count()
    events = J.read_stream(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("p"), (F.col("event_id") % n).cast("string")).alias("row_id"),
        F.substr(F.lit("ABCD"), (F.col("event_id") % 4 + 1).cast("int"), F.lit(1)).alias("selected"),
    )
    keys = storage.settle(answer_key(spark, folder))
    return J.run_daily_grades(events, keys)
