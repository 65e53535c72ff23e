"""Question table queries: sources, checks, option rows, samples, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quizlake.catalog.registry import query, s_bucket, s_clean, s_strip, lit, inlist, s_wh
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, reshape as R
from quizlake.sources import tables as S

SEED = 42


def usable(spark: SparkSession, folder: str) -> DataFrame:
    return R.usable_questions(S.raw_questions(spark, folder))


@query(
    "load_questions",
    'select row_id, article, question, "A", "B", "C", "D", answer, correct_answer from v_loaded',
)
def load_questions(spark, folder):
    return R.load_questions(S.raw_questions(spark, folder))


@query(
    "load_clean_questions",
    """select row_id, article, question, "A", "B", "C", "D", answer from v_raw
       where article is not null and question is not null and answer is not null""",
)
def load_clean_questions(spark, folder):
    return R.load_clean_questions(S.raw_questions(spark, folder))


@query("passage_scan", r"select regexp_replace(text, '[^\x00-\x7F]', '', 'g') as article from documents")
def passage_scan(spark, folder):
    return S.table(spark, folder, "documents").select(T.ascii_only(F.col("text")).alias("article"))


@query(
    "reject_sink",
    f"""
    select row_id as id, case when article is null then 'missing article'
        when question is null then 'missing question' when answer is null then 'missing answer'
        when {s_strip('answer')} not in ('A','B','C','D') then 'unknown answer label'
        else 'missing answer text' end as reason
    from v_loaded
    where article is null or question is null or answer is null
      or {s_strip('answer')} not in ('A','B','C','D') or correct_answer = ''
    union all
    select doc_id, 'no answer candidates' from v_passages where doc_id not in (select doc_id from v_cand)
    """,
)
def reject_sink(spark, folder):
    bad = R.rejected_questions(S.raw_questions(spark, folder)).withColumnRenamed("row_id", "id")
    bare = C.with_candidates(S.passages(spark, folder)).where(F.size("candidates") == 0)
    return bad.unionByName(
        bare.select(F.col("doc_id").alias("id"), F.lit("no answer candidates").alias("reason"))
    )


@query("clean_text", f"select doc_id, {s_clean('article')} as clean_article from v_passages")
def clean_text(spark, folder):
    return S.passages(spark, folder).select(
        "doc_id", T.clean_text(F.col("article")).alias("clean_article")
    )


@query("resolve_answer", "select row_id, answer, correct_answer from v_loaded")
def resolve_answer(spark, folder):
    return R.resolve_answer(S.raw_questions(spark, folder)).select("row_id", "answer", "correct_answer")


@query(
    "explode_options",
    f"""select row_id, label, {s_clean('article')} as clean_article, {s_clean('question')} as clean_question,
        {s_clean('option_text')} as clean_option, is_correct from v_options""",
)
def explode_options(spark, folder):
    return R.clean_option_rows(usable(spark, folder))


@query(
    "filter_wh",
    "select row_id, question from v_mcq where regexp_matches(lower(question), '^(who|what|where|when|why|how)')",
)
def filter_wh(spark, folder):
    return usable(spark, folder).where(R.starts_with_wh(F.col("question"))).select("row_id", "question")


@query("wh_type", f"select row_id, {s_wh('question')} as wh_word from v_mcq")
def wh_type(spark, folder):
    return usable(spark, folder).select("row_id", T.wh_type(F.col("question")).alias("wh_word"))


@query(
    "seq2seq_rows",
    f"""select row_id, 'generate question: context: ' || {s_clean('article')} || ' answer: '
          || {s_clean('correct_answer')} as input_text, {s_clean('question')} as target_text
        from v_mcq where regexp_matches(lower(question), '^(who|what|where|when|why|how)')
        order by md5('42-' || row_id), row_id limit 20000""",
)
def seq2seq_rows(spark, folder):
    return R.seq2seq_rows(usable(spark, folder), 20_000, SEED)


@query(
    "sample_rows",
    "select row_id, question, answer from v_mcq order by md5('42-' || row_id), row_id limit 500",
)
def sample_rows(spark, folder):
    return R.sample_rows(usable(spark, folder).select("row_id", "question", "answer"), 500, SEED, "row_id")


@query(
    "split_rows",
    f"""select row_id, case when {s_bucket('article')} < 80 then 'train'
          when {s_bucket('article')} < 90 then 'validation' else 'test' end as split,
          case when {s_bucket('article')} < 85 then 'train' else 'test' end as split_verifier
        from v_mcq""",
)
def split_rows(spark, folder):
    three = R.split_three(usable(spark, folder), F.col("article"))
    return three.select(
        "row_id",
        "split",
        F.when(R.bucket(F.col("article")) < 85, "train").otherwise("test").alias("split_verifier"),
    )


@query(
    "group_split",
    f"""select case when {s_bucket('md5(article)')} < 80 then 'train' else 'test' end as split,
          count(distinct md5(article)) as n_groups, count(*) as n_rows from v_mcq group by 1""",
)
def group_split(spark, folder):
    keyed = usable(spark, folder).select(F.md5("article").alias("group_id"))
    # one row per group first, so a group of copies is a count and not a pile of rows
    groups = keyed.groupBy("group_id").agg(F.count("*").alias("n"))
    return (
        R.split_two(groups, F.col("group_id"), 80)
        .groupBy("split")
        .agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_rows"))
    )


@query(
    "balance_classes",
    """select row_id, label, is_correct from v_options where is_correct = 1
       union all
       select row_id, label, is_correct from (
         select row_id, label, is_correct,
           row_number() over (order by md5('42-' || row_id || '-' || label), row_id, label) as r
         from v_options where is_correct = 0)
       where r <= (select count(*) from v_options where is_correct = 1)""",
)
def balance_classes(spark, folder):
    rows = R.explode_options(usable(spark, folder), ["row_id"]).select("row_id", "label", "is_correct")
    return R.balance_classes(rows, "is_correct", SEED, "row_id", "label")


_TITLE = s_strip(f"string_split({s_strip('article')}, '.')[1]")


@query(
    "titles",
    f"""
    select case when length(t) < 5 then 'Passage ' || doc_id else t end as title,
      max_by(article, doc_id) as article
    from (select doc_id, {s_strip('article')} as article,
        case when length({_TITLE}) > 55 then substr({_TITLE}, 1, 55) || '…' else {_TITLE} end as t
      from v_passages) group by 1""",
)
def titles(spark, folder):
    return R.titles(S.passages(spark, folder))


@query(
    "candidate_preview",
    "select doc_id, rank, text, kind, round(score, 3) as score, sentence from v_cand where rank < 8",
)
def candidate_preview(spark, folder):
    return C.candidate_rows(S.passages(spark, folder), 8).select(
        "doc_id", "rank", "text", "kind", F.round("score", 3).alias("score"), "sentence"
    )


@query("first_rows", "select row_id, question, answer from v_mcq order by row_id limit 25")
def first_rows(spark, folder):
    return usable(spark, folder).select("row_id", "question", "answer").orderBy("row_id").limit(25)


@query(
    "concat_rows",
    """select row_id, label, option_text, 1 as is_correct from v_options where is_correct = 1
       union all select row_id, label, option_text, 0 from v_options where is_correct = 0""",
)
def concat_rows(spark, folder):
    rows = R.explode_options(usable(spark, folder), ["row_id"])
    return rows.where("is_correct = 1").unionByName(rows.where("is_correct = 0"))


@query("distinct", f"select distinct {s_clean('option_text')} as clean_option from v_options")
def distinct(spark, folder):
    rows = R.explode_options(usable(spark, folder), ["row_id"])
    return rows.select(T.clean_text(F.col("option_text")).alias("clean_option")).distinct()
