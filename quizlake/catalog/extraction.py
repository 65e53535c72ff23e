"""Candidate extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog.registry import (
    query, s_answer_category, s_answer_kind, s_apos, s_option_category, s_words, view,
)
from quizlake.catalog.tables import usable
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C
from quizlake.sources import tables as S


@query("sentences", "select doc_id, sent_idx, sentence from v_sent")
def sentences(spark, folder):
    return C.sentence_rows(S.passages(spark, folder))


def _kind_query(name: str, kind: str) -> None:
    @query(
        name,
        f"""select doc_id, row_number() over (partition by doc_id order by sent_idx, mat) - 1 as pos,
              text, round(score, 6) as score, sent_idx from v_found where kind = '{kind}'""",
    )
    def run(spark, folder):
        return C.kind_rows(S.passages(spark, folder), kind).withColumn("score", F.round("score", 6))


for _name, _kind in {
    "candidates_date": "date",
    "candidates_acronym": "acronym",
    "candidates_person": "person",
    "candidates_proper_noun": "properNoun",
    "candidates_definition": "definition",
    "candidates_location": "location",
}.items():
    _kind_query(_name, _kind)


@query(
    "candidates_keyword",
    "select doc_id, rank, text, round(score, 6) as score, sent_idx from v_cand where kind = 'keyword'",
)
def candidates_keyword(spark, folder):
    rows = C.candidate_rows(S.passages(spark, folder)).where("kind = 'keyword'")
    return rows.select("doc_id", "rank", "text", F.round("score", 6).alias("score"), "sent_idx")


@query(
    "candidates",
    "select doc_id, rank, text, kind, round(score, 6) as score, sent_idx, sentence from v_cand",
)
def candidates(spark, folder):
    return C.candidate_rows(S.passages(spark, folder)).withColumn("score", F.round("score", 6))


@query(
    "retag_person",
    "select doc_id, text, sentence, kind from v_cand where kind in ('person', 'properNoun')",
)
def retag_person(spark, folder):
    rows = C.candidate_rows(S.passages(spark, folder))
    return rows.where(F.col("kind").isin("person", "properNoun")).select("doc_id", "text", "sentence", "kind")


view(
    "v_mcq_sent",
    """select m.row_id, m.correct_answer, m.question, s.sent_idx, s.sentence
       from v_mcq m join v_sent s on s.doc_id = m.row_id""",
)
view(
    "v_best",
    f"""
select row_id, correct_answer, question, sent_idx, sentence from v_mcq_sent
qualify row_number() over (partition by row_id order by
  contains(lower(sentence), lower(correct_answer)) desc,
  case when contains(lower(sentence), lower(correct_answer)) then 0
       else len(list_intersect({s_apos('correct_answer')}, {s_apos('sentence')})) end desc, sent_idx) = 1
""",
)


def with_best_sentence(spark, folder):
    """Usable questions with the sentence that supports the right answer."""
    rows = C.with_sentences(usable(spark, folder))
    rows = rows.withColumn("sent_idx", C.best_sentence_index(F.col("sentences"), F.col("correct_answer")))
    return rows.withColumn("sentence", F.get("sentences", F.col("sent_idx")))


@query("best_source_sentence", "select row_id, correct_answer, sent_idx, sentence from v_best")
def best_source_sentence(spark, folder):
    return with_best_sentence(spark, folder).where("sent_idx is not null").select(
        "row_id", "correct_answer", "sent_idx", "sentence"
    )


@query(
    "infer_answer_kind",
    f"select row_id, correct_answer, {s_answer_kind('correct_answer', 'sentence')} as kind from v_best",
)
def infer_answer_kind(spark, folder):
    return with_best_sentence(spark, folder).where("sent_idx is not null").select(
        "row_id",
        "correct_answer",
        C.infer_answer_kind(F.col("correct_answer"), F.col("sentence")).alias("kind"),
    )


@query(
    "option_category",
    f"select row_id, label, option_text, {s_option_category('option_text', 'question')} as category from v_options",
)
def option_category(spark, folder):
    from quizlake.operators.reshape import explode_options

    rows = explode_options(usable(spark, folder), ["row_id", "question"])
    return rows.select(
        "row_id",
        "label",
        "option_text",
        C.option_category(F.col("option_text"), F.col("question")).alias("category"),
    )


@query(
    "answer_category",
    f"""select doc_id, rank, text, kind,
        {s_answer_category('text', 'kind', 'sentence', "''")} as category from v_cand""",
)
def answer_category(spark, folder):
    rows = C.candidate_rows(S.passages(spark, folder))
    return rows.select(
        "doc_id",
        "rank",
        "text",
        "kind",
        C.answer_category(F.col("text"), F.col("kind"), F.col("sentence"), F.lit("")).alias("category"),
    )


view(
    "v_gold",
    f"""
with known as (
  select distinct m.row_id from v_mcq m join v_cand c on c.doc_id = m.row_id
  where lower(c.text) = lower(m.correct_answer)
), injected as (
  select row_id as doc_id, correct_answer as text, coalesce(sentence, '') as sentence,
    sent_idx, 7.5::double as score, {s_answer_kind('correct_answer', 'sentence')} as kind, -1 as rank
  from v_best where row_id not in (select row_id from known)
)
select doc_id, row_number() over (partition by doc_id order by rank) - 1 as rank,
  text, kind, score, sent_idx, sentence from (
  select doc_id, text, sentence, sent_idx, score, kind, rank from v_cand
    where doc_id in (select row_id from v_mcq)
  union all select * from injected)
""",
)


def gold_candidates(spark, folder):
    """Usable questions with ranked candidates, the human answer among them."""
    rows = usable(spark, folder).withColumn("doc_id", F.col("row_id"))
    return C.add_gold_candidate(C.with_candidates(rows))


@query(
    "add_gold_candidate",
    "select doc_id, rank, text, kind, round(score, 6) as score, sent_idx from v_gold",
)
def add_gold_candidate(spark, folder):
    rows = C.candidate_rows(gold_candidates(spark, folder))
    return rows.select("doc_id", "rank", "text", "kind", F.round("score", 6).alias("score"), "sent_idx")


_TARGET = "lower(question || ' ' || correct_answer)"


@query(
    "match_sentence_index",
    f"""
    select row_id, sent_idx from v_mcq_sent
    qualify row_number() over (partition by row_id order by
      lower(sentence) = {_TARGET} desc,
      len(list_intersect({s_words(_TARGET)}, {s_words('lower(sentence)')})) desc, sent_idx) = 1
    """,
)
def match_sentence_index(spark, folder):
    rows = C.with_sentences(usable(spark, folder)).where(F.size("sentences") > 0)
    target = F.concat_ws(" ", "question", "correct_answer")
    return rows.select(
        "row_id",
        C.match_sentence_index(
            F.col("sentences"), target, lambda s: T.split_words(F.lower(s))
        ).alias("sent_idx"),
    )
