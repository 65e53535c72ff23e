"""Template question, hint and rule-based quiz queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quizlake.catalog.extraction import gold_candidates
from quizlake.catalog.registry import (
    compose, inlist, lit, query, s_alpha, s_answer_category, s_apos, s_bad_question, s_clean_end,
    s_contains_key, s_key, s_looks_person, s_lower_first, s_mask_all, s_mask_first, s_norm_question,
    s_readable, s_strip, s_strip_marks, s_wh, s_words, view,
)
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, questions as Q
from quizlake.plans import quizzes as P
from quizlake.sources import tables as S

view(
    "v_tidy",
    f"""
select c.doc_id, rank, text, kind, score, sent_idx, sentence, {s_clean_end('sentence')} as tidy,
  strpos(lower({s_clean_end('sentence')}), lower(text)) as spot,
  regexp_extract(article, {lit(V.REFERENT_RE)}) as referent
from v_cand c join v_passages p on p.doc_id = c.doc_id where rank < 8
""",
)

_AFTER = s_strip_marks("substr(tidy, spot + length(text))")
_WH = "case kind when 'date' then 'When' when 'person' then 'Who' else 'What' end"
_FIRST = f"regexp_extract({_AFTER}, '[A-Za-z'']+')"

view(
    "v_suffix",
    f"""
select doc_id, rank, {s_norm_question(f"({_WH} || ' ' || {s_lower_first(s_clean_end('after'))})")} as question
from (select *, {_AFTER} as after, {_FIRST} as head from v_tidy where spot > 0)
where len(regexp_extract_all(after, '[A-Za-z'']+')) >= 3 and not regexp_matches(head, '^[A-Z]')
  and lower(head) not in {inlist(V.SUFFIX_STOP_STARTS)}
""",
)
view(
    "v_cloze",
    f"select doc_id, rank, {s_norm_question('q')} as question from (select doc_id, rank, "
    f"{lit(V.CLOZE_PREFIX)} || ({s_mask_first('tidy', 'text', V.BLANK)}) as q from v_tidy)",
)
_GENERIC = (
    f"case kind when 'date' then {lit(V.GENERIC_QUESTIONS['date'])} "
    f"when 'person' then {lit(V.GENERIC_QUESTIONS['person'])} else {lit(V.GENERIC_QUESTIONS['other'])} end"
)


def subject_sql(tidy: str, at: str, text: str, kind: str, sentence: str) -> str:
    after = s_strip_marks(f"substr({tidy}, {at} + length({text}))")
    asked = (
        f"(case when {kind} = 'person' or {s_looks_person(text, sentence)} then 'Who ' else 'What ' end "
        f"|| {s_lower_first(s_clean_end(after))} || '?')"
    )
    cloze = f"{lit(V.CLOZE_PREFIX)} || ({s_mask_first(tidy, text, V.BLANK)}) || '?'"
    return (
        f"case when {kind} = 'date' then {lit(V.GENERIC_QUESTIONS['date'])} "
        f"when {at} > 0 and {after} <> '' and {s_readable(asked)} then {asked} else {cloze} end"
    )


view(
    "v_template_question",
    f"select doc_id, rank, {subject_sql('tidy', 'spot', 'text', 'kind', 'sentence')} as question from v_tidy",
)

_ADVERBS = "(?i)^((" + "|".join(V.LONE_ADVERBS) + ")( |$))+"


def _definition_part(i: int, trigger: str) -> str:
    before = s_strip_marks(f"substr(tidy, 1, strpos(lower(tidy), {lit(trigger)}) - 1)")
    before = f"regexp_replace({before}, {lit('(?i)^(' + V.COPULA_STARTS + ')' + chr(92) + 's+')}, '')"
    return (
        f"select doc_id, rank, tidy, referent, {i} as ord, {lit(trigger)} as trig, "
        f"{s_strip(f'regexp_replace({s_strip(before)}, {lit(_ADVERBS)}, {lit(str())})')} as subject "
        f"from v_tidy where kind = 'definition' and strpos(lower(tidy), {lit(trigger)}) > 0"
    )


view(
    "v_definition",
    f"""
with parts as ({' union all '.join(_definition_part(i, t) for i, t in enumerate(V.DEFINITION_TRIGGERS))}),
named as (select *, case when subject <> '' and lower(subject) not in {inlist(V.BARE_PRONOUNS)} then subject
    when regexp_extract(tidy, {lit(V.REFERENT_RE)}) <> '' then regexp_extract(tidy, {lit(V.REFERENT_RE)})
    when referent <> '' then referent end as n from parts)
select doc_id, rank, {s_norm_question("('What is ' || " + s_lower_first('n') + " || ' ' || trig || '?')")} as question
from named where n is not null qualify row_number() over (partition by doc_id, rank order by ord) = 1
""",
)


def _where_case() -> str:
    out = "case"
    for aux in V.AUXILIARIES:
        p = lit(rf"(?i)^(.*?)\s+({aux})\s+(.*)")
        out += (
            f" when regexp_matches(place, {p}) then 'Where ' || regexp_extract(place, {p}, 2) || ' ' || "
            f"{s_lower_first(f'regexp_extract(place, {p}, 1)')} || ' ' || regexp_extract(place, {p}, 3)"
        )
    return out + f" else 'Where ' || {s_lower_first('place')} end"


view(
    "v_where",
    rf"""
with b as (select doc_id, rank, {s_strip_marks('substr(tidy, 1, spot - 1)')} as before from v_tidy
           where kind = 'location' and spot > 0),
p as (select doc_id, rank, {s_strip(r"regexp_replace(before, '(?i)\s+(?:in|at|near|from|within)\s*$', '')")} as place
      from b where len({s_words('before')}) >= 3),
q as (select doc_id, rank, {_where_case()} as raw from p where place <> '')
select doc_id, rank, {s_norm_question('raw')} as question from q
""",
)

view(
    "v_questions",
    f"""
with made as (
  select doc_id, rank, 0 as tpl, 'definition' as template, question from v_definition
  union all select doc_id, rank, 1, 'where_wh', question from v_where
  union all select doc_id, rank, 2, 'suffix_wh', question from v_suffix
  union all select doc_id, rank, 3, 'generic_wh', {_GENERIC} from v_tidy
  union all select doc_id, rank, 4, 'cloze', question from v_cloze
), d as (
  select m.doc_id, m.rank, tpl, template, question, text, kind, score, sent_idx, sentence
  from made m join v_tidy t on t.doc_id = m.doc_id and t.rank = m.rank
  qualify row_number() over (partition by m.doc_id, lower(question), lower(text) order by m.rank, tpl) = 1)
select doc_id, row_number() over (partition by doc_id order by rank, tpl) - 1 as candidate_index,
  rank as answer_rank, text as answer_text, kind as answer_kind, score - rank * 0.05::double as answer_score,
  sentence, sent_idx, template, question, {s_wh('question')} as wh_word from d
""",
)


def top_answers(spark, folder):
    """The first eight answers of each passage with the passage's referent."""
    rows = C.with_candidates(S.passages(spark, folder))
    refs = rows.withColumn("referent", Q.article_referent(F.col("article")))
    entries = T.let(
        F.col("sentences"),
        lambda ss: F.transform(
            F.slice("candidates", 1, 8),
            lambda c: F.struct(
                c["text"].alias("text"),
                c["kind"].alias("kind"),
                F.get(ss, c["sent_idx"]).alias("sentence"),
            ),
        ),
    )
    return refs.select("doc_id", "referent", F.posexplode(entries).alias("rank", "c")).select(
        "doc_id", "referent", "rank", "c.*"
    )


def _single(spark, folder, question: Column):
    rows = top_answers(spark, folder).select("doc_id", "rank", question.alias("question"))
    return rows.where("question is not null")



@query("q_cloze", "select doc_id, rank, question from v_cloze")
def q_cloze(spark, folder):
    return _single(spark, folder, Q.cloze_question(F.col("text"), F.col("sentence")))


@query("q_suffix_wh", "select doc_id, rank, question from v_suffix")
def q_suffix_wh(spark, folder):
    return _single(spark, folder, Q.suffix_question(F.col("text"), F.col("kind"), F.col("sentence")))


@query("q_subject", "select doc_id, rank, question from v_template_question")
def q_subject(spark, folder):
    return _single(spark, folder, Q.template_question(F.col("text"), F.col("kind"), F.col("sentence")))


@query("q_generic", f"select doc_id, rank, {_GENERIC} as question from v_tidy")
def q_generic(spark, folder):
    return _single(spark, folder, Q.generic_question(F.col("kind")))


@query("q_definition", "select doc_id, rank, question from v_definition")
def q_definition(spark, folder):
    made = Q.definition_question(F.col("sentence"), F.col("referent"))
    return _single(spark, folder, F.when(F.col("kind") == "definition", made))


@query("q_where", "select doc_id, rank, question from v_where")
def q_where(spark, folder):
    made = Q.where_question(F.col("text"), F.col("sentence"))
    return _single(spark, folder, F.when(F.col("kind") == "location", made))


def question_table(spark, folder):
    return Q.question_rows(C.with_candidates(S.passages(spark, folder)))


@query(
    "question_candidates",
    """select doc_id, candidate_index, answer_rank, answer_text, answer_kind, round(answer_score, 6) as answer_score,
       sentence, sent_idx, template, question, wh_word from v_questions""",
)
def question_candidates(spark, folder):
    return question_table(spark, folder).withColumn("answer_score", F.round("answer_score", 6))


@query(
    "dedupe_keys",
    """select doc_id, lower(question) as question_key, lower(answer_text) as answer_key, count(*) as n
       from v_questions group by all""",
)
def dedupe_keys(spark, folder):
    rows = question_table(spark, folder)
    return rows.groupBy(
        "doc_id", F.lower("question").alias("question_key"), F.lower("answer_text").alias("answer_key")
    ).agg(F.count("*").alias("n"))


@query(
    "answer_backref",
    """select q.doc_id, q.candidate_index, c.rank as answer_rank, c.text, c.kind, round(c.score, 6) as score
       from v_questions q join v_cand c on c.doc_id = q.doc_id and lower(c.text) = lower(q.answer_text)""",
)
def answer_backref(spark, folder):
    """The answer entry travels with its question, so nothing is joined back."""
    return question_table(spark, folder).select(
        "doc_id",
        "candidate_index",
        "answer_rank",
        F.col("answer_text").alias("text"),
        F.col("answer_kind").alias("kind"),
        F.round(F.col("answer_score") + F.col("answer_rank") * V.ANSWER_RANK_COST, 6).alias("score"),
    )


@query("question_normalise", f"select row_id, {s_norm_question('question')} as question from v_mcq")
def question_normalise(spark, folder):
    from quizlake.catalog.tables import usable

    return usable(spark, folder).select(
        "row_id", T.normalise_question(F.col("question")).alias("question")
    )


@query(
    "bad_question_filter",
    f"select doc_id, candidate_index, template, question from v_questions where not {s_bad_question('question')}",
)
def bad_question_filter(spark, folder):
    rows = question_table(spark, folder).where(~T.bad_question(F.col("question")))
    return rows.select("doc_id", "candidate_index", "template", "question")


@query(
    "readable_filter",
    f"select doc_id, candidate_index, template, question from v_questions where {s_readable('question')}",
)
def readable_filter(spark, folder):
    rows = question_table(spark, folder).where(T.readable_question(F.col("question")))
    return rows.select("doc_id", "candidate_index", "template", "question")


# -- hints and the rule-based quiz ----------------------------------------------------------

_MASK_THIRD = s_clean_end("(" + s_mask_all("sentence", "text", V.HINT_BLANK) + ")")


def _tidy_sentence(alias: str) -> str:
    return s_clean_end(f"{alias}.sentence")


view(
    "v_hints",
    f"""
with n as (select doc_id, count(*) as n from v_sent group by 1),
ts as (select doc_id, sent_idx, sentence, {s_clean_end('sentence')} as tidy from v_sent),
base as (
  select c.doc_id, c.rank, c.text, c.sent_idx, n.n, {_MASK_THIRD} as h3
  from v_cand c join n on n.doc_id = c.doc_id where c.rank < 8),
opening as (
  select b.doc_id, b.rank, min_by(s.tidy, s.sent_idx) as tidy
  from base b join ts s on s.doc_id = b.doc_id
  where not contains(lower(s.sentence), lower(b.text)) and length(s.tidy) >= 20 group by 1, 2),
h1 as (
  select b.*, coalesce(o.tidy, {s_mask_all('f.tidy', 'b.text', V.HINT_BLANK)}) as h1
  from base b join ts f on f.doc_id = b.doc_id and f.sent_idx = 0
  left join opening o on o.doc_id = b.doc_id and o.rank = b.rank),
h2 as (
  select h1.*, case when h1.sent_idx > 1 then p.tidy when h1.sent_idx = 1 then h1
      when n > 1 then s1.tidy else h3 end as h2
  from h1 left join ts p on p.doc_id = h1.doc_id and p.sent_idx = h1.sent_idx - 1
  left join ts s1 on s1.doc_id = h1.doc_id and s1.sent_idx = 1)
select h2.doc_id, h2.rank, h1 as hint_1,
  case when lower(h2) = lower(h1) and n > h2.sent_idx + 1 then x.tidy else h2 end as hint_2, h3 as hint_3
from h2 left join ts x on x.doc_id = h2.doc_id and x.sent_idx = least(h2.sent_idx + 1, n - 1)
""",
)


@query("hints", "select doc_id, rank, hint_1, hint_2, hint_3 from v_hints")
def hints(spark, folder):
    rows = C.with_candidates(S.passages(spark, folder))
    made = T.let(
        F.col("sentences"),
        lambda ss: T.let(
            Q.openings(ss),
            lambda op: F.transform(
                F.slice("candidates", 1, 8), lambda c: Q.hints(ss, c["text"], c["sent_idx"], op)
            ),
        ),
    )
    return rows.select("doc_id", F.posexplode(made).alias("rank", "h")).select(
        "doc_id", "rank", *[F.get("h", F.lit(i)).alias(f"hint_{i + 1}") for i in range(3)]
    )


view(
    "v_same_passage",
    f"""
with k as (select doc_id, rank, text, {s_key('text')} as key,
    {s_answer_category('text', 'kind', 'sentence', "''")} as category from v_cand),
pairs as (
  select c.doc_id, c.text as answer, o.text as option_text, o.key, o.rank
  from k c join k o on o.doc_id = c.doc_id and c.rank = 0 and o.category = c.category
  where o.key <> c.key and not {s_contains_key('o.key', 'c.key')}
  qualify row_number() over (partition by c.doc_id, o.key order by o.rank) = 1)
select doc_id, answer, option_text, row_number() over (partition by doc_id order by rank) as place from pairs
qualify place <= 3
""",
)


@query("same_passage_options", "select doc_id, answer, option_text, place from v_same_passage")
def same_passage_options(spark, folder):
    drafts = P.quiz_drafts(S.passages(spark, folder))
    rest = F.slice("options", F.lit(2), F.lit(3))
    return drafts.select(
        "doc_id", F.col("correct.text").alias("answer"), F.posexplode(rest).alias("p", "option_text")
    ).select("doc_id", "answer", "option_text", (F.col("p") + 1).alias("place"))


view(
    "v_shuffled",
    """
with o as (
  select doc_id, answer, option_text from v_same_passage
  union all select distinct doc_id, answer, answer from v_same_passage),
full_sets as (select doc_id from o group by 1 having count(*) = 4)
select o.doc_id, o.answer, o.option_text,
  row_number() over (partition by o.doc_id
    order by md5(md5(p.article) || o.answer || '::' || o.option_text), o.option_text) as place
from o join v_passages p on p.doc_id = o.doc_id where o.doc_id in (select doc_id from full_sets)
""",
)


def rule_quizzes(spark, folder):
    return P.flat_quizzes(P.rule_based_quizzes(S.passages(spark, folder)))


@query(
    "shuffle_options",
    """select doc_id, substr('ABCD', place::int, 1) as label, option_text,
       (lower(option_text) = lower(answer))::int as is_correct from v_shuffled""",
)
def shuffle_options(spark, folder):
    quizzes = P.rule_based_quizzes(S.passages(spark, folder))
    return quizzes.select("doc_id", "correct_label", F.posexplode("options").alias("p", "option_text")).select(
        "doc_id",
        F.substr(F.lit("ABCD"), F.col("p") + 1, F.lit(1)).alias("label"),
        "option_text",
        (F.substr(F.lit("ABCD"), F.col("p") + 1, F.lit(1)) == F.col("correct_label"))
        .cast("int")
        .alias("is_correct"),
    )


view(
    "v_quiz",
    """
select s.doc_id, t.question, max(s.answer) as correct_answer,
  max(case when lower(option_text) = lower(answer) then substr('ABCD', place::int, 1) end) as correct_label,
  max(case when place = 1 then option_text end) as option_a,
  max(case when place = 2 then option_text end) as option_b,
  max(case when place = 3 then option_text end) as option_c,
  max(case when place = 4 then option_text end) as option_d,
  h.hint_1, h.hint_2, h.hint_3, 'strict' as option_quality
from v_shuffled s join v_template_question t on t.doc_id = s.doc_id and t.rank = 0
join v_hints h on h.doc_id = s.doc_id and h.rank = 0
group by s.doc_id, t.question, h.hint_1, h.hint_2, h.hint_3
""",
)


@query(
    "rule_based_quizzes",
    """select doc_id, question, correct_answer, correct_label, option_a, option_b, option_c, option_d,
       hint_1, hint_2, hint_3, option_quality from v_quiz""",
)
def rule_based_quizzes(spark, folder):
    return rule_quizzes(spark, folder)


@query(
    "quiz_rejects",
    """select doc_id, case when doc_id not in (select doc_id from v_cand) then 'no answer candidates'
       else 'no four answer options' end as reason
       from v_passages where doc_id not in (select doc_id from v_quiz)""",
)
def quiz_rejects(spark, folder):
    return P.quiz_rejects(S.passages(spark, folder))
