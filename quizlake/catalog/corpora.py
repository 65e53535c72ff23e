"""Corpus statistics, features and training-row queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quizlake.catalog.extraction import gold_candidates
from quizlake.catalog.registry import (
    VIEWS, inlist, lit, query, s_alnum, s_apos, s_bad_question, s_bigrams, s_clean, s_clean_end, s_f1, s_key,
    s_lexical_cosine, s_norm_candidate, s_option_category, s_ratio, s_strip, s_collapse, s_terms,
    s_usable, s_verb, s_wh, s_words, view,
)
from quizlake.catalog.tables import usable
from quizlake.catalog.questions import question_table
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, corpus as K, features as X, metrics as M, questions as Q
from quizlake.operators import options as OP, reshape as R
from quizlake.plans import models as ML
from quizlake.sources import storage, tables as S

view(
    "v_docs",
    f"""
select row_id || '-a' as k, {s_clean('article')} as text from v_mcq
union all select row_id || '-q', {s_clean('question')} from v_mcq
""",
)
view(
    "v_stat",
    f"""
select term, count(*) as tf, count(distinct k) as df
from (select k, unnest({s_terms('text')}) as term from v_docs) group by term
""",
)
view(
    "v_idf",
    """
select term, df, ln((1.0::double + (select count(*) from v_docs)) / (df + 1)) + 1.0::double as idf
from (select * from v_stat order by tf desc, term limit 20000)
""",
)


def vocabulary(spark, folder):
    return K.vocabulary(K.question_documents(usable(spark, folder)))


@query("document_frequency", "select term, tf, df from v_stat")
def document_frequency(spark, folder):
    return K.term_statistics(K.question_documents(usable(spark, folder)))


@query("idf", "select term, df, round(idf, 6) as idf from v_idf")
def idf(spark, folder):
    return vocabulary(spark, folder).withColumn("idf", F.round("idf", 6))


@query(
    "tfidf",
    f"""
    select row_id, term, round(raw / sqrt(sum(raw * raw) over (partition by row_id)), 6) as weight
    from (select row_id, t.term, (1.0::double + ln(count(*))) * any_value(idf) as raw
          from (select row_id, unnest({s_terms(s_clean('article'))}) as term from v_mcq) t
          join v_idf i on i.term = t.term group by row_id, t.term)""",
)
def tfidf(spark, folder):
    texts = usable(spark, folder).select("row_id", T.clean_text(F.col("article")).alias("text"))
    return K.weights(texts, "row_id", vocabulary(spark, folder)).withColumn(
        "weight", F.round("weight", 6)
    )


_CORPUS_TEXT = s_norm_candidate("coalesce(option_text, '')")
view(
    "v_corpus",
    f"""
select row_id || '-' || label as opt_id, text, {s_key('text')} as option_key, len({s_alnum('text')}) as n_tokens,
  question as source_question, correct_answer as source_answer, snippet,
  {s_option_category('correct_answer', 'question')} as answer_category,
  {s_option_category('text', 'question')} as option_category,
  {s_clean("(text || ' ' || question || ' ' || correct_answer)")} as document
from (select row_id, label, question, correct_answer, {_CORPUS_TEXT} as text, {s_clean_end('article')} as snippet
      from v_options where is_correct = 0)
where {s_usable('text', 'correct_answer')}
""",
)


@query(
    "corpus_index",
    """select opt_id, text, option_key, n_tokens, source_question, source_answer, snippet,
       answer_category, option_category, document from v_corpus""",
)
def corpus_index(spark, folder):
    return K.corpus_records(usable(spark, folder))


view(
    "v_grams",
    f"""
with w as (select opt_id, list_filter({s_terms('document')}, lambda t: t not in {inlist(V.STOP_WORDS)}) as w from v_corpus)
select opt_id, unnest(w) as term from w
union all
select opt_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w
""",
)


@query(
    "corpus_vocabulary",
    """select term, df, round(ln((1.0::double + (select count(*) from v_corpus)) / (df + 1)) + 1.0::double, 6) as idf
       from (select term, count(*) as tf, count(distinct opt_id) as df from v_grams group by term
             having count(distinct opt_id) >= 2 order by tf desc, term limit 60000)""",
)
def corpus_vocabulary(spark, folder):
    documents = K.corpus_records(usable(spark, folder)).select(F.col("document").alias("text"))
    return K.corpus_vocabulary(documents).withColumn("idf", F.round("idf", 6))


@query(
    "category_prefilter",
    f"""select row_id, s.category as search_category from (
          select row_id, {s_option_category('correct_answer', 'question')} as category from v_mcq) m
        join (values ('term','term'),('term','definition'),('term','statement'),('definition','term'),
          ('definition','definition'),('definition','statement'),('statement','term'),('statement','definition'),
          ('statement','statement'),('properNoun','properNoun'),('properNoun','term'),
          ('educationDegree','educationDegree'),('date','date'),('number','number'),('person','person'),
          ('location','location'),('acronym','acronym')) s(correct, category) on s.correct = m.category""",
)
def category_prefilter(spark, folder):
    from quizlake.operators.retrieval import search_categories

    own = C.option_category(F.col("correct_answer"), F.col("question"))
    return usable(spark, folder).select(
        "row_id", F.explode(search_categories(own)).alias("search_category")
    )


# -- verifier features ------------------------------------------------------------------------

_PAD = lambda x: f"(' ' || {s_strip(s_collapse(x))} || ' ')"


def _held(words: str, pad: str) -> str:
    return f"len(list_filter({words}, lambda w: contains({pad}, ' ' || w || ' ')))"


view(
    "v_oclean",
    f"""
select row_id, label, is_correct, article, option_text, {s_clean('article')} as ca, {s_clean('question')} as cq,
  {s_clean('option_text')} as co from v_options
""",
)
view(
    "v_osent",
    f"""
select o.row_id, o.label, max({_held('o.words', _PAD(s_clean('s.sentence')))}) as best
from (select row_id, label, list_distinct({s_words('co')}) as words from v_oclean) o
join v_sent s on s.doc_id = o.row_id group by 1, 2
""",
)
view(
    "v_awt",
    f"""
select row_id, term, raw as wa, sum(raw * raw) over (partition by row_id) as na from (
  select row_id, t.term, (1.0::double + ln(count(*))) * any_value(idf) as raw
  from (select row_id, unnest({s_terms(s_clean('article'))}) as term from v_mcq) t
  join v_idf i on i.term = t.term group by row_id, t.term)
""",
)
view(
    "v_dot",
    f"""
with tk as (
  select row_id, label, unnest({s_terms('cq')}) as term, 0 as in_option from v_oclean
  union all select row_id, label, unnest({s_terms('co')}), 1 from v_oclean),
q as (select row_id, label, t.term, any_value(idf) as idf, max(in_option) as in_option,
        (1.0::double + ln(count(*))) * any_value(idf) as wq
      from tk t join v_idf i on i.term = t.term group by row_id, label, t.term)
select q.row_id, q.label, sum(wq * wa) as dot, sum(wq * wq) as nq, max(na) as na,
  sum(case when in_option = 1 and wa is not null then idf end) as shared_idf
from q left join v_awt a on a.row_id = q.row_id and a.term = q.term group by 1, 2
""",
)
view(
    "v_verifier",
    f"""
with b as (
  select *, {_PAD('ca')} as pad, list_distinct({s_words('co')}) as ow,
    list_distinct(list_concat({s_words('cq')}, {s_words('co')})) as qw,
    {s_words('co')} as ol, {s_words('cq')} as ql
  from v_oclean),
p as (select *, list_distinct(list_concat({s_bigrams('ql')}, {s_bigrams('ol')})) as pairs from b)
select p.row_id, p.label, p.is_correct,
  round(coalesce(dot / sqrt(nq * na), 0), 6) as tfidf_cosine_sim,
  round(case when len(qw) > 0 then {_held('qw', 'pad')}::double / len(qw) else 0 end, 6) as unigram_overlap_ratio,
  round(case when {_held('ow', 'pad')} > 0 then coalesce(shared_idf, 0) / {_held('ow', 'pad')} else 0 end, 6) as idf_weighted_score,
  round(case when len(ow) > 0 then coalesce(best, 0)::double / len(ow) else 0 end, 6) as best_sentence_overlap,
  round(case when len(pairs) > 0 then {_held('pairs', 'pad')}::double / len(pairs) else 0 end, 6) as bigram_overlap_ratio,
  (co <> '' and contains(ca, co))::int::double as exact_match_flag,
  len(ol)::double as option_token_length, length(co)::double as option_char_length,
  round(case when strpos(ca, co) = 0 or length(ca) = 0 then -1.0::double else (strpos(ca, co) - 1)::double / length(ca) end, 6) as first_position,
  (regexp_matches({s_strip('option_text')}, {lit(V.FULL_NUMBER_RE)}) or regexp_matches({s_strip('option_text')}, {lit(V.DATE_WORD_RE)}))::int::double as is_number,
  round(case when len(ow) > 0 then {_held('ow', 'pad')}::double / len(ow) else 0 end, 6) as article_overlap
from p left join v_dot d on d.row_id = p.row_id and d.label = p.label
left join v_osent s on s.row_id = p.row_id and s.label = p.label
""",
)


def verifier_table(spark, folder):
    rows = usable(spark, folder)
    vocab = K.vocabulary(K.question_documents(rows))
    return X.verifier_features(X.option_items(rows), vocab)


@query("verifier_features", "select * exclude (is_correct) from v_verifier")
def verifier_features(spark, folder):
    made = verifier_table(spark, folder)
    numbers = [c for c in made.columns if c not in ("row_id", "label")]
    return made.select("row_id", "label", *[F.round(c, 6).alias(c) for c in numbers])


@query(
    "idf_lookup",
    f"""select t.row_id, t.label, t.term, round(coalesce(i.idf, 0), 6) as idf
        from (select distinct row_id, label, unnest({s_terms('co')}) as term from v_oclean) t
        left join v_idf i on i.term = t.term""",
)
def idf_lookup(spark, folder):
    rows = R.explode_options(usable(spark, folder), ["row_id"])
    terms = rows.select(
        "row_id",
        "label",
        F.explode(F.array_distinct(T.term_tokens(T.clean_text(F.col("option_text"))))).alias("term"),
    )
    # the vocabulary has at most 20,000 rows by definition
    known = F.broadcast(vocabulary(spark, folder).select("term", "idf"))
    return terms.join(known, "term", "left").select(
        "row_id", "label", "term", F.round(F.coalesce("idf", F.lit(0.0)), 6).alias("idf")
    )


# -- ranker features and training rows ------------------------------------------------------------

_QT = s_apos("question")
_KIND_FLAGS = {
    "answer_kind_date": "date",
    "answer_kind_person": "person",
    "answer_kind_acronym": "acronym",
    "answer_kind_proper_noun": "properNoun",
    "answer_kind_keyword": "keyword",
}


def ranker_sql(source: str) -> str:
    flag = lambda cond: f"coalesce({cond}, false)::int::double"
    spot = "strpos(lower(sentence), lower(answer_text))"
    cols = {
        "question_word_count": "len(qt)::double",
        "question_char_count": "length(question)::double",
        "starts_with_wh": flag("wh_word <> ''"),
        "is_cloze": flag("template = 'cloze'"),
        "has_blank": flag("contains(question, '_____')"),
        "contains_answer_text": flag("answer_text <> '' and contains(lower(question), lower(answer_text))"),
        "has_verb_like_token": flag(s_verb("qt[2:]")),
        "second_word_bad": flag(f"qt[2] in {inlist(V.RANKER_SECOND)}"),
        "trailing_word_bad": flag(f"qt[-1] in {inlist(V.RANKER_LAST)}"),
        "double_punctuation": flag(r"regexp_matches(question, '\?\?|!!')"),
        **{f"wh_{w}": flag(f"wh_word = '{w}'") for w in V.WH_WORDS},
        **{n: flag(f"answer_kind = '{k}'") for n, k in _KIND_FLAGS.items()},
        "wh_matches_answer_kind": flag(
            "wh_word = case answer_kind when 'date' then 'when' when 'person' then 'who' else 'what' end"
        ),
        "answer_candidate_score": "round(answer_score, 6)",
        "answer_word_count": f"len({s_apos('answer_text')})::double",
        "source_sentence_index": "sent_idx::double",
        "source_sentence_position": "round(sent_idx::double / greatest(n_sentences, 1), 6)",
        "source_sentence_word_count": "len(st)::double",
        "answer_position_in_sentence": f"round(case when {spot} = 0 then -1.0::double else ({spot} - 1)::double / greatest(length(sentence), 1) end, 6)",
        "words_before_answer": f"case when {spot} = 0 then 0.0::double else len({s_apos(f'substr(sentence, 1, {spot} - 1)')})::double end",
        "words_after_answer": f"case when {spot} = 0 then len(st)::double else len({s_apos(f'substr(sentence, {spot} + length(answer_text))')})::double end",
        "question_source_unigram_overlap": f"round({s_ratio('qt', 'st')}, 6)",
        "question_article_unigram_overlap": f"round({s_ratio('qt', 'at_')}, 6)",
        "question_source_bigram_overlap": f"round({s_ratio('qb', 'sb')}, 6)",
        **{n: "0.0::double" for n in V.RANKER_FEATURES[-5:]},
    }
    assert list(cols) == V.RANKER_FEATURES
    return f"""
with arts as (select doc_id, {s_apos('article')} as at_ from v_passages),
n as (select doc_id, count(*) as n_sentences from v_sent group by 1),
t as (select q.*, {s_apos('q.question')} as qt, {s_apos('q.sentence')} as st, at_, coalesce(n_sentences, 0) as n_sentences
      from {source} q join arts a on a.doc_id = q.doc_id left join n on n.doc_id = q.doc_id),
u as (select *, {s_bigrams('qt')} as qb, {s_bigrams('st')} as sb from t)
select doc_id, candidate_index, template, {', '.join(f'{v} as {k}' for k, v in cols.items())} from u
"""


view("v_ranker", ranker_sql("v_questions"))


def rounded(df, columns):
    names = set(columns)
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


@query("ranker_features", "select * from v_ranker")
def ranker_features(spark, folder):
    rows = Q.question_rows(C.with_candidates(S.passages(spark, folder)), 8, with_overlap=True)
    made = X.ranker_features(rows)
    return rounded(made, V.RANKER_FEATURES).select(
        "doc_id", "candidate_index", "template", *V.RANKER_FEATURES
    )


TRAINING_ANSWERS = 10


def training_questions(spark, folder):
    """Generated questions of the question table with their targets."""
    rows = gold_candidates(spark, folder).withColumnRenamed("question", "gold_question")
    rows = rows.withColumn("others", F.array(*V.LABELS)).withColumn("gold", M.gold_parts(F.col("gold_question")))
    made = Q.question_rows(rows, TRAINING_ANSWERS, with_overlap=True)
    return M.training_target(made)


_GOLD_TARGET = f"""
  ({s_f1('question', 'gold_question')} * 0.65::double
   + {s_ratio('qb', 'gb')} * 0.25::double
   + case when wh_word <> '' and wh_word = {s_wh('gold_question')} then 0.10::double else 0.0::double end)
  * case when lower(answer_text) = lower(correct_answer) then 1.0::double else 0.35::double end
  * case when template = 'cloze' and not regexp_matches(lower(gold_question), '_|complete|fill') then 0.55::double else 1.0::double end
  * case when {s_bad_question('question')} then 0.20::double else 1.0::double end
"""
# generated questions of the training table: same templates, ten answers, the gold answer among them
view(
    "v_target",
    f"""
with own as (
  select row_id as doc_id, question as gold_question, correct_answer from v_mcq),
b as (
  select q.doc_id, q.candidate_index, q.template, q.question, q.answer_text, q.wh_word, o.gold_question, o.correct_answer,
    {s_apos('q.question')} as qt, {s_apos('o.gold_question')} as gt
  from v_questions q join own o on o.doc_id = q.doc_id),
c as (select *, {s_bigrams('qt')} as qb, {s_bigrams('gt')} as gb from b)
select doc_id, candidate_index, template, question, {_GOLD_TARGET} as target from c
""",
)


def settled(column):
    """Six digits, with exact halves always going up."""
    return F.round(F.col(column) + 1e-10, 6).alias(column)


def target_table(spark, folder):
    """Questions of the plain candidates beside the human question."""
    rows = usable(spark, folder).withColumn("doc_id", F.col("row_id"))
    rows = rows.withColumnRenamed("question", "gold_question").withColumn("gold", M.gold_parts(F.col("gold_question")))
    return M.training_target(Q.question_rows(C.with_candidates(rows), 8))


@query(
    "training_target",
    "select doc_id, candidate_index, template, question, round(target + 1e-10::double, 6) as target from v_target",
)
def training_target(spark, folder):
    return target_table(spark, folder).select(
        "doc_id", "candidate_index", "template", "question", settled("target")
    )


view(
    "v_labelled",
    """
select doc_id, candidate_index, template, target,
  case when target <= 0.08::double then 0
    when r = 1 and target >= 0.22::double then 1
    when target >= 0.45::double then 1 else 0 end as label
from (select *, row_number() over (partition by doc_id order by target desc, candidate_index) as r
      from (select doc_id, candidate_index, template, round(target, 9) as target from v_target))
""",
)


@query("label_group", "select doc_id, candidate_index, round(target + 1e-10::double, 6) as target, label from v_labelled")
def label_group(spark, folder):
    rows = target_table(spark, folder).withColumn("target", F.round("target", 9))
    made = M.label_group(rows, "doc_id")
    return made.select("doc_id", "candidate_index", settled("target"), "label")


def labelled_rows(questions):
    """Features, targets and labels of the ranker's training table."""
    rows = X.ranker_features(questions).drop("others").withColumnRenamed("doc_id", "group_id")
    return M.label_group(rows.withColumn("target", F.round("target", 9)))


def ranker_rows(spark, folder):
    """The table without verifier values: the quiz job ranks questions before they
    have options, so its ranker is trained on what it will see."""
    return labelled_rows(training_questions(spark, folder))


def scored_rows(spark, folder, scores):
    """The table with verifier values; ``scores`` gives the probabilities of the
    options of its questions."""
    questions = storage.settle(training_questions(spark, folder))
    articles = usable(spark, folder).select(F.col("row_id").alias("doc_id"), "article")
    return labelled_rows(ML.with_verifier_scores(questions, articles, scores))


@query("ranker_training_rows")
def ranker_training_rows(spark, folder):
    return rounded(ranker_rows(spark, folder), [*V.RANKER_FEATURES, "target"])


@query("ranker_training_rows_scored")
def ranker_training_rows_scored(spark, folder):
    """The table with scores of verifiers that never saw the article."""
    rows = scored_rows(spark, folder, ML.cross_fitted(usable(spark, folder)).scores)
    return rounded(rows, [*V.RANKER_FEATURES, "target"])


# the same views over the human answer and the candidates of the question table, ten answers a row; the
# limit is a window of its own, since DuckDB 2.0.0 shifts ranks when "rank < 10" is pushed into v_gold
view("v_gold_top", f"select * from v_gold qualify row_number() over (partition by doc_id order by rank) <= {TRAINING_ANSWERS}")
_QUESTION_VIEWS = ("v_tidy", "v_suffix", "v_cloze", "v_definition", "v_where", "v_questions")
for _name in _QUESTION_VIEWS:
    _sql = re.sub(rf"\b({'|'.join(_QUESTION_VIEWS)})\b", r"\1_gold", VIEWS[_name])
    view(f"{_name}_gold", _sql.replace("v_cand", "v_gold_top").replace(" where rank < 8", ""))
view("v_ranker_gold", ranker_sql("v_questions_gold"))
view("v_target_gold", VIEWS["v_target"].replace("v_questions", "v_questions_gold"))
view("v_labelled_gold", VIEWS["v_labelled"].replace("v_target", "v_target_gold"))
view(
    "v_given_scores",
    f"""
with o as (
  select q.doc_id, q.candidate_index, o.pos, o.text from v_questions_gold q join v_mcq m on m.row_id = q.doc_id,
  lateral (select unnest(range({5 + len(V.FIXED_FILLERS)})) as pos,
    unnest([q.answer_text, m."A", m."B", m."C", m."D", {', '.join(lit(f) for f in V.FIXED_FILLERS)}]) as text) o
  where o.text is not null),
first as (select * from o qualify row_number() over (partition by doc_id, candidate_index, lower(text) order by pos) = 1),
four as (select *, round(least(length(text) / 40.0::double, 1.0::double), 9) as p from first
  qualify row_number() over (partition by doc_id, candidate_index order by pos) <= 4)
select doc_id, candidate_index, own, other, own - other as margin, 1 + len(list_filter(ps, lambda x: x > own)) as place, list_max(ps) - list_min(ps) as spread
from (select doc_id, candidate_index, max(p) filter (where pos = 0) as own, max(p) filter (where pos > 0) as other, list(p) as ps
      from four group by 1, 2)
""",
)
_GIVEN = dict(zip(V.RANKER_FEATURES[-5:], ("own", "other", "margin", "place", "spread"), strict=True))


@query(
    "ranker_training_rows_given",
    f"""
    select r.doc_id as group_id, r.candidate_index, r.template, {', '.join(f'r.{n}' for n in V.RANKER_FEATURES[:-5])},
      {', '.join(f'round(g.{v}::double, 6) as {n}' for n, v in _GIVEN.items())},
      round(l.target + 1e-10::double, 6) as target, l.label
    from v_ranker_gold r join v_given_scores g on g.doc_id = r.doc_id and g.candidate_index = r.candidate_index
    join v_labelled_gold l on l.doc_id = r.doc_id and l.candidate_index = r.candidate_index""",
)
def ranker_training_rows_given(spark, folder):
    """The training table with a probability that SQL knows in place of trained
    verifiers: the way from options to the five columns, targets and labels."""

    def given(groups):
        listed = lambda x: F.transform(x["options"], lambda o: OP.fixed_probability(o["text"]))
        scores = F.transform("asked", lambda x: F.struct(x["item"].alias("item"), listed(x).alias("scores")))
        return groups.select("group_id", F.inline(scores))

    rows = rounded(scored_rows(spark, folder, given), V.RANKER_FEATURES)
    return rows.select("group_id", "candidate_index", "template", *V.RANKER_FEATURES, settled("target"), "label")


@query(
    "build_options_for_candidate",
    """
    select * from (
    with pool as (
      select q.doc_id, q.rank, o.pos, o.text from (select doc_id, rank, text from v_cand where rank < 8) q
      join v_mcq m on m.row_id = q.doc_id,
      lateral (select unnest(range(9)) as pos,
        unnest([q.text, m."A", m."B", m."C", m."D", 'related detail', 'background fact', 'supporting idea', 'none of these']) as text) o
      where o.text is not null),
    first as (select * from pool qualify row_number() over (partition by doc_id, rank, lower(text) order by pos) = 1)
    select doc_id, rank, row_number() over (partition by doc_id, rank order by pos) as place, text as option_text
    from first qualify place <= 4)
    """,
)
def build_options_for_candidate(spark, folder):
    rows = C.with_candidates(usable(spark, folder).withColumn("doc_id", F.col("row_id")))
    answers = rows.select(
        "doc_id", *V.LABELS, F.posexplode(F.slice("candidates", 1, 8)).alias("rank", "entry")
    )
    made = answers.select(
        "doc_id",
        "rank",
        F.posexplode(R.options_for_candidate(F.col("entry.text"))).alias("p", "option_text"),
    )
    return made.select("doc_id", "rank", (F.col("p") + 1).alias("place"), "option_text")


# -- distractor rows ---------------------------------------------------------------------------------

_DISTRACTOR = f"""
  levenshtein(lower(correct_answer), lower(option_text))::double as edit_distance,
  abs(length(correct_answer) - length(option_text))::double as length_difference,
  contains(lower(article), lower(option_text))::int::double as in_article,
  round({s_lexical_cosine('correct_answer', 'option_text')}, 6) as lexical_cosine
"""


@query(
    "distractor_features",
    f"select row_id, label as option_id, {_DISTRACTOR} from v_options where is_correct = 0",
)
def distractor_features(spark, folder):
    rows = X.distractor_training_rows(usable(spark, folder)).where("label = 1").drop("label")
    return rounded(rows, ["lexical_cosine"])


view(
    "v_drows",
    f"""
select row_id, label as option_id, {_DISTRACTOR}, 1 as label from v_options where is_correct = 0
union all
select row_id, option_id, {_DISTRACTOR}, 0 as label
from (select row_id, article, correct_answer, n.option_id, n.option_text from v_mcq,
  (values ('n0', 'object'), ('n1', 'thing'), ('n2', 'unknown'), ('n3', 'item')) n(option_id, option_text))
""",
)


@query("distractor_training_rows", "select * from v_drows")
def distractor_training_rows(spark, folder):
    return rounded(X.distractor_training_rows(usable(spark, folder)), ["lexical_cosine"])


@query("negative_distractors", "select row_id, option_id, edit_distance from v_drows where label = 0")
def negative_distractors(spark, folder):
    rows = X.distractor_training_rows(usable(spark, folder)).where("label = 0")
    return rows.select("row_id", "option_id", "edit_distance")
