"""Retrieval and option selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog.corpora import settled, vocabulary
from quizlake.catalog.extraction import with_best_sentence
from quizlake.catalog.questions import question_table
from quizlake.catalog.registry import (
    query, s_answer_category, s_bad_question, s_clean, s_compat, s_contains_key, s_key, s_length_compat,
    s_lexical_cosine, s_option_category, s_terms, s_usable, view,
)
from quizlake.catalog.tables import usable
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, corpus as K, options as OP, retrieval as RT
from quizlake.sources import storage

view(
    "v_rec",
    """select option_category as category, option_key, document, min(opt_id) as rec_id, min_by(text, opt_id) as text,
       count(*) as n_copies from v_corpus group by 1, 2, 3""",
)
view(
    "v_rec_w",
    f"""
select *, sqrt((sum(w * w) over (partition by rec_id))::double) as norm from (
  select rec_id, t.term, round((1.0::double + ln(count(*))) * any_value(idf) * 1000000)::bigint as w
  from (select rec_id, unnest({s_terms('document')}) as term from v_rec) t join v_idf i on i.term = t.term
  group by rec_id, t.term)
""",
)
view(
    "v_query",
    f"""
select row_id as q_id, {s_clean("(question || ' ' || correct_answer || ' ' || coalesce(sentence, ''))")} as query_text,
  {s_option_category('correct_answer', 'question')} as category from v_best
""",
)
view(
    "v_query_w",
    f"""
select *, sqrt((sum(w * w) over (partition by q_id))::double) as norm from (
  select q_id, t.term, round((1.0::double + ln(count(*))) * any_value(idf) * 1000000)::bigint as w
  from (select q_id, unnest({s_terms('query_text')}) as term from v_query) t join v_idf i on i.term = t.term
  group by q_id, t.term)
""",
)
view(
    "v_pairs",
    """
select q.q_id, r.rec_id, sum(q.w * r.w)::bigint::double / any_value(r.norm) as s, any_value(q.norm) as norm
from v_query_w q join v_rec_w r on r.term = q.term group by 1, 2
""",
)
view(
    "v_search",
    """
select * from (values ('term','term'),('term','definition'),('term','statement'),('definition','term'),
  ('definition','definition'),('definition','statement'),('statement','term'),('statement','definition'),
  ('statement','statement'),('properNoun','properNoun'),('properNoun','term'),
  ('educationDegree','educationDegree'),('date','date'),('number','number'),('person','person'),
  ('location','location'),('acronym','acronym')) s(correct, category)
""",
)
view(
    "v_in_category",
    """
select * from (
  select p.q_id, c.option_key, p.rec_id, p.s, p.norm from v_pairs p
  join v_rec c on c.rec_id = p.rec_id join v_query q on q.q_id = p.q_id
  join v_search s on s.correct = q.category and s.category = c.category
  qualify row_number() over (partition by p.q_id, c.option_key order by s desc, p.rec_id) = 1)
qualify row_number() over (partition by q_id order by s desc, option_key) <= 180
""",
)
view(
    "v_topped",
    """
with short as (select q_id from v_query where q_id not in (
    select q_id from v_in_category group by 1 having count(*) >= 180)),
everywhere as (
  select * from (
    select p.q_id, c.option_key, p.rec_id, p.s, p.norm from v_pairs p join short s on s.q_id = p.q_id
    join v_rec c on c.rec_id = p.rec_id
    qualify row_number() over (partition by p.q_id, c.option_key order by s desc, p.rec_id) = 1)
  qualify row_number() over (partition by q_id order by s desc, option_key) <= 180),
both_ as (select * from v_in_category union all select * from everywhere),
one as (select * from both_ qualify row_number() over (partition by q_id, option_key order by s desc, rec_id) = 1)
select * from one qualify row_number() over (partition by q_id order by s desc, option_key) <= 180
""",
)


def mcq_queries(spark, folder):
    """Question, answer and source sentence of each usable question."""
    rows = with_best_sentence(spark, folder).where("sent_idx is not null")
    own = C.option_category(F.col("correct_answer"), F.col("question"))
    return rows.select(
        F.col("row_id").alias("q_id"),
        T.clean_text(F.concat_ws(" ", "question", "correct_answer", "sentence")).alias("query_text"),
        RT.search_categories(own).alias("categories"),
    )


def records(spark, folder):
    return K.corpus_records(usable(spark, folder))


def _scored(df):
    return df.select("q_id", "option_key", "opt_id", F.round("score", 6).alias("score"))


@query(
    "retrieval_join",
    """select q_id, option_key, rec_id as opt_id, round(s / norm, 6) as score from v_in_category""",
)
def retrieval_join(spark, folder):
    return _scored(
        RT.retrieve(
            mcq_queries(spark, folder), records(spark, folder), vocabulary(spark, folder),
            top_up=False,
        )
    )


@query(
    "topk_retrieval",
    """select q_id, option_key, rec_id as opt_id, round(s / norm, 6) as score from v_topped""",
)
def topk_retrieval(spark, folder):
    return _scored(
        RT.retrieve(
            mcq_queries(spark, folder), records(spark, folder), vocabulary(spark, folder),
        )
    )


# -- option selection for the best question of each passage, with fixed scores --------------------

view(
    "v_draft",
    f"""
select c.doc_id as q_id, c.text as answer, c.kind, c.sentence, t.question,
  {s_answer_category('c.text', 'c.kind', 'c.sentence', 't.question')} as category,
  {s_key('c.text')} as answer_key
from v_cand c join v_template_question t on t.doc_id = c.doc_id and t.rank = c.rank where c.rank = 0
""",
)
view(
    "v_draft_w",
    f"""
select *, sqrt((sum(w * w) over (partition by q_id))::double) as norm from (
  select q_id, t.term, round((1.0::double + ln(count(*))) * any_value(idf) * 1000000)::bigint as w
  from (select q_id, unnest({s_terms(s_clean("(question || ' ' || answer || ' ' || coalesce(sentence, ''))"))}) as term
        from v_draft) t join v_idf i on i.term = t.term
  group by q_id, t.term)
""",
)
view(
    "v_draft_pairs",
    """
select q.q_id, r.rec_id, sum(q.w * r.w)::bigint::double / any_value(r.norm) as s, any_value(q.norm) as norm
from v_draft_w q join v_rec_w r on r.term = q.term group by 1, 2
""",
)
view(
    "v_draft_found",
    """
with inside as (
  select * from (
    select p.q_id, c.option_key, p.rec_id, p.s, p.norm from v_draft_pairs p
    join v_rec c on c.rec_id = p.rec_id join v_draft q on q.q_id = p.q_id
    join v_search s on s.correct = q.category and s.category = c.category
    qualify row_number() over (partition by p.q_id, c.option_key order by s desc, p.rec_id) = 1)
  qualify row_number() over (partition by q_id order by s desc, option_key) <= 180),
short as (select q_id from v_draft where q_id not in (select q_id from inside group by 1 having count(*) >= 180)),
everywhere as (
  select * from (
    select p.q_id, c.option_key, p.rec_id, p.s, p.norm from v_draft_pairs p join short s on s.q_id = p.q_id
    join v_rec c on c.rec_id = p.rec_id
    qualify row_number() over (partition by p.q_id, c.option_key order by s desc, p.rec_id) = 1)
  qualify row_number() over (partition by q_id order by s desc, option_key) <= 180),
one as (select * from (select * from inside union all select * from everywhere)
        qualify row_number() over (partition by q_id, option_key order by s desc, rec_id) = 1),
top as (select * from one qualify row_number() over (partition by q_id order by s desc, option_key) <= 180)
select t.q_id, t.option_key as key, r.text, r.category, round(t.s / t.norm, 9) as retrieval
from top t join v_rec r on r.rec_id = t.rec_id
""",
)
view(
    "v_art_key",
    f"select doc_id as q_id, article, {s_key('article')} as article_key from v_passages",
)


def _fixed(text: str) -> str:
    return f"round(least(length({text}) / 40.0::double, 1.0::double), 9)"


view(
    "v_pool",
    f"""
with e as (
  select f.*, 'corpus' as source, d.answer, d.answer_key, d.category as correct_category, a.article,
    row_number() over (partition by f.q_id order by retrieval desc, key) - 1 as pos,
    {s_usable('f.text', 'd.answer')} as usable, {s_contains_key('a.article_key', 'f.key')} as in_passage
  from v_draft_found f join v_draft d on d.q_id = f.q_id join v_art_key a on a.q_id = f.q_id
  union all by name
  select d.q_id, {s_key('c.text')} as key, c.text, d.category, 1.0::double as retrieval, 'article' as source,
    d.answer, d.answer_key, d.category as correct_category, a.article, c.rank as pos, true as usable, false as in_passage
  from v_draft d join v_cand c on c.doc_id = d.q_id and {s_key('c.text')} <> d.answer_key
    and {s_answer_category('c.text', 'c.kind', 'c.sentence', 'd.question')} = d.category
    and not {s_contains_key(s_key('c.text'), 'd.answer_key')} and {s_usable('c.text', 'd.answer')}
  join v_art_key a on a.q_id = d.q_id)
select q_id, key, text, category, retrieval, source, answer, answer_key, correct_category, pos, usable, in_passage,
  {s_compat('correct_category', 'category', False)} as strict_type, {s_compat('correct_category', 'category', True)} as relaxed_type,
  {s_length_compat('answer', 'text')} as length_score,
  round(1.0::double / (1.0::double + exp(-(0.05::double * levenshtein(lower(answer), lower(text))
    - 0.02::double * abs(length(answer) - length(text)) + 0.5::double * contains(lower(article), lower(text))::int
    + {s_lexical_cosine('answer', 'text')}))), 9) as model
from e
""",
)
_SCORE = "round(0.42::double * retrieval + 0.24::double * model + 0.18::double * type_score + 0.12::double * length_score + case when source = 'article' then 0.12::double else 0.0::double end, 9)"
view(
    "v_staged",
    f"""
with s as (
  select *, 0 as stage, strict_type as type_score from v_pool where source = 'article'
  union all select *, 1, strict_type from v_pool where source = 'corpus' and usable and not in_passage and strict_type >= 1
  union all select *, 2, relaxed_type from v_pool where source = 'corpus' and usable and not in_passage and relaxed_type > 0
  union all select *, 3, relaxed_type from v_pool where source = 'corpus' and usable and not in_passage),
f as (select *, {_SCORE} as first_score from s),
r as (select *, row_number() over (partition by q_id, stage order by first_score desc, pos) - 1 as first_rank from f)
select q_id, stage, text, key, answer_key, first_rank,
  case when first_rank < 24 then round(first_score + 0.16::double * greatest(-1.0::double, least(1.0::double,
    {_fixed('answer')} - {_fixed('text')})), 9) else first_score end as score
from r
""",
)
view(
    "v_tried",
    f"""
with a as (
  select q_id, stage, case stage when 0 then 'strict' when 1 then 'retrieved' when 2 then 'relaxed' else 'last_resort' end as quality,
    text, key, answer_key, score, first_rank as pos from v_staged
  union all
  select q_id, 4, 'last_resort', text, key, answer_key, retrieval, pos from v_pool where source = 'corpus' and usable
  union all
  select d.q_id, 5, 'last_resort', c.text, {s_key('c.text')}, d.answer_key, round(c.score, 9), c.rank
  from v_draft d join v_cand c on c.doc_id = d.q_id where {s_usable('c.text', 'd.answer')})
select *, row_number() over (partition by q_id order by stage, score desc, pos) as n from a
""",
)


def _similar(a: str, b: str) -> str:
    wa, wb = f"list_distinct(string_split({a}, ' '))", f"list_distinct(string_split({b}, ' '))"
    return f"(len(list_intersect({wa}, {wb})) > 0.82::double * least(len({wa}), len({wb})))"


_OK = "e.key <> '' and e.key <> e.answer_key and not " + s_contains_key("e.key", "e.answer_key")
view(
    "v_pick1",
    f"select * from v_tried e where {_OK} qualify row_number() over (partition by q_id order by n) = 1",
)
view(
    "v_pick2",
    f"""select e.* from v_tried e join v_pick1 a on a.q_id = e.q_id and e.n > a.n
        where {_OK} and e.key <> a.key and not {_similar('a.key', 'e.key')}
        qualify row_number() over (partition by e.q_id order by e.n) = 1""",
)
view(
    "v_pick3",
    f"""select e.* from v_tried e join v_pick1 a on a.q_id = e.q_id join v_pick2 b on b.q_id = e.q_id and e.n > b.n
        where {_OK} and e.key <> a.key and not {_similar('a.key', 'e.key')} and e.key <> b.key and not {_similar('b.key', 'e.key')}
        qualify row_number() over (partition by e.q_id order by e.n) = 1""",
)
view(
    "v_picked",
    """select *, 1 as place from v_pick1 union all select *, 2 from v_pick2 union all select *, 3 from v_pick3""",
)


def passage_entries(spark, folder):
    """Passages with their best question and all option entries.  Drafts and what is
    found for them are kept; the entries, many times as long, are made where they are read."""
    from quizlake.sources import tables as S

    def build():
        drafts = storage.settle(OP.question_drafts(S.passages(spark, folder)).drop("sentences"))
        index = RT.build_index(records(spark, folder), vocabulary(spark, folder))
        found = RT.search_lists(OP.retrieval_queries(drafts), index)
        storage.release(spark)
        return drafts, found

    return OP.with_entries(*storage.once(spark, "passage_drafts", folder, build))


def fixed_margin():
    return OP.margin_against(F.col("correct.text"), OP.fixed_probability)


def ladder(spark, folder):
    return OP.option_ladder(passage_entries(spark, folder), OP.fixed_scorer, fixed_margin())


@query(
    "not_in_passage",
    "select q_id, key, in_passage from v_pool where source = 'corpus'",
)
def not_in_passage(spark, folder):
    rows = passage_entries(spark, folder)
    return rows.select("q_id", F.inline("pool")).select("q_id", "key", "in_passage")


@query(
    "stage_filters",
    """select q_id, key, (usable and not in_passage and strict_type >= 1) as strict,
       (usable and not in_passage and relaxed_type > 0) as relaxed, (usable and not in_passage) as last_resort
       from v_pool where source = 'corpus'""",
)
def stage_filters(spark, folder):
    rows = passage_entries(spark, folder)
    e = rows.select("q_id", F.col("category").alias("correct_category"), F.inline("pool"))
    free = F.col("usable") & ~F.col("in_passage")
    pair = F.col("correct_category"), F.col("category")
    return e.select(
        "q_id",
        "key",
        (free & (T.category_compatibility(*pair, False) >= 1.0)).alias("strict"),
        (free & (T.category_compatibility(*pair, True) > 0.0)).alias("relaxed"),
        free.alias("last_resort"),
    )


@query(
    "rank_options",
    """select q_id, stage, quality, key, text, round(score + 1e-10::double, 6) as score,
       row_number() over (partition by q_id order by n) - 1 as place from v_tried where stage < 4""",
)
def rank_options(spark, folder):
    rows = passage_entries(spark, folder)
    tried = rows.select("q_id", F.posexplode(OP.stage_lists(OP.fixed_scorer, fixed_margin())).alias("place", "e"))
    return tried.where("e.stage < 4").select(
        "q_id", "e.stage", "e.quality", "e.key", "e.text", settled("e.score").alias("score"), "place"
    )


@query(
    "select_diverse",
    "select q_id, place, text, quality, round(score + 1e-10::double, 6) as score from v_picked",
)
def select_diverse(spark, folder):
    rows = ladder(spark, folder).select("q_id", F.posexplode("picked").alias("p", "e"))
    return rows.select(
        "q_id", (F.col("p") + 1).alias("place"), "e.text", "e.quality", settled("e.score").alias("score")
    )


view(
    "v_ladder",
    """
select d.q_id, d.answer, count(p.n) as n_picked,
  count(*) filter (where p.quality = 'strict') as n_strict, count(*) filter (where p.quality = 'retrieved') as n_retrieved,
  count(*) filter (where p.quality = 'relaxed') as n_relaxed, count(*) filter (where p.quality = 'last_resort') as n_last_resort,
  case when count(p.n) = 0 or bool_or(p.quality = 'last_resort') then 'last_resort' when bool_or(p.quality = 'relaxed') then 'relaxed'
    when bool_or(p.quality = 'retrieved') then 'retrieved' else 'strict' end as option_quality
from v_draft d left join v_picked p on p.q_id = d.q_id group by 1, 2
""",
)


@query(
    "option_ladder",
    "select q_id, n_strict, n_retrieved, n_relaxed, n_last_resort, n_picked from v_ladder",
)
def option_ladder(spark, folder):
    rows = ladder(spark, folder)
    count = lambda s: F.element_at("stage_counts", F.lit(s)).alias(f"n_{s}")
    return rows.select("q_id", *[count(s) for s in V.STAGES], F.size("picked").alias("n_picked"))


@query("overall_quality", "select option_quality, count(*) as n_quizzes from v_ladder group by 1")
def overall_quality(spark, folder):
    return ladder(spark, folder).groupBy("option_quality").agg(F.count("*").alias("n_quizzes"))


@query(
    "embedding_neighbours",
    """
    select a.vec_id, b.vec_id as option_id,
      round(coalesce(list_dot_product(a.embedding::double[], b.embedding::double[])
        / nullif(sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]))
          * sqrt(list_dot_product(b.embedding::double[], b.embedding::double[])), 0), 0), 6) as cosine
    from embeddings a join embeddings b on b.vec_id between a.vec_id + 1 and a.vec_id + 3""",
)
def embedding_neighbours(spark, folder):
    """Cosine of each answer vector with its three option vectors: the given
    pairs only, by an equi-join on the option's key."""
    from quizlake.sources import tables as S

    v = S.table(spark, folder, "embeddings")
    steps = F.array(*[F.lit(i) for i in (1, 2, 3)])
    asked = v.select("vec_id", F.col("embedding").alias("a"), F.explode(steps).alias("step")).select(
        "vec_id", "a", (F.col("vec_id") + F.col("step")).alias("option_id")
    )
    options = v.select(F.col("vec_id").alias("option_id"), F.col("embedding").alias("b"))
    return asked.join(options, "option_id").select(
        "vec_id", "option_id", F.round(T.vector_cosine(F.col("a"), F.col("b")), 6).alias("cosine")
    )


# -- ranking of questions with a fixed score ---------------------------------------------------------

view(
    "v_qscore",
    f"""
select doc_id, candidate_index, template, question, answer_rank,
  round(least(length(question) / 200.0::double, 1.0::double) * case template
    when 'definition' then 1.2::double when 'where_wh' then 1.1::double when 'suffix_wh' then 1.0::double
    when 'cloze' then 0.55::double else 0.08::double end, 9) as score
from v_questions where not {s_bad_question('question')}
""",
)
view(
    "v_qrank",
    """select *, row_number() over (partition by doc_id order by score desc, candidate_index) - 1 as place from v_qscore""",
)


def ranked_questions(spark, folder):
    from pyspark.sql import Window

    rows = question_table(spark, folder).where(~T.bad_question(F.col("question")))
    score = F.round(
        F.least(F.length("question") / F.lit(200.0), F.lit(1.0)) * OP.question_bias(F.col("template")), 9
    )
    scored = rows.select("doc_id", "candidate_index", "template", "question", "answer_rank", score.alias("score"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("score"), "candidate_index")
    return scored.withColumn("place", F.row_number().over(order) - 1)


@query(
    "rank_questions",
    "select doc_id, candidate_index, template, question, round(score, 6) as score, place from v_qrank",
)
def rank_questions(spark, folder):
    rows = ranked_questions(spark, folder)
    return rows.select(
        "doc_id", "candidate_index", "template", "question", F.round("score", 6).alias("score"), "place"
    )


_QUALITY = "case when answer_rank % 3 = 0 then 'relaxed' when answer_rank % 3 = 1 then 'last_resort' else 'retrieved' end"


_BUNDLES = f"""
select doc_id, place, question, quality, accept from (select *, quality in ('strict', 'retrieved') and matches as accept,
  round(case quality when 'strict' then 4.0::double when 'retrieved' then 3.0::double when 'relaxed' then 2.0::double else 1.0::double end
    + case when matches then 0.35::double else 0.0::double end + least(score, 1.0::double) * 0.05::double, 9) as bundle
  from (select doc_id, place, question, score, {_QUALITY} as quality, template <> 'cloze' as matches
           from v_qrank where place < 6))
qualify row_number() over (partition by doc_id order by accept desc, case when accept then -place else bundle end desc, place) = 1"""


@query("choose_bundle", _BUNDLES)
def choose_bundle(spark, folder):
    """The quality here is a fixed function of the answer's rank; the quiz job
    fills it from the option ladder."""
    rows = ranked_questions(spark, folder).where(F.col("place") < V.BUNDLE_POOL)
    rank = F.col("answer_rank") % 3
    quality = F.when(rank == 0, "relaxed").when(rank == 1, "last_resort").otherwise("retrieved")
    judged = rows.withColumn("quality", quality).withColumn("matches", F.col("template") != "cloze")
    key = OP.bundle_order(F.col("quality"), F.col("matches"), F.col("score"), F.col("place"))
    row = F.struct("place", "question", "quality", "matches")
    best = judged.groupBy("doc_id").agg(F.min_by(row, key).alias("b"))
    return best.select(
        "doc_id",
        "b.place",
        "b.question",
        "b.quality",
        (F.col("b.quality").isin("strict", "retrieved") & F.col("b.matches")).alias("accept"),
    )


@query("frontier_bundles", _BUNDLES)
def frontier_bundles(spark, folder):
    """``choose_bundle`` by the rounds of the quiz job: passages with an accepted
    bundle leave, and only the others are judged at their next places."""
    from quizlake.plans import model_quizzes as MQ

    def judge(open_):
        rank = F.col("answer_rank") % 3
        quality = F.when(rank == 0, "relaxed").when(rank == 1, "last_resort").otherwise("retrieved")
        rows = open_.withColumn("quality", quality).withColumn("matches", F.col("template") != "cloze")
        key = OP.bundle_order(F.col("quality"), F.col("matches"), F.col("score"), F.col("place"))
        return rows.select("doc_id", "place", F.struct("place", "question", "quality", "matches").alias("bundle"), key.alias("key"))

    rows = ranked_questions(spark, folder).where(F.col("place") < V.BUNDLE_POOL)
    best = MQ.frontier(storage.settle(rows), judge)
    accept = F.col("bundle.quality").isin("strict", "retrieved") & F.col("bundle.matches")
    return best.select("doc_id", "bundle.place", "bundle.question", "bundle.quality", accept.alias("accept"))
