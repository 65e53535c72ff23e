"""Metrics, votes, grades and corpus reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog.corpora import _PAD, _held, settled, target_table
from quizlake.catalog.registry import lit, query, s_clean, s_strip, s_words, view
from quizlake.catalog.tables import usable
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, features as X, metrics as M, reshape as R, verdicts as D
from quizlake.plans import quizzes as P
from quizlake.sources import tables as S

# -- three fixed probability models, so that votes and metrics can be recomputed ---------------

view(
    "v_scores",
    f"""
select row_id, label, is_correct, lr, svm, rf, round((lr + svm + rf) / 3, 9) as p from (
  select row_id, label, is_correct, round(1.0::double / (1.0::double + exp(1.0::double - 2.0::double * share)), 9) as lr,
    round(0.25::double + 0.5::double * size, 9) as svm, round(0.5::double * share + 0.5::double * (1.0::double - size), 9) as rf
  from (select row_id, label, is_correct,
      case when len(ow) > 0 then {_held('ow', 'pad')}::double / len(ow) else 0.0::double end as share,
      least(length(co) / 40.0::double, 1.0::double) as size
    from (select *, {_PAD('ca')} as pad, list_distinct({s_words('co')}) as ow from v_oclean)))
""",
)


def _fixed_models(article_pad, clean_option):
    words = F.array_distinct(T.split_words(clean_option))
    share = X._share(words, article_pad)
    size = F.least(F.length(clean_option) / F.lit(40.0), F.lit(1.0))
    return (
        F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.0) - F.lit(2.0) * share)), 9).alias("lr"),
        F.round(F.lit(0.25) + F.lit(0.5) * size, 9).alias("svm"),
        F.round(F.lit(0.5) * share + F.lit(0.5) * (F.lit(1.0) - size), 9).alias("rf"),
    )


def scores(spark, folder):
    """Option scores of the usable questions, made inside the question row."""
    rows = usable(spark, folder)
    options = F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("text")) for n in V.LABELS])
    made = T.let(
        X.padded(T.clean_text(F.col("article"))),
        lambda pad: F.transform(
            options,
            lambda o: F.struct(
                o["label"].alias("label"),
                (o["label"] == F.col("answer")).cast("int").alias("is_correct"),
                *_fixed_models(pad, T.clean_text(o["text"])),
            ),
        ),
    )
    return rows.select("row_id", F.inline(made)).withColumn(
        "p", F.round(D.soft_vote(F.col("lr"), F.col("svm"), F.col("rf")), 9)
    )


@query("soft_vote", "select row_id, label, lr, svm, rf, round(p, 6) as p from v_scores")
def soft_vote(spark, folder):
    return scores(spark, folder).select("row_id", "label", "lr", "svm", "rf", F.round("p", 6).alias("p"))


def _by_model(spark, folder):
    parts = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in
          [("lr", "lr"), ("svm", "svm"), ("rf", "rf"), ("vote", "p")]]
    )
    return scores(spark, folder).select("is_correct", F.inline(parts))


view(
    "v_confusion",
    """
select model, count(*) filter (where is_correct = 1 and p >= 0.5) as tp,
  count(*) filter (where is_correct = 0 and p >= 0.5) as fp,
  count(*) filter (where is_correct = 0 and p < 0.5) as tn,
  count(*) filter (where is_correct = 1 and p < 0.5) as fn
from (select is_correct, unnest(['lr', 'svm', 'rf', 'vote']) as model, unnest([lr, svm, rf, p]) as p from v_scores)
group by model
""",
)


@query("confusion", "select * from v_confusion")
def confusion(spark, folder):
    return M.confusion(_by_model(spark, folder), "is_correct", F.col("p") >= 0.5, "model")


@query(
    "binary_metrics",
    """select model, round((tp + tn)::double / (tp + fp + tn + fn), 4) as accuracy,
       round(case when tp + fp = 0 then 0 else tp::double / (tp + fp) end, 4) as precision,
       round(case when tp + fn = 0 then 0 else tp::double / (tp + fn) end, 4) as recall,
       round(case when 2 * tp + fp + fn = 0 then 0 else 2 * tp::double / (2 * tp + fp + fn) end, 4) as f1
       from v_confusion""",
)
def binary_metrics(spark, folder):
    made = M.binary_metrics(M.confusion(_by_model(spark, folder), "is_correct", F.col("p") >= 0.5, "model"))
    return made.select("model", *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(
    "roc_auc",
    """
    select round(sum(pos * (coalesce(below, 0) + 0.5 * neg))::double / nullif(sum(pos) * sum(neg), 0), 6) as roc_auc
    from (select *, sum(neg) over (order by s rows between unbounded preceding and 1 preceding) as below
      from (select p as s, count(*) filter (where is_correct = 1) as pos,
              count(*) filter (where is_correct = 0) as neg from v_scores group by 1))""",
)
def roc_auc(spark, folder):
    return M.roc_auc(scores(spark, folder), "is_correct", "p").select(F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "mcq_accuracy",
    """select count(*) as n_questions, round(avg(is_correct), 6) as accuracy from (
         select * from v_scores qualify row_number() over (partition by row_id order by p desc, label) = 1)""",
)
def mcq_accuracy(spark, folder):
    made = M.mcq_accuracy(scores(spark, folder), "row_id", "label", "is_correct", "p")
    return made.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "correct_rank",
    """
    select c.row_id, round(c.p, 6) as correct_score, round(max(o.p) filter (where o.is_correct = 0), 6) as best_other,
      round(c.p - max(o.p) filter (where o.is_correct = 0), 6) as margin,
      1 + count(*) filter (where o.p > c.p) as rank, round(max(o.p) - min(o.p), 6) as spread
    from v_scores c join v_scores o on o.row_id = c.row_id where c.is_correct = 1 group by c.row_id, c.p""",
)
def correct_rank(spark, folder):
    made = D.rank_of_correct(scores(spark, folder), "row_id")
    numbers = ["correct_score", "best_other", "margin", "spread"]
    return made.select("row_id", "rank", *[F.round(c, 6).alias(c) for c in numbers])


view(
    "v_ranked_target",
    """select doc_id, candidate_index, template, round(target, 9) as target,
       round(length(question) / 100.0::double, 9) as predicted from v_target""",
)


@query(
    "ranking_metrics",
    """
    with c as (select * from v_ranked_target qualify row_number() over (partition by doc_id order by predicted desc, candidate_index) = 1),
    o as (select * from v_ranked_target qualify row_number() over (partition by doc_id order by target desc, candidate_index) = 1)
    select count(*) as n_groups, round(avg((c.candidate_index = o.candidate_index)::int), 6) as top1_match,
      round(avg(c.target), 6) as chosen_mean_target, round(avg(o.target), 6) as oracle_mean_target,
      round(avg((c.template = 'cloze')::int), 6) as chosen_cloze_rate,
      round(avg((o.template = 'cloze')::int), 6) as oracle_cloze_rate
    from c join o on o.doc_id = c.doc_id""".replace("with c as", "select * from (with c as", 1) + ")",
)
def ranking_metrics(spark, folder):
    rows = target_table(spark, folder).select(
        F.col("doc_id").alias("group_id"),
        "candidate_index",
        "template",
        F.round("target", 9).alias("target"),
        F.round(F.length("question") / F.lit(100.0), 9).alias("predicted"),
    )
    made = M.ranking_metrics(rows)
    return made.select("n_groups", *[F.round(c, 6).alias(c) for c in made.columns[1:]])


# -- grading and session log -------------------------------------------------------------------

view(
    "v_attempts",
    """select event_id, ts, user_id, value, 'p' || (event_id % (select count(*) from part)) as row_id,
       substr('ABCD', (event_id % 4)::int + 1, 1) as selected from events""",
)
view(
    "v_graded",
    """
select a.*, m.answer as correct_label, m.correct_answer,
  case selected when 'A' then "A" when 'B' then "B" when 'C' then "C" else "D" end as selected_option,
  (selected = m.answer)::int as is_correct
from v_attempts a join v_mcq m on m.row_id = a.row_id
""",
)


def attempts_of(spark, folder, events):
    n = S.table(spark, folder, "part").agg(F.count("*")).scalar()
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.concat(F.lit("p"), F.col("event_id") % n).alias("row_id"),
        F.substr(F.lit("ABCD"), (F.col("event_id") % 4 + 1).cast("int"), F.lit(1)).alias("selected"),
    )


def attempts(spark, folder):
    return attempts_of(spark, folder, S.table(spark, folder, "events"))


def answer_key(spark, folder):
    return usable(spark, folder).select("row_id", *V.LABELS, "answer", "correct_answer")


@query(
    "grade_attempts",
    "select event_id, row_id, selected, correct_label, correct_answer, selected_option, is_correct from v_graded",
)
def grade_attempts(spark, folder):
    made = D.grade_attempts(attempts(spark, folder), answer_key(spark, folder))
    return made.select(
        "event_id", "row_id", "selected", "correct_label", "correct_answer", "selected_option", "is_correct"
    )


@query(
    "session_summary",
    """select user_id, count(*) as n_quizzes, round(avg(is_correct), 6) as match_rate,
       round(avg(value), 4) as mean_latency, max(ts) as last_ts from v_graded group by user_id""",
)
def session_summary(spark, folder):
    made = D.grade_attempts(attempts(spark, folder), answer_key(spark, folder))
    return made.groupBy("user_id").agg(
        F.count("*").alias("n_quizzes"),
        F.round(F.avg("is_correct"), 6).alias("match_rate"),
        F.round(F.avg("value"), 4).alias("mean_latency"),
        F.max("ts").alias("last_ts"),
    )


@query("export_log", "select event_id, user_id, row_id, selected, correct_answer, is_correct from v_graded")
def export_log(spark, folder):
    from quizlake.sources import storage

    made = D.grade_attempts(attempts(spark, folder), answer_key(spark, folder))
    log = made.select("event_id", "user_id", "row_id", "selected", "correct_answer", "is_correct")
    return storage.through_csv(log)


# -- predicted answers and quality of the quizzes ---------------------------------------------------

_LABELLED = "unnest(['A', 'B', 'C', 'D']) as label, unnest([option_a, option_b, option_c, option_d]) as option_text"
view(
    "v_predicted",
    f"""
with o as (select doc_id, correct_answer, question, {_LABELLED} from v_quiz),
s as (select o.*, lower(p.article) as art, lower(c.sentence) as sent,
    round(least(length(option_text) / 40.0::double, 1.0::double), 9) as p
  from o join v_passages p on p.doc_id = o.doc_id join v_cand c on c.doc_id = o.doc_id and c.rank = 0),
m as (select *, max(p) over (partition by doc_id) as best from s)
select doc_id, question, correct_answer, label, option_text from m where p >= best - 0.003::double
qualify row_number() over (partition by doc_id order by
  contains(sent, lower(option_text)) desc,
  case when strpos(art, lower(option_text)) = 0 then 1000000000 else strpos(art, lower(option_text)) - 1 end,
  abs(len({s_words(s_strip('option_text'))}) - 2), label) = 1
""",
)


def predicted_quizzes(spark, folder):
    """Rule-based quizzes with the label a length-scored verifier would pick."""
    passages = S.passages(spark, folder)
    drafts = P.quiz_drafts(passages)
    answer = F.col("correct.text")
    shuffled = drafts.select(
        "doc_id",
        "article",
        answer.alias("correct_answer"),
        F.get("sentences", F.col("correct.sent_idx")).alias("sentence"),
        F.col("correct.kind").alias("kind"),
        F.explode(
            F.filter(
                F.array(
                    F.when(
                        F.size("options") == 4,
                        P.Q.shuffled(F.col("options"), F.concat(F.md5("article"), answer)),
                    )
                ),
                lambda o: o.isNotNull(),
            )
        ).alias("options"),
    )
    scored = F.transform(
        "options",
        lambda o, i: F.struct(
            F.substr(F.lit("ABCD"), i + 1, F.lit(1)).alias("label"),
            o.alias("text"),
            F.round(F.least(F.length(o) / F.lit(40.0), F.lit(1.0)), 9).alias("p"),
        ),
    )
    label = D.predict_label(scored, F.col("article"), F.col("sentence"))
    return shuffled.select(
        "doc_id",
        P.Q.template_question(F.col("correct_answer"), F.col("kind"), F.col("sentence")).alias("question"),
        "correct_answer",
        label.alias("label"),
        "options",
    ).withColumn("predicted_answer", F.get("options", F.ascii("label") - 65))


@query("predict_answer", "select doc_id, label, option_text as predicted_answer from v_predicted")
def predict_answer(spark, folder):
    return predicted_quizzes(spark, folder).select("doc_id", "label", "predicted_answer")


@query(
    "quiz_report",
    """select doc_id, question, correct_answer, option_text as predicted_answer,
       (lower(option_text) = lower(correct_answer))::int as matched from v_predicted""",
)
def quiz_report(spark, folder):
    made = predicted_quizzes(spark, folder)
    return made.select(
        "doc_id",
        "question",
        "correct_answer",
        "predicted_answer",
        (F.lower("predicted_answer") == F.lower("correct_answer")).cast("int").alias("matched"),
    )


view(
    "v_quality",
    """
select c.doc_id, c.text as correct_answer,
  case when count(s.option_text) >= 3 then 'strict' else 'last_resort' end as option_quality
from v_cand c left join v_same_passage s on s.doc_id = c.doc_id where c.rank = 0 group by 1, 2
""",
)


def quality_table(spark, folder):
    drafts = P.quiz_drafts(S.passages(spark, folder))
    made = drafts.select(
        "doc_id",
        F.col("correct.text").alias("correct_answer"),
        F.when(F.size("options") >= 4, "strict").otherwise("last_resort").alias("option_quality"),
    )
    return made.select(
        "doc_id", "option_quality",
        F.explode(F.filter(F.array("correct_answer"), lambda a: a.isNotNull())).alias("correct_answer"),
    )


@query(
    "quality_counts",
    """select option_quality, count(*) as n_quizzes,
       round(avg((option_quality not in ('strict', 'retrieved'))::int), 6) as fallback_rate
       from v_quality group by 1""",
)
def quality_counts(spark, folder):
    weak = (~F.col("option_quality").isin("strict", "retrieved")).cast("int")
    return quality_table(spark, folder).groupBy("option_quality").agg(
        F.count("*").alias("n_quizzes"), F.round(F.avg(weak), 6).alias("fallback_rate")
    )


@query(
    "weak_items",
    """select doc_id, option_quality, correct_answer from v_quality
       where option_quality in ('relaxed', 'last_resort') order by doc_id limit 10""",
)
def weak_items(spark, folder):
    rows = quality_table(spark, folder).where(F.col("option_quality").isin("relaxed", "last_resort"))
    return rows.select("doc_id", "option_quality", "correct_answer").orderBy("doc_id").limit(10)


# -- reports on the question table ---------------------------------------------------------------------

_ALL = ["row_id", "article", "question", "A", "B", "C", "D", "answer"]


@query(
    "missing_values",
    "select * from (" + " union all ".join(
        f"""select '{c}' as "column", count(*) filter (where "{c}" is null) as n_missing, count(*) as n_rows from v_raw"""
        for c in _ALL
    ) + ")",
)
def missing_values(spark, folder):
    rows = S.raw_questions(spark, folder)
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in _ALL], F.count("*").alias("n_rows"))
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_missing")) for c in _ALL])
    return counted.select("n_rows", F.inline(parts)).select("column", "n_missing", "n_rows")


@query(
    "dtypes",
    "select * from (" + " union all ".join(
        f"""select '{c}' as "column", 'string' as data_type, count("{c}") as n_values from v_raw""" for c in _ALL
    ) + ")",
)
def dtypes(spark, folder):
    rows = S.raw_questions(spark, folder)
    kinds = dict(rows.dtypes)
    counted = rows.agg(*[F.count(c).alias(c) for c in _ALL])
    parts = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("data_type"), F.col(c).alias("n_values"))
            for c in _ALL
        ]
    )
    return counted.select(F.inline(parts))


@query(
    "label_distribution",
    """select answer, count(*) as n_rows, round(count(*)::double / sum(count(*)) over (), 3) as share
       from v_raw group by answer""",
)
def label_distribution(spark, folder):
    rows = S.raw_questions(spark, folder)
    total = rows.agg(F.count("*")).scalar()
    return rows.groupBy("answer").agg(F.count("*").alias("n_rows")).withColumn(
        "share", F.round(F.col("n_rows") / total, 3)
    )


view(
    "v_lengths",
    f"""
select 'article' as "column", len({s_words('article')}) as v from v_mcq
union all select 'question', len({s_words('question')}) from v_mcq
union all select 'option', len({s_words('option_text')}) from v_options
""",
)


def _lengths(spark, folder):
    rows = usable(spark, folder)
    return {
        "article": rows.select(M.word_count(F.col("article")).alias("v")),
        "question": rows.select(M.word_count(F.col("question")).alias("v")),
        "option": R.explode_options(rows, ["row_id"]).select(M.word_count(F.col("option_text")).alias("v")),
    }


_DESCRIBE = """count(*) as n_rows, round(avg(v), 4) as mean, round(stddev_samp(v), 4) as std, min(v) as min,
  quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q75, max(v) as max"""


def _described(df):
    return df.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query("length_stats", f'select "column", {_DESCRIBE} from v_lengths group by 1')
def length_stats(spark, folder):
    out = None
    for name, df in _lengths(spark, folder).items():
        part = _described(M.describe(df, "v", name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "length_histogram",
    """
    select "column", least(floor((v - lo) * bins / greatest(hi - lo, 1)), bins - 1)::bigint as bin, count(*) as n_rows
    from (select "column", v, min(v) over (partition by "column") as lo, max(v) over (partition by "column") as hi,
            case "column" when 'article' then 60 else 30 end as bins
          from v_lengths where "column" <> 'option' or v <= 30) group by all""",
)
def length_histogram(spark, folder):
    parts = _lengths(spark, folder)
    out = M.histogram(parts["article"], "v", 60, "article")
    out = out.unionByName(M.histogram(parts["question"], "v", 30, "question"))
    return out.unionByName(M.histogram(parts["option"].where("v <= 30"), "v", 30, "option"))


@query(
    "wh_breakdown",
    f"""
    select case when regexp_matches(q, '^({'|'.join(V.WH_WORDS)})') then regexp_extract(q, '^\\S+') else '(other)' end as first_word,
      count(*) as n_rows, round(count(*)::double / sum(count(*)) over (), 6) as share
    from (select {s_strip('lower(question)')} as q from v_mcq) group by 1""",
)
def wh_breakdown(spark, folder):
    rows = usable(spark, folder).select(T.strip(F.lower("question")).alias("q"))
    total = rows.agg(F.count("*")).scalar()
    starts = F.col("q").rlike("^(" + "|".join(V.WH_WORDS) + ")")
    first = F.when(starts, F.regexp_extract("q", r"^\S+", 0)).otherwise("(other)")
    return rows.groupBy(first.alias("first_word")).agg(F.count("*").alias("n_rows")).withColumn(
        "share", F.round(F.col("n_rows") / total, 6)
    )


@query(
    "exact_match_rate",
    f"""select count(*) as n_rows, sum(hit)::bigint as n_matches, round(avg(hit), 6) as rate
        from (select contains({s_clean('article')}, {s_clean('correct_answer')})::int as hit from v_mcq)""",
)
def exact_match_rate(spark, folder):
    hit = F.contains(T.clean_text(F.col("article")), T.clean_text(F.col("correct_answer"))).cast("int")
    return usable(spark, folder).select(hit.alias("hit")).agg(
        F.count("*").alias("n_rows"), F.sum("hit").alias("n_matches"), F.round(F.avg("hit"), 6).alias("rate")
    )


view(
    "v_n_cand",
    """select p.doc_id, count(c.doc_id) as v from v_passages p left join v_cand c on c.doc_id = p.doc_id group by 1""",
)


@query(
    "candidate_coverage",
    f"""select 'candidates' as "column", {_DESCRIBE}, round(avg((v > 0)::int), 6) as coverage from v_n_cand""",
)
def candidate_coverage(spark, folder):
    rows = C.with_candidates(S.passages(spark, folder)).select(F.size("candidates").alias("v"))
    counted = rows.groupBy("v").agg(F.count("*").alias("n"))
    share = counted.agg(
        F.round(F.sum(F.when(F.col("v") > 0, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("coverage")
    )
    return _described(M.describe(rows, "v", "candidates")).withColumn("coverage", share.scalar())


@query(
    "overlap_by_class",
    f"""
    select is_correct, bin, count(*) as n_rows, any_value(mean_overlap) as mean_overlap from (
      select is_correct, least(floor(share * 40), 39)::bigint as bin,
        round(avg(share) over (partition by is_correct), 6) as mean_overlap
      from (select is_correct, case when len(ow) > 0 then {_held('ow', 'pad')}::double / len(ow) else 0.0::double end as share
            from (select is_correct, {_PAD('ca')} as pad, list_distinct({s_words('co')}) as ow from v_oclean)))
    group by 1, 2""",
)
def overlap_by_class(spark, folder):
    rows = usable(spark, folder)
    options = F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("text")) for n in V.LABELS])
    made = T.let(
        X.padded(T.clean_text(F.col("article"))),
        lambda pad: F.transform(
            options,
            lambda o: F.struct(
                (o["label"] == F.col("answer")).cast("int").alias("is_correct"),
                X._share(F.array_distinct(T.split_words(T.clean_text(o["text"]))), pad).alias("share"),
            ),
        ),
    )
    binned = (
        rows.select(F.inline(made))
        .groupBy("is_correct", F.least(F.floor(F.col("share") * 40), F.lit(39)).alias("bin"))
        .agg(F.count("*").alias("n_rows"), F.sum("share").alias("total"))
    )
    # at most eighty rows remain, so the class means are read from the bins
    from pyspark.sql import Window

    w = Window.partitionBy("is_correct")
    mean = F.sum("total").over(w) / F.sum("n_rows").over(w)
    return binned.select("is_correct", "bin", "n_rows", F.round(mean, 6).alias("mean_overlap"))
