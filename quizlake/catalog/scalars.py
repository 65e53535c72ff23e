"""Scalar expression queries: tokens, comparisons, option checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.catalog.extraction import with_best_sentence
from quizlake.catalog.registry import (
    query, s_alnum, s_alpha, s_apos, s_bigrams, s_clean, s_compat, s_contains_key, s_f1, s_key,
    s_leak, s_length_compat, s_lexical_cosine, s_lower_first, s_norm_candidate, s_option_category,
    s_ratio, s_strip, s_usable, s_words, s_clean_end,
)
from quizlake.catalog.tables import usable
from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, reshape as R
from quizlake.sources import tables as S


def option_rows(spark, folder, *keep: str):
    return R.explode_options(usable(spark, folder), ["row_id", *keep])


@query(
    "tokens",
    f"""select doc_id, len({s_apos('article')}) as n_apostrophe, len({s_alnum('article')}) as n_alnum,
          len({s_alpha('article')}) as n_alpha, len({s_words(s_clean('article'))}) as n_words,
          md5(array_to_string({s_apos('article')}, ' ')) as h_apostrophe,
          md5(array_to_string({s_alnum('article')}, ' ')) as h_alnum,
          md5(array_to_string({s_alpha('article')}, ' ')) as h_alpha,
          md5(array_to_string({s_words(s_clean('article'))}, ' ')) as h_words
        from v_passages""",
)
def tokens(spark, folder):
    kinds = {
        "apostrophe": T.apostrophe_tokens(F.col("article")),
        "alnum": T.alnum_tokens(F.col("article")),
        "alpha": T.alpha_tokens(F.col("article")),
        "words": T.split_words(T.clean_text(F.col("article"))),
    }
    rows = S.passages(spark, folder).select("doc_id", *[c.alias(k) for k, c in kinds.items()])
    return rows.select(
        "doc_id",
        *[F.size(k).alias(f"n_{k}") for k in kinds],
        *[F.md5(F.array_join(k, " ")).alias(f"h_{k}") for k in kinds],
    )


@query(
    "bigrams",
    f"select row_id, unnest({s_bigrams(s_apos('question'))}) as bigram from v_mcq",
)
def bigrams(spark, folder):
    return usable(spark, folder).select(
        "row_id", F.explode(T.bigrams(T.apostrophe_tokens(F.col("question")))).alias("bigram")
    )


@query("option_key", f"select row_id, label, {s_key('option_text')} as option_key from v_options")
def option_key(spark, folder):
    return option_rows(spark, folder).select(
        "row_id", "label", T.option_key(F.col("option_text")).alias("option_key")
    )


@query(
    "token_phrase",
    f"""select row_id, label, {s_contains_key(s_key('article'), s_key('option_text'))} as in_article
        from v_options""",
)
def token_phrase(spark, folder):
    # the key of the long text is built once per question, before the explode
    keyed = usable(spark, folder).withColumn("article_key", T.option_key(F.col("article")))
    rows = R.explode_options(keyed, ["row_id", "article_key"])
    return rows.select(
        "row_id",
        "label",
        T.contains_key(F.col("article_key"), T.option_key(F.col("option_text"))).alias("in_article"),
    )


@query(
    "answer_leak",
    f"select row_id, label, {s_leak('option_text', 'correct_answer')} as leaks from v_options",
)
def answer_leak(spark, folder):
    return option_rows(spark, folder, "correct_answer").select(
        "row_id", "label", T.answer_leak(F.col("option_text"), F.col("correct_answer")).alias("leaks")
    )


@query(
    "usable_option",
    f"select row_id, label, {s_usable('option_text', 'correct_answer')} as usable from v_options",
)
def usable_option(spark, folder):
    return option_rows(spark, folder, "correct_answer").select(
        "row_id", "label", T.usable_option(F.col("option_text"), F.col("correct_answer")).alias("usable")
    )


@query(
    "normalise_candidate",
    f"select row_id, label, {s_norm_candidate('option_text')} as option_text from v_options",
)
def normalise_candidate(spark, folder):
    return option_rows(spark, folder).select(
        "row_id", "label", T.normalise_candidate(F.col("option_text")).alias("option_text")
    )


@query(
    "edit_distance",
    """select row_id, label, levenshtein(lower(correct_answer), lower(option_text)) as distance
       from v_options""",
)
def edit_distance(spark, folder):
    return option_rows(spark, folder, "correct_answer").select(
        "row_id", "label", F.levenshtein(F.lower("correct_answer"), F.lower("option_text")).alias("distance")
    )


@query(
    "lower_first",
    f"""select row_id, label, {s_lower_first('option_text')} as lowered,
        {s_clean_end('question')} as clean_question from v_options""",
)
def lower_first(spark, folder):
    return option_rows(spark, folder, "question").select(
        "row_id",
        "label",
        T.lower_first(F.col("option_text")).alias("lowered"),
        T.clean_end(F.col("question")).alias("clean_question"),
    )


@query(
    "overlap_ratio",
    f"""select row_id, round({s_ratio('q', 'a')}, 6) as unigram, round({s_ratio('qb', 'ab')}, 6) as bigram
        from (select row_id, q, a, {s_bigrams('q')} as qb, {s_bigrams('a')} as ab
              from (select row_id, {s_apos('question')} as q, {s_apos('article')} as a from v_mcq))""",
)
def overlap_ratio(spark, folder):
    return usable(spark, folder).select(
        "row_id",
        F.round(T.overlap_ratio(F.col("question"), F.col("article")), 6).alias("unigram"),
        F.round(T.bigram_overlap_ratio(F.col("question"), F.col("article")), 6).alias("bigram"),
    )


@query(
    "lexical_f1",
    f"select row_id, label, round({s_f1('question', 'option_text')}, 6) as f1 from v_options",
)
def lexical_f1(spark, folder):
    return option_rows(spark, folder, "question").select(
        "row_id", "label", F.round(T.lexical_f1(F.col("question"), F.col("option_text")), 6).alias("f1")
    )


@query(
    "lexical_cosine",
    f"""select row_id, label, round({s_lexical_cosine('correct_answer', 'option_text')}, 6) as cosine
        from v_options""",
)
def lexical_cosine(spark, folder):
    return option_rows(spark, folder, "correct_answer").select(
        "row_id",
        "label",
        F.round(T.lexical_cosine(F.col("correct_answer"), F.col("option_text")), 6).alias("cosine"),
    )


@query(
    "vector_cosine",
    """select vec_id, round(coalesce(
         list_dot_product(embedding::double[], list_reverse(embedding)::double[])
         / nullif(list_dot_product(embedding::double[], embedding::double[]), 0), 0), 6) as cosine
       from embeddings""",
)
def vector_cosine(spark, folder):
    return S.table(spark, folder, "embeddings").select(
        "vec_id", F.round(T.vector_cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("cosine")
    )


@query(
    "length_compatibility",
    f"""select row_id, label, round({s_length_compat('correct_answer', 'option_text')}, 6) as score
        from v_options""",
)
def length_compatibility(spark, folder):
    return option_rows(spark, folder, "correct_answer").select(
        "row_id",
        "label",
        F.round(T.length_compatibility(F.col("correct_answer"), F.col("option_text")), 6).alias("score"),
    )


@query(
    "category_compatibility",
    f"""select row_id, label, {s_compat('correct_category', 'category', False)} as strict_score,
          {s_compat('correct_category', 'category', True)} as relaxed_score
        from (select row_id, label, {s_option_category('correct_answer', "''")} as correct_category,
                {s_option_category('option_text', "''")} as category from v_options)""",
)
def category_compatibility(spark, folder):
    rows = option_rows(spark, folder, "correct_answer").select(
        "row_id",
        "label",
        C.option_category(F.col("correct_answer"), F.lit("")).alias("correct_category"),
        C.option_category(F.col("option_text"), F.lit("")).alias("category"),
    )
    pair = (F.col("correct_category"), F.col("category"))
    return rows.select(
        "row_id",
        "label",
        T.category_compatibility(*pair, relaxed=False).alias("strict_score"),
        T.category_compatibility(*pair, relaxed=True).alias("relaxed_score"),
    )


@query(
    "answer_position",
    f"""select row_id,
          round(case when spot = 0 then -1.0::double else (spot - 1)::double / greatest(length(sentence), 1) end, 6) as position,
          case when spot = 0 then 0 else len({s_apos('substr(sentence, 1, spot - 1)')}) end as words_before,
          case when spot = 0 then len({s_apos('sentence')})
            else len({s_apos('substr(sentence, spot + length(correct_answer))')}) end as words_after
        from (select *, strpos(lower(sentence), lower(correct_answer)) as spot from v_best)""",
)
def answer_position(spark, folder):
    from quizlake.operators.features import answer_position as place

    rows = with_best_sentence(spark, folder).where("sent_idx is not null")
    made = rows.select("row_id", place(F.col("sentence"), F.col("correct_answer")).alias("p"))
    return made.select(
        "row_id", F.round("p.position", 6).alias("position"), "p.words_before", "p.words_after"
    )


@query(
    "clip_round",
    """select row_id, label, round_even(greatest(-1.0::double, least(1.0::double,
         (length(correct_answer) - length(option_text)) / 8.0::double)), 4) as clipped from v_options""",
)
def clip_round(spark, folder):
    difference = (F.length("correct_answer") - F.length("option_text")) / F.lit(8.0)
    return option_rows(spark, folder, "correct_answer").select(
        "row_id",
        "label",
        F.bround(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), difference)), 4).alias("clipped"),
    )
