"""Selection of three wrong options per question.

Entries come from the same passage and from retrieval (at most ``k`` per
question).  They stand as arrays in the question row: filters, ranking and the
greedy pick read each other's results in order, and the row bounds their size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C, features as X, questions as Q

Scorer = Callable[[Column], Column]


def question_drafts(passages: DataFrame) -> DataFrame:
    """Per passage its best candidate as the answer, with question, source
    sentence and answer category: the input of option building."""
    rows = C.with_candidates(passages)
    best = F.get("candidates", F.lit(0))
    staged = rows.select(
        F.col("doc_id").alias("q_id"),
        "article",
        "sentences",
        "candidates",
        best.alias("correct"),
        F.get("sentences", best["sent_idx"]).alias("sentence"),
    ).where(F.size("candidates") > 0)
    answer, kind, sentence = F.col("correct.text"), F.col("correct.kind"), F.col("sentence")
    asked = staged.withColumn("question", Q.template_question(answer, kind, sentence))
    return asked.withColumn(
        "category", C.answer_category(answer, kind, sentence, F.col("question"))
    )


def retrieval_queries(drafts: DataFrame) -> DataFrame:
    from quizlake.operators.retrieval import search_categories

    return drafts.select(
        "q_id",
        T.clean_text(F.concat_ws(" ", "question", "correct.text", "sentence")).alias("query_text"),
        search_categories(F.col("category")).alias("categories"),
    )


def _found_entry(e: Callable[[str], Column]) -> Column:
    return F.struct(
        (-F.round(e("score"), 9)).alias("order"),
        e("option_key").alias("option_key"),
        e("text").alias("text"),
        F.round(e("score"), 9).alias("retrieval"),
        e("option_category").alias("category"),
    )


def collect_found(found: DataFrame) -> DataFrame:
    """Retrieved entries as one array per question; at most ``k`` each."""
    return found.groupBy("q_id").agg(F.sort_array(F.collect_list(_found_entry(F.col))).alias("found"))


def _joined(drafts: DataFrame, found: DataFrame) -> DataFrame:
    """``drafts`` with the array ``found``.  Of lists (``retrieval.search_lists``) only
    what entries need crosses the join."""
    if "found" not in found.columns:
        return drafts.join(collect_found(found), "q_id", "left")
    needed = lambda e: F.struct(*[e[c].alias(c) for c in ("option_key", "text", "option_category", "score")])
    lists = drafts.join(found.select("q_id", F.transform("found", needed).alias("found")), "q_id", "left")
    return lists.withColumn("found", F.sort_array(F.transform("found", lambda e: _found_entry(lambda c: e[c]))))


def _question(answer: Column, article: Column) -> Column:
    """What all entries of a question read of its answer and article."""
    return F.struct(
        *X.answer_parts(answer),
        T.option_key(answer).alias("answer_key"),
        T.log_length(F.size(T.alnum_tokens(answer))).alias("answer_size"),
        F.lower(article).alias("low"),
        F.concat(F.lit(" "), T.option_key(article), F.lit(" ")).alias("padded"),
    )


def _text_parts(e: Column) -> Column:
    """What is read more than once of an entry; its tokens stand in its key."""
    size = F.when(e["option_key"] == "", F.lit(0)).otherwise(F.size(F.split(e["option_key"], " ")))
    return F.struct(F.lower(e["text"]).alias("low"), size.alias("n_tokens"))


def _entry(e: Column, x: Column, asked: Column, source: str) -> list[Column]:
    return [
        e["text"].alias("text"),
        e["option_key"].alias("key"),
        F.lit(source).alias("source"),
        e["retrieval"].alias("retrieval"),
        e["category"].alias("category"),
        F.struct(*X.answered_features(asked, e["text"], x["low"], asked["low"])).alias("features"),
        T.lengths_compatibility(asked["answer_size"], T.log_length(x["n_tokens"])).alias("length_score"),
    ]


def with_entries(drafts: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``own`` (same passage) and ``pool`` (retrieved) entry arrays.  Drafts may
    come without ``sentences``, which are then cut from the article again.  The
    ``option_key`` of a found entry is the key of its text."""
    joined = _joined(drafts, found)
    if "sentences" not in drafts.columns:
        # emitted by a generator, so that the cutting is not copied into every use
        joined = joined.select(*joined.columns, F.inline(F.array(F.struct(T.sentences(F.col("article")).alias("sentences")))))
    answer = F.col("correct.text")
    asked = _question(answer, F.col("article"))
    own_texts = Q.compatible_entries(
        F.col("sentences"), F.col("candidates"), F.col("correct"), F.col("question"), None
    )
    own_entry = lambda t: F.struct(
        t.alias("text"),
        T.option_key(t).alias("option_key"),
        F.lit(1.0).alias("retrieval"),
        F.col("category").alias("category"),
    )
    own = T.let(
        asked,
        lambda a: F.transform(
            F.filter(own_texts, lambda t: T.usable_option(t, answer)),
            lambda t, i: T.let(
                own_entry(t),
                lambda e: T.let(_text_parts(e), lambda x: F.struct(i.alias("pos"), *_entry(e, x, a, "article"))),
            ),
        ),
    )
    pool = T.let(
        asked,
        lambda a: F.transform(
            F.coalesce("found", F.array().cast(joined.schema["found"].dataType)),
            lambda e, i: T.let(
                _text_parts(e),
                lambda x: F.struct(
                    i.alias("pos"),
                    *_entry(e, x, a, "corpus"),
                    T.usable_entry(e["text"], e["option_key"], x["n_tokens"], a["answer_key"]).alias("usable"),
                    T.contains_padded(a["padded"], e["option_key"]).alias("in_passage"),
                ),
            ),
        ),
    )
    # emitted by a generator too: readers of some of its fields do not each make it again
    kept = [c for c in joined.columns if c != "found"]
    return joined.select(*kept, F.inline(F.array(F.struct(pool.alias("pool"))))).withColumn("own", own)


def _rated(entries: Column, correct_category: Column, scorer: Scorer, more: Callable[[Column], list[Column]]) -> Column:
    """What the stages read of an entry, made once for all of them."""
    w = V.OPTION_WEIGHTS
    compat = lambda e, relaxed: T.category_compatibility(correct_category, e["category"], relaxed)
    return F.transform(
        entries,
        lambda e: F.struct(
            e["pos"].alias("pos"),
            e["text"].alias("text"),
            e["key"].alias("key"),
            (F.lit(w["retrieval"]) * e["retrieval"] + F.lit(w["model"]) * scorer(e)).alias("part"),
            compat(e, False).alias("same"),
            compat(e, True).alias("related"),
            (F.lit(w["length"]) * e["length_score"]).alias("length"),
            F.when(e["source"] == "article", F.lit(V.OWN_PASSAGE_BONUS)).otherwise(F.lit(0.0)).alias("bonus"),
            *more(e),
        ),
    )


def _ranked(rated: Column, kind: str, margin: Scorer) -> Column:
    """Entries by score; the best of them are judged by the verifier as well."""
    weight = F.lit(V.OPTION_WEIGHTS["type"])
    score = lambda e: F.round(e["part"] + weight * e[kind] + e["length"] + e["bonus"], 9)
    first = F.sort_array(
        F.transform(
            rated,
            lambda e: F.struct((-score(e)).alias("neg"), e["pos"].alias("pos"), e["text"].alias("text"), e["key"].alias("key")),
        )
    )
    judged = F.transform(
        first,
        lambda e, i: F.struct(
            F.when(i < V.VERIFIER_POOL, F.round(e["neg"] - F.lit(V.VERIFIER_WEIGHT) * margin(e["text"]), 9))
            .otherwise(e["neg"])
            .alias("neg"),
            i.alias("pos"),
            e["text"].alias("text"),
            e["key"].alias("key"),
        ),
    )
    return F.sort_array(judged)


def stage_lists(scorer: Scorer, margin: Scorer) -> Column:
    """All entries in the order in which they are tried, with their stage.

    Stages: own passage; retrieved of the same category; of related categories;
    any retrieved; retrieved even if in the passage; any candidate of the passage.
    """
    category = F.col("category")
    own = _rated(F.col("own"), category, scorer, lambda e: [])
    pool = _rated(
        F.col("pool"),
        category,
        scorer,
        lambda e: [
            e["retrieval"].alias("retrieval"),
            e["usable"].alias("usable"),
            (e["usable"] & ~e["in_passage"]).alias("free"),
        ],
    )
    return T.let(pool, lambda rated: _staged(own, rated, margin))


def _staged(own: Column, pool: Column, margin: Scorer) -> Column:
    answer = F.col("correct.text")
    stages = [
        (0, "strict", _ranked(own, "same", margin)),
        (1, "retrieved", _ranked(F.filter(pool, lambda e: e["free"] & (e["same"] >= 1.0)), "same", margin)),
        (2, "relaxed", _ranked(F.filter(pool, lambda e: e["free"] & (e["related"] > 0.0)), "related", margin)),
        (3, "last_resort", _ranked(F.filter(pool, lambda e: e["free"]), "related", margin)),
        (
            4,
            "last_resort",
            F.transform(
                F.filter(pool, lambda e: e["usable"]),
                lambda e: F.struct(
                    (-e["retrieval"]).alias("neg"), e["pos"].alias("pos"), e["text"].alias("text"), e["key"].alias("key")
                ),
            ),
        ),
        (
            5,
            "last_resort",
            F.transform(
                F.filter("candidates", lambda c: T.usable_option(c["text"], answer)),
                lambda c, i: F.struct(
                    (-F.round(c["score"], 9)).alias("neg"),
                    i.alias("pos"),
                    c["text"].alias("text"),
                    T.option_key(c["text"]).alias("key"),
                ),
            ),
        ),
    ]

    def tagged(number: int, quality: str, entries: Column) -> Column:
        return F.transform(
            entries,
            lambda e: F.struct(
                F.lit(number).alias("stage"),
                F.lit(quality).alias("quality"),
                (-e["neg"]).alias("score"),
                e["text"].alias("text"),
                e["key"].alias("key"),
            ),
        )

    return F.concat(*[tagged(*stage) for stage in stages])


def select_diverse(entries: Column, answer_key: Column, limit: int = 3) -> Column:
    """Greedy pick in the given order: skip empty and repeated keys, texts that
    hold the answer and texts too similar to one already picked."""

    def similar(a: Column, b: Column) -> Column:
        def check(p: Column) -> Column:
            least = F.least(F.size(p["a"]), F.size(p["b"]))
            return F.size(F.array_intersect(p["a"], p["b"])) > F.lit(V.SIMILAR_LIMIT) * least

        words = lambda k: F.array_distinct(F.split(k, " "))
        return T.let(F.struct(words(a).alias("a"), words(b).alias("b")), check)

    def step(acc: Column, e: Column) -> Column:
        clash = F.exists(acc, lambda s: (s["key"] == e["key"]) | similar(s["key"], e["key"]))
        skip = (
            (F.size(acc) >= limit)
            | (e["key"] == "")
            | (e["key"] == answer_key)
            | T.contains_key(e["key"], answer_key)
        )
        return F.when(skip, acc).when(clash, acc).otherwise(F.concat(acc, F.array(e)))

    return F.aggregate(entries, F.slice(entries, F.lit(1), F.lit(0)), step)


def fill_up(picked: Column, fallback: Column, answer: Column) -> Column:
    """Options of the quiz: the answer, the picked texts and, if these are
    fewer than three, further compatible texts of the passage."""
    texts = F.concat(F.array(answer), F.transform(picked, lambda e: e["text"]))
    return F.aggregate(
        fallback,
        texts,
        lambda acc, x: F.when(
            (F.size(acc) >= 4) | F.exists(acc, lambda y: T.option_key(y) == T.option_key(x)), acc
        ).otherwise(F.concat(acc, F.array(x))),
    )


def overall_quality(picked: Column) -> Column:
    """Worst stage among the picked; last resort when nothing was picked."""
    worst = F.array_max(
        F.transform(picked, lambda e: F.array_position(T.words_lit(V.STAGES), e["quality"]))
    )
    return F.coalesce(F.get(T.words_lit(V.STAGES), (worst - 1).cast("int")), F.lit("last_resort"))


def option_ladder(rows: DataFrame, scorer: Scorer, margin: Scorer, fallback: Column | None = None) -> DataFrame:
    """Add ``picked``, ``options``, ``option_quality``, ``stage_counts`` and
    ``n_considered``.  ``fallback`` holds further texts of the passage where
    its sentences are not at hand."""
    answer = F.col("correct.text")
    tried = rows.withColumn("tried", stage_lists(scorer, margin))
    picked = tried.withColumn("picked", select_diverse(F.col("tried"), T.option_key(answer)))
    if fallback is None:
        fallback = Q.compatible_entries(F.col("sentences"), F.col("candidates"), F.col("correct"), F.lit(""), 3)
    counted = lambda stage: F.size(F.filter("picked", lambda e: e["quality"] == stage))
    counts = F.map_from_arrays(T.words_lit(V.STAGES), F.array(*[counted(s) for s in V.STAGES]))
    return (
        picked.withColumn("options", fill_up(F.col("picked"), fallback, answer))
        .withColumn("option_quality", overall_quality(F.col("picked")))
        .withColumn("stage_counts", counts)
        .withColumn("n_considered", F.size("tried"))
        .drop("tried")
    )


# -- fixed scores, for checks and for use without trained models --------------------------------


def fixed_scorer(e: Column) -> Column:
    """A fixed logistic score of the four distractor features."""
    f = e["features"]
    z = (
        F.lit(0.05) * f["edit_distance"]
        - F.lit(0.02) * f["length_difference"]
        + F.lit(0.5) * f["in_article"]
        + f["lexical_cosine"]
    )
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9)


def fixed_probability(text: Column) -> Column:
    return F.round(F.least(F.length(text) / F.lit(40.0), F.lit(1.0)), 9)


def margin_against(answer: Column, probability: Scorer) -> Scorer:
    return lambda text: F.greatest(
        F.lit(-1.0), F.least(F.lit(1.0), probability(answer) - probability(text))
    )


# -- ranking of questions and choice of the quiz ------------------------------------------------


def question_bias(template: Column) -> Column:
    out = None
    for name, factor in V.TEMPLATE_BIAS.items():
        out = F.when(template == name, F.lit(factor)) if out is None else out.when(template == name, F.lit(factor))
    return out.otherwise(F.lit(1.0))


def bundle_order(quality: Column, matches: Column, question_score: Column, rank: Column) -> Column:
    """Sort key of the bundles of a passage: acceptable ones by rank first, then
    the others by their bundle score."""
    accept = quality.isin("strict", "retrieved") & matches
    base = None
    for name, value in V.QUALITY_SCORE.items():
        base = F.when(quality == name, F.lit(value)) if base is None else base.when(quality == name, F.lit(value))
    score = (
        base.otherwise(F.lit(0.5))
        + F.when(matches, F.lit(V.VERIFIER_BONUS)).otherwise(F.lit(0.0))
        + F.least(question_score, F.lit(1.0)) * F.lit(V.QUESTION_SCORE_SHARE)
    )
    return F.struct(
        (~accept).cast("int").alias("not_accepted"),
        F.when(accept, rank.cast("double")).otherwise(-F.round(score, 9)).alias("key"),
        rank.alias("rank"),
    )
