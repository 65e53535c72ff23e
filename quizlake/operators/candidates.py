"""Answer candidates of a passage.

Everything happens inside the passage row: sentences, matches, removal of
repeated texts and ranking are array expressions, so extraction needs no
shuffle, works the same in a stream, and a passage of any length costs
n log n in its number of matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions import text as T, values as V


def with_sentences(df: DataFrame, article: str = "article") -> DataFrame:
    return df.withColumn("sentences", T.sentences(F.col(article)))


def sentence_rows(df: DataFrame) -> DataFrame:
    return with_sentences(df).select(
        "doc_id", F.posexplode("sentences").alias("sent_idx", "sentence")
    )


# -- one extractor per kind: (sentence) -> array of normalised texts ------------


def _found(pattern: str, group: int) -> Callable[[Column], Column]:
    return lambda s: F.regexp_extract_all(s, F.lit(pattern), F.lit(group))


def _normalised(found: Column) -> Column:
    return F.filter(F.transform(found, T.normalise_candidate), lambda t: F.length(t) >= 3)


def _only_if(possible: Column, texts: Column) -> Column:
    """Skip a pattern when a cheap test shows that it cannot match."""
    return F.when(possible, texts).otherwise(F.array().cast("array<string>"))


def date_texts(s: Column) -> Column:
    return _only_if(s.rlike("[0-9]"), _normalised(_found(V.DATE_RE, 0)(s)))


def acronym_texts(s: Column) -> Column:
    return _normalised(_found(V.ACRONYM_RE, 0)(s))


def person_texts(s: Column) -> Column:
    return _only_if(F.contains(s, F.lit("'s")), _normalised(_found(V.POSSESSIVE_RE, 1)(s)))


def proper_noun_texts(s: Column) -> Column:
    def allowed(t: Column) -> Column:
        first = F.regexp_replace(F.lower(F.substring_index(t, " ", 1)), "'s$", "")
        return ~first.isin(V.STOP_STARTS) & ~F.contains(t, F.lit("'s "))

    return F.filter(_normalised(_found(V.PROPER_RE, 0)(s)), allowed)


def definition_texts(s: Column) -> Column:
    phrases = F.transform(
        _found(V.DEFINITION_RE, 1)(s), lambda p: F.regexp_replace(p, "^[ ,;]+|[ ,;]+$", "")
    )
    made = _normalised(F.filter(phrases, lambda p: F.size(T.split_words(p)) >= 2))
    trigger = T.let(
        F.lower(s),
        lambda low: F.contains(low, F.lit("known as"))
        | F.contains(low, F.lit("called"))
        | F.contains(low, F.lit("referred to as"))
        | F.contains(low, F.lit("named after")),
    )
    return _only_if(trigger, made)


def location_texts(s: Column) -> Column:
    def geographic(p: Column) -> Column:
        words = T.split_words(F.lower(p))
        return (F.length(p) > 3) & (
            (F.size(words) >= 2) | F.arrays_overlap(words, T.words_lit(V.GEO_WORDS))
        )

    return _normalised(F.filter(F.transform(_found(V.LOCATION_RE, 1)(s), T.strip), geographic))


def keyword_texts(s: Column) -> Column:
    return _found(V.KEYWORD_RE, 0)(s)


EXTRACTORS: dict[str, Callable[[Column], Column]] = {
    "date": date_texts,
    "acronym": acronym_texts,
    "person": person_texts,
    "properNoun": proper_noun_texts,
    "definition": definition_texts,
    "location": location_texts,
}


# -- scoring -----------------------------------------------------------------------


def _score(kind: str, t: Column, s: Column, i: Column | None) -> Column:
    base = F.lit(V.BASE_SCORE[kind])
    if kind == "keyword":  # always one word
        return base + F.lit(V.WORD_BONUS)
    if i is not None:
        base = base + F.greatest(F.lit(0.0), F.lit(1.0) - i * F.lit(V.SENTENCE_DECAY))
    # the text is normalised: one blank between words
    n_words = F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1
    score = base + F.least(n_words, F.lit(V.WORD_BONUS_LIMIT)) * F.lit(V.WORD_BONUS)
    if kind == "properNoun":
        named = F.contains(s, F.lit("named")) & F.rlike(
            s, F.concat(F.lit(r"\bnamed\s+"), t, F.lit(r"\b"))
        )
        score = F.when(named, score + F.lit(V.NAMED_BONUS)).otherwise(score)
        score = F.when(F.contains(t, F.lit("-")), score + F.lit(V.HYPHEN_BONUS)).otherwise(score)
    return score


def _entries(kind: str, texts: Column, s: Column, i: Column, use_position: bool) -> Column:
    return F.transform(
        texts,
        lambda t: F.struct(
            t.alias("text"),
            F.lit(kind).alias("kind"),
            _score(kind, t, s, i if use_position else None).alias("score"),
            i.alias("sent_idx"),
        ),
    )


def _emitted(sentences: Column) -> Column:
    return F.flatten(
        F.transform(
            sentences,
            lambda s, i: F.concat(
                *[_entries(kind, fn(s), s, i, True) for kind, fn in EXTRACTORS.items()]
            ),
        )
    )


def _keywords(sentences: Column) -> Column:
    return F.flatten(
        F.transform(sentences, lambda s, i: _entries("keyword", keyword_texts(s), s, i, False))
    )


def looks_like_person(text: Column, sentence: Column) -> Column:
    """Clue words count as substrings, so "making" holds "king"."""
    return F.lower(sentence).rlike("|".join(V.PERSON_CLUES)) | text.rlike(V.HYPHEN_NAME_RE)


def kind_rows(df: DataFrame, kind: str) -> DataFrame:
    """All emissions of one kind as rows, in emission order."""
    found = with_sentences(df).select(
        "doc_id",
        F.posexplode(
            F.flatten(
                F.transform(
                    "sentences", lambda s, i: _entries(kind, EXTRACTORS[kind](s), s, i, True)
                )
            )
        ).alias("pos", "c"),
    )
    return found.select("doc_id", "pos", "c.text", "c.score", "c.sent_idx")


def ranked_candidates(sentences: Column) -> Column:
    """The ranked candidate array of a passage.

    The first emission of a lower-cased text wins; sorting by (text, place) and
    keeping the first of each run avoids comparing every pair.  Intermediate
    arrays are bound with ``let``: were they columns, a filter on the result
    would make the optimizer put them inside the loops.
    """

    def build(ss: Column) -> Column:
        def choose(found: Column) -> Column:
            return F.when(F.size(found) > 0, found).otherwise(_keywords(ss))

        def keyed(found: Column) -> Column:
            return F.sort_array(
                F.transform(
                    found,
                    lambda e, p: F.struct(F.lower(e["text"]).alias("k"), p.alias("p"), e.alias("e")),
                )
            )

        def first_of_run(runs: Column) -> Column:
            return F.filter(
                runs, lambda x, j: (j == 0) | (F.get(runs, j - 1)["k"] != x["k"])
            )

        def final(x: Column) -> Column:
            e = x["e"]
            person = (e["kind"] == "properNoun") & looks_like_person(
                e["text"], F.get(ss, e["sent_idx"])
            )
            return F.struct(
                (-e["score"]).alias("order"),
                x["p"].alias("pos"),
                e["text"].alias("text"),
                F.when(person, "person").otherwise(e["kind"]).alias("kind"),
                e["score"].alias("score"),
                e["sent_idx"].alias("sent_idx"),
            )

        found = T.let(_emitted(ss), choose)
        return F.sort_array(F.transform(T.let(keyed(found), first_of_run), final))

    return T.let(sentences, build)


def with_candidates(df: DataFrame) -> DataFrame:
    """Add ``sentences`` and the ranked ``candidates`` array.

    The two are emitted by a generator: later filters then test the finished
    arrays, and the extraction is never copied into their conditions.
    """
    found = F.struct("sentences", ranked_candidates(F.col("sentences")).alias("candidates"))
    return with_sentences(df).select(*df.columns, F.inline(F.array(found)))


def candidate_rows(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``(doc_id, rank, text, kind, score, sent_idx, sentence)``, rank from 0."""
    ranked = df if "candidates" in df.columns else with_candidates(df)
    if limit is not None:
        ranked = ranked.withColumn("candidates", F.slice("candidates", 1, limit))
    # the sentence joins each entry before the explode; carrying the whole
    # sentence array beside every exploded row would be quadratic in a passage
    entries = T.let(
        F.col("sentences"),
        lambda ss: F.transform(
            "candidates",
            lambda c: F.struct(
                c["text"].alias("text"),
                c["kind"].alias("kind"),
                c["score"].alias("score"),
                c["sent_idx"].alias("sent_idx"),
                F.get(ss, c["sent_idx"]).alias("sentence"),
            ),
        ),
    )
    return ranked.select("doc_id", F.posexplode(entries).alias("rank", "c")).select(
        "doc_id", "rank", "c.*"
    )


# -- kinds and categories --------------------------------------------------------------


def infer_answer_kind(answer: Column, sentence: Column) -> Column:
    text = T.strip(answer)
    clue = r"(?i)\b(" + "|".join(V.PERSON_CLUES_FREE) + r")\b"
    return (
        F.when(text.rlike(V.FULL_DATE_RE), "date")
        .when(text.rlike(V.FULL_ACRONYM_RE), "acronym")
        .when(sentence.rlike(clue), "person")
        .when(text.rlike(V.FULL_PROPER_RE), "properNoun")
        .otherwise("keyword")
    )


def option_category(text: Column, question: Column) -> Column:
    bare = T.strip(text)
    low = F.lower(bare)
    start = F.regexp_extract(F.lower(question), "[a-z0-9]+", 0)
    cues = "|".join(c.replace(".", r"\.") for c in V.DEGREE_CUES)
    return (
        F.when(low.rlike(cues), "educationDegree")
        .when(low.rlike(V.FULL_DATE_LOWER_RE), "date")
        .when(low.rlike(V.FULL_NUMBER_RE), "number")
        .when(start == "when", "date")
        .when(start == "who", "person")
        .when(start == "where", "location")
        .when(bare.rlike(V.FULL_ACRONYM_RE), "acronym")
        .when(bare.rlike(V.FULL_PROPER_RE), "properNoun")
        .when(F.size(T.alnum_tokens(bare)) >= 6, "statement")
        .otherwise("term")
    )


def answer_category(text: Column, kind: Column, sentence: Column, question: Column) -> Column:
    def told(inferred: Column) -> Column:
        own = kind.isin("acronym", "definition", "properNoun") & (inferred == "term")
        return F.when(own, kind).otherwise(inferred)

    return (
        F.when(kind == "date", "date")
        .when((kind == "person") | looks_like_person(text, sentence), "person")
        .when(kind == "location", "location")
        .otherwise(T.let(option_category(text, question), told))
    )


# -- source sentences ---------------------------------------------------------------------


def best_sentence_index(sentences: Column, answer: Column) -> Column:
    """First sentence that holds the answer, else the first with the largest
    share of its tokens.  Null for a passage without sentences."""

    def scored(parts: Column) -> Column:
        return F.transform(
            sentences,
            lambda s, i: F.struct(
                F.when(
                    (answer != "") & F.contains(F.lower(s), F.lower(answer)), F.lit(-1)
                ).otherwise(F.lit(0)).alias("hit"),
                (
                    -F.when(
                        (answer != "") & F.contains(F.lower(s), F.lower(answer)), F.lit(0)
                    ).otherwise(F.size(F.array_intersect(parts, T.apostrophe_tokens(s))))
                ).alias("overlap"),
                i.alias("i"),
            ),
        )

    return F.array_min(
        T.let(F.array_distinct(T.apostrophe_tokens(answer)), scored)
    )["i"]


def match_sentence_index(sentences: Column, target: Column, tokens: Callable[[Column], Column]) -> Column:
    """Index of a sentence by equality, else the first with the best overlap."""

    def scored(parts: Column) -> Column:
        return F.transform(
            sentences,
            lambda s, i: F.struct(
                F.when(F.lower(s) == F.lower(T.strip(target)), F.lit(-1)).otherwise(F.lit(0)).alias("hit"),
                (-F.size(F.array_intersect(parts, tokens(s)))).alias("overlap"),
                i.alias("i"),
            ),
        )

    return F.coalesce(
        F.array_min(T.let(F.array_distinct(tokens(F.lower(target))), scored))["i"], F.lit(0)
    )


def add_gold_candidate(df: DataFrame) -> DataFrame:
    """Put ``correct_answer`` first unless its text is a candidate already."""
    answer = F.col("correct_answer")
    known = F.exists("candidates", lambda c: F.lower(c["text"]) == F.lower(answer))
    indexed = df.withColumn("_g", F.coalesce(best_sentence_index(F.col("sentences"), answer), F.lit(0)))
    sentence = F.coalesce(F.get("sentences", F.col("_g")), F.lit(""))
    gold = F.array(
        F.struct(
            F.lit(-V.GOLD_SCORE).alias("order"),
            F.lit(-1).alias("pos"),
            answer.alias("text"),
            infer_answer_kind(answer, sentence).alias("kind"),
            F.lit(V.GOLD_SCORE).alias("score"),
            F.col("_g").alias("sent_idx"),
        )
    )
    return indexed.withColumn(
        "candidates",
        F.when((answer == "") | known, F.col("candidates")).otherwise(
            F.concat(gold, F.col("candidates"))
        ),
    ).drop("_g")
