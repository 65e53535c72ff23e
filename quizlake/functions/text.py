"""Scalar and array expressions on text, all built from Spark SQL functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from quizlake.functions import values as V


def words_lit(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- cleaning ---------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def clean_text(c: Column) -> Column:
    return F.translate(F.lower(F.coalesce(c, F.lit(""))), V.PUNCTUATION, "")


def clean_end(c: Column) -> Column:
    return F.regexp_replace(collapse(c), r"^[ ,.;:]+|[ ,.;:]+$", "")


def strip_marks(c: Column) -> Column:
    return F.regexp_replace(c, r"^[ ,]+|[ ,]+$", "")


def normalise_candidate(c: Column) -> Column:
    bare = F.regexp_replace(strip(collapse(c)), r"^[ ,.;:()\[\]]+|[ ,.;:()\[\]]+$", "")
    return strip(F.regexp_replace(bare, r"(?i)^(the|a|an)\s+", ""))


def normalise_question(c: Column) -> Column:
    return let(
        F.regexp_replace(clean_end(c), r"\?+", "?"),
        lambda q: F.when(F.endswith(q, F.lit("?")), q).otherwise(F.concat(q, F.lit("?"))),
    )


def lower_first(c: Column) -> Column:
    return let(
        c,
        lambda t: F.when(t.rlike(r"^\p{Lu}[^\p{Ll}]"), t).otherwise(
            F.concat(F.lower(F.substring(t, 1, 1)), F.substr(t, F.lit(2)))
        ),
    )


# -- tokens -------------------------------------------------------------------


def split_words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def alnum_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9]+"), F.lit(0))


def apostrophe_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9']+"), F.lit(0))


def alpha_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z']+"), F.lit(0))


def term_tokens(c: Column) -> Column:
    """Words of two or more word characters, the unit of all TF-IDF weights."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\b\w\w+\b"), F.lit(0))


def bigrams(tokens: Column) -> Column:
    return _pairs(tokens, lambda a, b: F.concat(a, F.lit(" "), b))


def padded_bigrams(tokens: Column) -> Column:
    """Bigrams with a blank on both sides, to be searched in a padded text."""
    blank = F.lit(" ")
    return _pairs(tokens, lambda a, b: F.concat(blank, a, blank, b, blank))


def _pairs(tokens: Column, joined: Callable[[Column, Column], Column]) -> Column:
    # the last token has no partner: its pair is null
    made = lambda tk: F.transform(tk, lambda a, i: joined(a, F.get(tk, i + 1)))
    return F.array_distinct(F.filter(let(tokens, made), lambda p: p.isNotNull()))


def option_key(c: Column) -> Column:
    return F.array_join(alnum_tokens(c), " ")


def sentences(c: Column) -> Column:
    parts = F.split(strip(F.coalesce(c, F.lit(""))), r"(?<=[.!?])\s+")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


# -- comparisons ----------------------------------------------------------------


def contains_key(container_key: Column, phrase_key: Column) -> Column:
    """Token phrase containment on two option keys."""
    return contains_padded(F.concat(F.lit(" "), container_key, F.lit(" ")), phrase_key)


def contains_padded(padded: Column, phrase_key: Column) -> Column:
    """``contains_key`` where the container stands between blanks already."""
    return (phrase_key != "") & F.contains(padded, F.concat(F.lit(" "), phrase_key, F.lit(" ")))


def contains_phrase(container: Column, phrase: Column) -> Column:
    return contains_key(option_key(container), option_key(phrase))


def answer_leak(option: Column, answer: Column) -> Column:
    return contains_phrase(option, answer)


def usable_option(option: Column, answer: Column | None = None) -> Column:
    def checks(text: Column) -> Column:
        tokens = alnum_tokens(text)
        key = F.array_join(tokens, " ")
        ok = _usable_key(key, F.size(tokens)) & (F.length(text) <= V.OPTION_CHARS)
        if answer is not None:
            ok = ok & ((F.coalesce(answer, F.lit("")) == "") | ~contains_key(key, option_key(answer)))
        return ok

    return let(strip(collapse(F.coalesce(option, F.lit("")))), checks)


def _usable_key(key: Column, n_tokens: Column) -> Column:
    return (key != "") & ~key.isin(V.NULL_WORDS) & (n_tokens <= 32)


def usable_entry(option: Column, key: Column, n_tokens: Column, answer_key: Column) -> Column:
    """``usable_option`` of a text whose key and number of tokens are at hand.  Whitespace
    is collapsed only where the text is too long as it stands."""
    short = (F.length(option) <= V.OPTION_CHARS) | (F.length(strip(collapse(option))) <= V.OPTION_CHARS)
    return _usable_key(key, n_tokens) & short & ~contains_key(key, F.coalesce(answer_key, F.lit("")))


def ratio_of_left(left: Column, right: Column) -> Column:
    """Share of the distinct left tokens that are found on the right."""
    return share_of(F.array_distinct(left), right)


def share_of(distinct: Column, right: Column) -> Column:
    return let(
        distinct,
        lambda lt: F.when(
            F.size(lt) > 0, F.size(F.array_intersect(lt, right)) / F.size(lt)
        ).otherwise(F.lit(0.0)),
    )


def overlap_ratio(left: Column, right: Column) -> Column:
    return ratio_of_left(apostrophe_tokens(left), apostrophe_tokens(right))


def bigram_overlap_ratio(left: Column, right: Column) -> Column:
    return share_of(bigrams(apostrophe_tokens(left)), bigrams(apostrophe_tokens(right)))


def lexical_f1(left: Column, right: Column) -> Column:
    return tokens_f1(F.array_distinct(apostrophe_tokens(left)), F.array_distinct(apostrophe_tokens(right)))


def tokens_f1(lt: Column, rt: Column) -> Column:
    """``lexical_f1`` of two sets of tokens."""
    shared = F.size(F.array_intersect(lt, rt))
    total = F.size(lt) + F.size(rt)
    return F.when(total > 0, F.lit(2.0) * shared / total).otherwise(F.lit(0.0))


def lexical_cosine(left: Column, right: Column) -> Column:
    return words_cosine(cosine_words(left), cosine_words(right))


def cosine_words(c: Column) -> Column:
    return F.array_distinct(split_words(clean_text(c)))


def words_cosine(lt: Column, rt: Column) -> Column:
    """``lexical_cosine`` of two sets of words."""
    sizes = F.size(lt) * F.size(rt)
    return F.when(
        sizes > 0, F.size(F.array_intersect(lt, rt)) / F.sqrt(sizes.cast("double"))
    ).otherwise(F.lit(0.0))


def vector_dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def vector_cosine(a: Column, b: Column) -> Column:
    norms = F.sqrt(vector_dot(a, a)) * F.sqrt(vector_dot(b, b))
    return F.when(norms > 0, vector_dot(a, b) / norms).otherwise(F.lit(0.0))


def length_compatibility(answer: Column, option: Column) -> Column:
    return lengths_compatibility(log_length(F.size(alnum_tokens(answer))), log_length(F.size(alnum_tokens(option))))


def log_length(n_tokens: Column) -> Column:
    return F.log1p(F.greatest(n_tokens, F.lit(1)))


def lengths_compatibility(a: Column, b: Column) -> Column:
    """``length_compatibility`` of two ``log_length``."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(a - b) / 2.4)


def category_compatibility(correct: Column, other: Column, relaxed: bool) -> Column:
    score = F.when(correct == other, F.lit(1.0))
    if relaxed:
        for a, b, s in V.RELAXED_PAIRS:
            score = score.when((correct == a) & (other == b), F.lit(s))
    return score.otherwise(F.lit(0.0))


# -- question checks --------------------------------------------------------------


def wh_type(question: Column) -> Column:
    first = F.regexp_extract(F.lower(question), r"[a-z0-9']+", 0)  # the first token alone
    return F.when(first.isin(V.WH_WORDS), first).otherwise(F.lit(""))


def verb_like(tokens: Column) -> Column:
    return F.exists(
        tokens,
        lambda t: t.isin(V.VERBS) | ((F.length(t) > 4) & t.rlike("(ed|ing|es)$")),
    )


def _tail(tokens: Column) -> Column:
    return F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(1)))


def bad_question(question: Column, tokens: Column | None = None) -> Column:
    """``tokens``: ``apostrophe_tokens(question)``, given where they are at hand."""

    def checks(tokens: Column) -> Column:
        return (
            (F.size(tokens) < 5)
            | F.coalesce(F.get(tokens, F.lit(1)).isin(V.RANKER_SECOND), F.lit(False))
            | F.coalesce(F.try_element_at(tokens, F.lit(-1)).isin(V.RANKER_LAST), F.lit(False))
            | question.rlike(V.WH_PREPOSITION_RE)
        )

    return let(apostrophe_tokens(question), checks) if tokens is None else checks(tokens)


def readable_question(question: Column) -> Column:
    def gate(tidy: Column) -> Column:
        def checks(words: Column) -> Column:
            return (
                (F.size(words) >= 5)
                & ~F.coalesce(F.get(words, F.lit(1)).isin(V.GATE_SECOND), F.lit(False))
                & ~F.coalesce(F.try_element_at(words, F.lit(-1)).isin(V.GATE_LAST), F.lit(False))
                & verb_like(_tail(words))
                & ~tidy.rlike(V.WH_PREPOSITION_RE)
            )

        return let(alpha_tokens(tidy), checks)

    return let(F.concat(clean_end(F.regexp_replace(question, r"\?+$", "")), F.lit("?")), gate)


def answer_at(text: Column, answer: Column) -> Column:
    """One-based place of the answer in the text, case-insensitive; 0 if absent."""
    return F.call_function("instr", F.lower(text), F.lower(answer))


def mask_all(text: Column, answer: Column, blank: str) -> Column:
    quoted = F.replace(answer, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    pattern = F.concat(F.lit(r"(?i)\Q"), quoted, F.lit(r"\E"))
    return F.when(answer == "", text).otherwise(F.regexp_replace(text, pattern, F.lit(blank)))


def mask_first(text: Column, answer: Column, blank: str) -> Column:
    def masked(t: Column) -> Column:
        return let(
            answer_at(t, answer),
            lambda at: F.when(
                (at > 0) & (answer != ""),
                F.concat(
                    F.substr(t, F.lit(1), at - 1), F.lit(blank), F.substr(t, at + F.length(answer))
                ),
            ).otherwise(t),
        )

    return let(text, masked)
