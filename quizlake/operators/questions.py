"""Template questions and hints, as columns over one candidate at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions import text as T, values as V
from quizlake.operators import candidates as C


def _nothing() -> Column:
    return F.lit(None).cast("string")


def _wh_for_kind(kind: Column) -> Column:
    return F.when(kind == "date", "When").when(kind == "person", "Who").otherwise("What")


def text_after(tidy: Column, answer: Column) -> Column:
    """What follows the answer in a tidied sentence; null if it is absent."""
    return T.let(
        T.answer_at(tidy, answer),
        lambda at: F.when(at > 0, T.strip_marks(F.substr(tidy, at + F.length(answer)))),
    )


def text_before(tidy: Column, answer: Column) -> Column:
    return T.let(
        T.answer_at(tidy, answer),
        lambda at: F.when(at > 0, T.strip_marks(F.substr(tidy, F.lit(1), at - 1))),
    )


def cloze_question(answer: Column, sentence: Column, tidy: Column | None = None) -> Column:
    """``tidy``: ``T.clean_end(sentence)``, given where templates share it."""
    masked = T.mask_first(T.clean_end(sentence) if tidy is None else tidy, answer, V.BLANK)
    return T.normalise_question(F.concat(F.lit(V.CLOZE_PREFIX), masked))


def suffix_question(answer: Column, kind: Column, sentence: Column, tidy: Column | None = None) -> Column:
    def build(after: Column) -> Column:
        words = F.regexp_extract_all(after, F.lit("[A-Za-z']+"), F.lit(0))

        def checked(w: Column) -> Column:
            first = F.get(w, F.lit(0))
            fits = (
                (F.size(w) >= 3)
                & ~first.rlike(r"^\p{Lu}")
                & ~F.lower(first).isin(V.SUFFIX_STOP_STARTS)
            )
            raw = F.concat(_wh_for_kind(kind), F.lit(" "), T.lower_first(T.clean_end(after)))
            return F.when(fits, T.normalise_question(raw))

        return T.let(words, checked)

    if tidy is None:
        return T.let(T.let(T.clean_end(sentence), lambda t: text_after(t, answer)), build)
    return T.let(text_after(tidy, answer), build)


def subject_question(answer: Column, kind: Column, sentence: Column) -> Column:
    """Wh question from the words after the answer if it reads well, else cloze."""

    def build(tidy: Column) -> Column:
        cloze = F.concat(F.lit(V.CLOZE_PREFIX), T.mask_first(tidy, answer, V.BLANK), F.lit("?"))

        def from_suffix(after: Column) -> Column:
            person = (kind == "person") | C.looks_like_person(answer, sentence)
            asked = F.concat(
                F.when(person, "Who ").otherwise("What "), T.lower_first(T.clean_end(after)), F.lit("?")
            )
            return T.let(
                asked,
                lambda q: F.when((after != "") & T.readable_question(q), q).otherwise(cloze),
            )

        return F.coalesce(T.let(text_after(tidy, answer), from_suffix), cloze)

    return T.let(T.clean_end(sentence), build)


def template_question(answer: Column, kind: Column, sentence: Column) -> Column:
    return F.when(kind == "date", V.GENERIC_QUESTIONS["date"]).otherwise(
        subject_question(answer, kind, sentence)
    )


def generic_question(kind: Column) -> Column:
    return (
        F.when(kind == "date", V.GENERIC_QUESTIONS["date"])
        .when(kind == "person", V.GENERIC_QUESTIONS["person"])
        .otherwise(V.GENERIC_QUESTIONS["other"])
    )


def article_referent(article: Column) -> Column:
    """First proper noun of four letters or more, empty if there is none."""
    return F.regexp_extract(F.coalesce(article, F.lit("")), V.REFERENT_RE, 0)


def definition_question(sentence: Column, referent: Column) -> Column:
    adverbs = r"(?i)^((" + "|".join(V.LONE_ADVERBS) + ")( |$))+"

    def for_trigger(tidy: Column, trigger: str) -> Column:
        at = F.call_function("instr", F.lower(tidy), F.lit(trigger))

        def ask(subject: Column) -> Column:
            own = F.regexp_extract(tidy, V.REFERENT_RE, 0)
            vague = (subject == "") | F.lower(subject).isin(V.BARE_PRONOUNS)
            named = F.when(~vague, subject).when(own != "", own).when(referent != "", referent)
            return T.let(
                named,
                lambda n: F.when(
                    n.isNotNull(),
                    T.normalise_question(
                        F.concat(F.lit("What is "), T.lower_first(n), F.lit(f" {trigger}?"))
                    ),
                ),
            )

        before = T.strip_marks(F.substr(tidy, F.lit(1), at - 1))
        before = F.regexp_replace(before, r"(?i)^(" + V.COPULA_STARTS + r")\s+", "")
        return F.when(at > 0, T.let(T.strip(F.regexp_replace(T.strip(before), adverbs, "")), ask))

    return T.let(
        T.clean_end(sentence),
        lambda tidy: F.coalesce(*[for_trigger(tidy, t) for t in V.DEFINITION_TRIGGERS]),
    )


def where_question(answer: Column, sentence: Column) -> Column:
    def invert(place: Column) -> Column:
        out = None
        for aux in V.AUXILIARIES:
            pattern = rf"(?i)^(.*?)\s+({aux})\s+(.*)"
            asked = F.concat(
                F.lit("Where "),
                F.regexp_extract(place, pattern, 2),
                F.lit(" "),
                T.lower_first(F.regexp_extract(place, pattern, 1)),
                F.lit(" "),
                F.regexp_extract(place, pattern, 3),
            )
            hit = place.rlike(pattern)
            out = F.when(hit, asked) if out is None else out.when(hit, asked)
        plain = F.concat(F.lit("Where "), T.lower_first(place))
        return F.when(place != "", T.normalise_question(out.otherwise(plain)))

    def build(before: Column) -> Column:
        bare = F.regexp_replace(before, r"(?i)\s+(?:in|at|near|from|within)\s*$", "")
        return F.when(F.size(T.split_words(before)) >= 3, T.let(T.strip(bare), invert))

    return T.let(T.let(T.clean_end(sentence), lambda tidy: text_before(tidy, answer)), build)


def _templates(c: Column, referent: Column) -> Column:
    """Questions of one candidate in template order, repeats removed."""
    answer, kind, sentence = c["text"], c["kind"], c["sentence"]
    made = F.array(
        F.struct(
            F.lit("definition").alias("template"),
            F.when(kind == "definition", definition_question(sentence, referent)).alias("question"),
        ),
        F.struct(
            F.lit("where_wh").alias("template"),
            F.when(kind == "location", where_question(answer, sentence)).alias("question"),
        ),
        F.struct(
            F.lit("suffix_wh").alias("template"),
            suffix_question(answer, kind, sentence, c["tidy"]).alias("question"),
        ),
        F.struct(
            F.lit("generic_wh").alias("template"),
            generic_question(kind).alias("question"),
        ),
        F.struct(
            F.lit("cloze").alias("template"), cloze_question(answer, sentence, c["tidy"]).alias("question")
        ),
    )

    def distinct(found: Column) -> Column:
        keys = F.transform(found, lambda x: F.lower(x["question"]))
        first = lambda ks: F.filter(
            found, lambda x, i: x["question"].isNotNull() & (F.array_position(ks, F.get(ks, i)) == i + 1)
        )
        return T.let(keys, first)

    return T.let(made, distinct)


def question_rows(df: DataFrame, limit: int = 8, with_overlap: bool = False) -> DataFrame:
    """Questions of the first ``limit`` candidates of each row of
    ``(doc_id, article, sentences, candidates)``.
    ``with_overlap`` adds what the ranker wants to know of the whole article;
    ``gold_question``, ``gold``, ``correct_answer`` and ``others`` are carried along.

    All are made inside the passage row, so their order is their place in one
    array and no shuffle is needed to number them or to drop repeats: answers
    differ within a passage, so equal questions can only meet within one answer.
    """

    def overlap(question: Column, pad: Column) -> Column:
        def share(words: Column) -> Column:
            held = F.filter(words, lambda w: F.contains(pad, F.concat(F.lit(" "), w, F.lit(" "))))
            return F.when(F.size(words) > 0, F.size(held) / F.size(words)).otherwise(F.lit(0.0))

        return T.let(F.array_distinct(T.apostrophe_tokens(question)), share)

    def per_candidate(ss: Column, pad: Column | None) -> Column:
        extra = lambda q: (
            [F.size(ss).alias("n_sentences"), overlap(q, pad).alias("article_overlap")]
            if pad is not None
            else []
        )
        return F.flatten(
            F.transform(
                F.slice("candidates", 1, limit),
                lambda c, r: T.let(
                    F.struct(
                        c["text"].alias("text"),
                        c["kind"].alias("kind"),
                        c["score"].alias("score"),
                        c["sent_idx"].alias("sent_idx"),
                        F.coalesce(F.get(ss, c["sent_idx"]), F.lit("")).alias("sentence"),
                        T.clean_end(F.coalesce(F.get(ss, c["sent_idx"]), F.lit(""))).alias("tidy"),
                    ),
                    lambda e: F.transform(
                        _templates(e, F.col("referent")),
                        lambda t: F.struct(
                            r.alias("answer_rank"),
                            e["text"].alias("answer_text"),
                            e["kind"].alias("answer_kind"),
                            (e["score"] - r * F.lit(V.ANSWER_RANK_COST)).alias("answer_score"),
                            e["sentence"].alias("sentence"),
                            e["sent_idx"].alias("sent_idx"),
                            t["template"].alias("template"),
                            t["question"].alias("question"),
                            T.wh_type(t["question"]).alias("wh_word"),
                            *extra(t["question"]),
                        ),
                    ),
                ),
            )
        )

    if with_overlap:
        words = F.array_join(T.apostrophe_tokens(F.col("article")), " ")
        pad = F.concat(F.lit(" "), words, F.lit(" "))
        made = T.let(F.col("sentences"), lambda ss: T.let(pad, lambda p: per_candidate(ss, p)))
    else:
        made = T.let(F.col("sentences"), lambda ss: per_candidate(ss, None))
    carried = [c for c in ("gold_question", "gold", "correct_answer", "others") if c in df.columns]
    return (
        df.withColumn("referent", article_referent(F.col("article")))
        .select("doc_id", *carried, F.posexplode(made).alias("candidate_index", "q"))
        .select("doc_id", "candidate_index", *carried, "q.*")
    )


# -- hints ---------------------------------------------------------------------------


def openings(sentences: Column) -> Column:
    """Sentences long enough to open a hint, lower-cased and with clean ends."""
    both = F.transform(
        sentences, lambda s: F.struct(F.lower(s).alias("low"), T.clean_end(s).alias("tidy"))
    )
    return F.filter(both, lambda x: F.length(x["tidy"]) >= 20)


def hints(sentences: Column, answer: Column, sent_idx: Column, opening: Column | None = None) -> Column:
    """Three hints from general to specific: an opening sentence without the
    answer, the sentence before the answer's, the answer's sentence masked.
    ``opening``: ``openings(sentences)``, given where many answers share them."""

    def build(ss: Column) -> Column:
        n = F.size(ss)
        at = lambda i: T.clean_end(F.get(ss, i))
        third = T.clean_end(T.mask_all(F.get(ss, sent_idx), answer, V.HINT_BLANK))
        open_ones = T.let(
            F.lower(answer),
            lambda low: F.filter(
                openings(ss) if opening is None else opening,
                lambda x: (answer == "") | ~F.contains(x["low"], low),
            ),
        )
        first = F.coalesce(
            F.get(open_ones, F.lit(0))["tidy"], T.mask_all(at(F.lit(0)), answer, V.HINT_BLANK)
        )

        def with_second(h: Column) -> Column:
            second = (
                F.when(sent_idx > 1, at(sent_idx - 1))
                .when(sent_idx == 1, h["first"])
                .when(n > 1, at(F.lit(1)))
                .otherwise(h["third"])
            )
            moved = T.let(
                second,
                lambda s: F.when(
                    (F.lower(s) == F.lower(h["first"])) & (n > sent_idx + 1),
                    at(F.least(sent_idx + 1, n - 1)),
                ).otherwise(s),
            )
            return F.array(h["first"], moved, h["third"])

        return T.let(F.struct(first.alias("first"), third.alias("third")), with_second)

    return T.let(sentences, build)


# -- options from the same passage -----------------------------------------------------


def shuffled(options: Column, seed: Column) -> Column:
    """Options in hash order of seed and text; the same on every engine."""
    return F.transform(
        F.sort_array(
            F.transform(
                options,
                lambda o: F.struct(F.md5(F.concat(seed, F.lit("::"), o)).alias("h"), o.alias("o")),
            )
        ),
        lambda x: x["o"],
    )


def label_of(options: Column, answer: Column) -> Column:
    spot = F.array_position(F.transform(options, F.lower), F.lower(answer))
    return F.when(spot > 0, F.substr(F.lit("ABCD"), spot.cast("int"), F.lit(1)))


def compatible_entries(
    sentences: Column, candidates: Column, correct: Column, question: Column, limit: int | None
) -> Column:
    """Texts of candidates of the answer's category that neither equal nor hold
    it, in candidate order, repeats by key removed.  ``limit`` stops early."""

    def build(ss: Column) -> Column:
        def category(c: Column) -> Column:
            return C.answer_category(c["text"], c["kind"], F.coalesce(F.get(ss, c["sent_idx"]), F.lit("")), question)

        def fits(c: Column, want: Column) -> Column:
            other = T.let(
                T.option_key(c["text"]), lambda k: ~T.contains_key(k, want["key"]) & (k != want["key"])
            )
            return other & (category(c) == want["category"])

        def picked(want: Column) -> Column:
            if limit is None:
                return F.transform(F.filter(candidates, lambda c: fits(c, want)), lambda c: c["text"])
            # once the answer has its texts, no further candidate is judged
            return F.aggregate(
                candidates,
                F.array().cast("array<string>"),
                lambda acc, c: F.when(
                    F.size(acc) < limit,
                    F.when(
                        fits(c, want)
                        & ~F.coalesce(
                            F.exists(acc, lambda y: T.option_key(y) == T.option_key(c["text"])), F.lit(False)
                        ),
                        F.concat(acc, F.array(c["text"])),
                    ).otherwise(acc),
                ).otherwise(acc),
            )

        want = F.struct(T.option_key(correct["text"]).alias("key"), category(correct).alias("category"))
        return T.let(want, picked)

    return T.let(sentences, build)


def answer_options(sentences: Column, candidates: Column, correct: Column) -> Column:
    """The answer and up to three compatible texts of the same passage."""
    return F.concat(
        F.array(correct["text"]),
        compatible_entries(sentences, candidates, correct, F.lit(""), 3),
    )


def choose_candidate(candidates: Column, given: Column | None) -> Column:
    """The best candidate, or the one that equals a given answer, or the given
    answer itself standing in the best candidate's sentence."""
    best = F.get(candidates, F.lit(0))
    if given is None:
        return best
    same = F.get(F.filter(candidates, lambda c: F.lower(c["text"]) == F.lower(given)), F.lit(0))
    manual = F.struct(
        F.lit(-V.MANUAL_SCORE).alias("order"),
        F.lit(-1).alias("pos"),
        given.alias("text"),
        F.lit("manual").alias("kind"),
        F.lit(V.MANUAL_SCORE).alias("score"),
        best["sent_idx"].alias("sent_idx"),
    )
    return F.when(given.isNull(), best).otherwise(F.coalesce(same, F.when(best.isNotNull(), manual)))
