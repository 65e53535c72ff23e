"""Feature columns of the three models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quizlake.functions import text as T, values as V
from quizlake.operators import corpus

# -- answer verifier -----------------------------------------------------------------


def padded(clean: Column) -> Column:
    """Words between single blanks, so that a word or a run of words is found
    by a plain substring search and no token set of the article is built."""
    return F.concat(F.lit(" "), T.strip(T.collapse(clean)), F.lit(" "))


def _held(words: Column, pad: Column) -> Column:
    return F.filter(words, lambda w: F.contains(pad, F.concat(F.lit(" "), w, F.lit(" "))))


def _share(words: Column, pad: Column) -> Column:
    return T.let(
        words,
        lambda w: F.when(F.size(w) > 0, F.size(_held(w, pad)) / F.size(w)).otherwise(F.lit(0.0)),
    )


def looks_numeric(option: Column) -> Column:
    bare = T.strip(F.coalesce(option, F.lit("")))
    return (bare.rlike(V.FULL_NUMBER_RE) | bare.rlike(V.DATE_WORD_RE)).cast("double")


def _option_features(article: Column, question: Column, option: Column) -> Column:
    """Everything of one option that needs no corpus statistics."""

    def build(o: Column) -> Column:
        words = o["distinct"]
        query = F.array_distinct(F.concat(question["words"], o["words"]))
        pairs = F.array_distinct(F.concat(question["pairs"], T.bigrams(o["words"])))
        spot = F.call_function("instr", article["clean"], o["clean"])
        best = F.array_max(F.transform(article["sentence_pads"], lambda p: F.size(_held(words, p))))
        return F.struct(
            _share(query, article["pad"]).alias("unigram_overlap_ratio"),
            F.size(_held(words, article["pad"])).alias("n_shared"),
            F.when(F.size(words) > 0, F.coalesce(best, F.lit(0)) / F.size(words))
            .otherwise(F.lit(0.0))
            .alias("best_sentence_overlap"),
            _share(words, article["pad"]).alias("article_overlap"),
            _share(pairs, article["pad"]).alias("bigram_overlap_ratio"),
            ((o["clean"] != "") & (spot > 0)).cast("double").alias("exact_match_flag"),
            F.size(o["words"]).cast("double").alias("option_token_length"),
            F.length(o["clean"]).cast("double").alias("option_char_length"),
            F.when((spot == 0) | (F.length(article["clean"]) == 0), F.lit(-1.0))
            .otherwise((spot - 1) / F.length(article["clean"]))
            .alias("first_position"),
            looks_numeric(o["raw"]).alias("is_number"),
        )

    # an expression inside a lambda is evaluated wherever it is named, so what is
    # used more than once is bound first
    return T.let(
        T.clean_text(option),
        lambda clean: T.let(
            T.split_words(clean),
            lambda words: T.let(
                F.struct(
                    clean.alias("clean"),
                    words.alias("words"),
                    F.array_distinct(words).alias("distinct"),
                    option.alias("raw"),
                ),
                build,
            ),
        ),
    )


def _article_parts(article: Column) -> Column:
    return T.let(
        T.clean_text(article),
        lambda clean: F.struct(
            clean.alias("clean"),
            padded(clean).alias("pad"),
            F.transform(T.sentences(article), lambda s: padded(T.clean_text(s))).alias("sentence_pads"),
        ),
    )


def _question_parts(question: Column) -> Column:
    return T.let(
        T.split_words(T.clean_text(question)),
        lambda w: F.struct(w.alias("words"), T.bigrams(w).alias("pairs")),
    )


def text_features(items: DataFrame) -> DataFrame:
    """``items``: one row per question with ``row_id, article, question`` and
    ``options`` (array of ``label, text``).  Features are made inside the row
    and only numbers leave it."""
    article, question = _article_parts(F.col("article")), _question_parts(F.col("question"))
    made = T.let(
        article,
        lambda a: T.let(
            question,
            lambda q: F.transform(
                "options",
                lambda o: F.struct(o["label"].alias("label"), _option_features(a, q, o["text"]).alias("f")),
            ),
        ),
    )
    return items.select("row_id", F.inline(made)).select("row_id", "label", "f.*")


def tfidf_features(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(row_id, label, cosine, shared_idf)`` of each option.

    Texts stay where they are: their terms become places in the vocabulary, and only
    these numbers are distributed by question.  Rows of one question are taken together;
    those without a key belong to none.
    """
    known = vocab.select("term", "idf").toPandas()  # at most the terms of the vocabulary
    places, idf = corpus.places_in(known["term"].tolist()), known["idf"].to_numpy(float)
    texts = F.concat(F.array("article", "question"), F.transform("options", lambda o: o["text"]))
    found = items.where("row_id is not null").select(
        "row_id",
        F.transform("options", lambda o: o["label"]).alias("labels"),
        places(F.transform(texts, lambda t: T.term_tokens(T.clean_text(t)))).alias("p"),
    )
    option = lambda label, i: F.struct(
        label.alias("label"),
        F.concat(F.get("p", F.lit(1)), F.get("p", i + 2)).alias("asked"),
        F.get("p", i + 2).alias("own"),
    )
    placed = corpus.dealt(found.select("row_id", F.get("p", F.lit(0)).alias("article"), F.transform("labels", option).alias("options")), "row_id")
    whole = placed.groupBy("row_id").agg(
        F.flatten(F.collect_list("article")).alias("article"), F.flatten(F.collect_list("options")).alias("options"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                yield _cosines(batch.slice(start, 1024), idf)

    label = next(f for f in items.schema["options"].dataType.elementType.fields if f.name == "label").dataType
    kinds = {"row_id": items.schema["row_id"].dataType, "label": label}
    names = [f"{n} {k.simpleString()}" for n, k in kinds.items()]
    return whole.mapInArrow(run, ", ".join([*names, "tfidf_cosine_sim double", "shared_idf double"]))


def _cosines(batch: pa.RecordBatch, idf: np.ndarray) -> pa.RecordBatch:
    """The rows of ``tfidf_features`` of some questions (row_id, article, options)."""
    owner = lambda lists, of: np.repeat(of, lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    article, options = batch.column("article"), batch.column("options")
    questions = np.arange(batch.num_rows)
    label, asked, own = options.flatten().flatten()
    group = owner(options, questions)
    # options of a question that share a label are one
    code = label.dictionary_encode()
    ids, first, place = np.unique(group * (len(code.dictionary) + 1) + code.indices.fill_null(len(code.dictionary)).to_numpy(), return_index=True, return_inverse=True)
    of, n = group[first], len(ids)
    size = max(1, len(idf))
    there, at, wa = corpus.counted(owner(article, questions), article.flatten().to_numpy(), idf)
    na = np.bincount(at, wa * wa, batch.num_rows)

    def in_article(row: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Weight in the article of the question, 0 if absent."""
        wanted = of[row] * size + keys % size
        i = np.searchsorted(there, wanted)
        i[i == len(there)] = 0
        return np.where(there[i] == wanted, wa[i], 0.0) if len(there) else np.zeros(len(keys))

    keys, row, wq = corpus.counted(owner(asked, place), asked.flatten().to_numpy(), idf)
    dot, nq = np.bincount(row, wq * in_article(row, keys), n), np.bincount(row, wq * wq, n)
    keys, row, _ = corpus.counted(owner(own, place), own.flatten().to_numpy(), idf)
    # without entries bincount gives whole numbers
    shared = np.bincount(row, np.where(in_article(row, keys) > 0, idf[keys % size], 0.0), n).astype(float)
    norm = np.sqrt(nq * na[of])
    cosine = np.divide(dot, norm, out=np.zeros(n), where=norm > 0)
    return pa.RecordBatch.from_arrays(
        [batch.column("row_id").take(pa.array(of)), label.take(pa.array(first)), pa.array(cosine), pa.array(shared)],
        names=["row_id", "label", "tfidf_cosine_sim", "shared_idf"])


BASE_COLUMNS = V.VERIFIER_FEATURES[:10]


def verifier_features(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """Features 0 to 9 per option, and ``article_overlap`` beside them."""
    joined = text_features(items).join(tfidf_features(items, vocab), ["row_id", "label"], "left")
    return joined.select(
        "row_id",
        "label",
        F.coalesce("tfidf_cosine_sim", F.lit(0.0)).alias("tfidf_cosine_sim"),
        "unigram_overlap_ratio",
        F.when(F.col("n_shared") > 0, F.coalesce("shared_idf", F.lit(0.0)) / F.col("n_shared"))
        .otherwise(F.lit(0.0))
        .alias("idf_weighted_score"),
        *[c for c in BASE_COLUMNS[3:]],
        "article_overlap",
    )


def _terms(text: Column) -> Column:
    return T.term_tokens(T.clean_text(text))


def _lexicon(groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(group_id, squares, lexicon)``: the squared norm of an article and, for the
    terms of its questions and options, a map from term to idf and weight in the
    article (0 if absent).  Terms are counted once an article, however many
    questions it has, and a map has at most the terms of the vocabulary."""
    tagged = lambda terms, flag: F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(flag).alias("asked")))
    texts = lambda x: F.concat(F.array(x["question"]), F.transform(x["options"], lambda o: o["text"]))
    short = F.flatten(F.transform(F.flatten(F.transform("asked", texts)), _terms))
    counted = (
        groups.select("group_id", F.inline(F.concat(tagged(_terms(F.col("article")), 0), tagged(F.array_distinct(short), 1))))
        .groupBy("group_id", "term")
        .agg(F.count_if(F.col("asked") == 0).alias("tf"), F.max("asked").alias("asked"))
    )
    weight = F.when(F.col("tf") > 0, corpus.sublinear(F.col("tf"), F.col("idf"))).otherwise(F.lit(0.0))
    known = corpus.join_terms(counted, vocab).withColumn("weight", weight)
    entry = F.when(F.col("asked") == 1, F.struct("term", F.struct("idf", "weight")))
    return known.groupBy("group_id").agg(
        F.sum(F.col("weight") * F.col("weight")).alias("squares"),
        F.map_from_entries(F.collect_list(entry)).alias("lexicon"),
    )


def asked_features(groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """Features 0 to 9 of the options of many questions on one article, equal to
    ``verifier_features`` of each question alone.

    ``groups``: a row per article with ``group_id, article`` and ``asked``, an array
    of ``item, question, options`` (an array of ``label, text``).  An article is
    read in its own row and never repeated: numbers and the short terms of
    question and option leave it, and meet the lexicon of the article."""
    made = T.let(
        _article_parts(F.col("article")),
        lambda a: F.flatten(
            F.transform(
                "asked",
                lambda x: T.let(
                    F.struct(_question_parts(x["question"]).alias("parts"), _terms(x["question"]).alias("terms")),
                    lambda q: F.transform(
                        x["options"],
                        lambda o: F.struct(
                            x["item"].alias("item"),
                            o["label"].alias("label"),
                            o["text"].alias("text"),
                            q["terms"].alias("question_terms"),
                            _terms(o["text"]).alias("option_terms"),
                            _option_features(a, q["parts"], o["text"]).alias("f"),
                        ),
                    ),
                ),
            )
        ),
    )
    rows = groups.select("group_id", F.inline(made)).join(_lexicon(groups, vocab), "group_id", "left")
    total = lambda found, value: F.aggregate(found, F.lit(0.0), lambda acc, e: acc + value(e))
    in_vocabulary = lambda terms, tf: F.filter(
        F.transform(
            F.array_distinct(terms),
            lambda t: F.struct(F.try_element_at("lexicon", t).alias("known"), tf(terms, t).alias("tf")),
        ),
        lambda e: e["known"].isNotNull(),
    )
    times = lambda terms, t: F.size(F.filter(terms, lambda u: u == t))
    own = lambda e: corpus.sublinear(e["tf"], e["known"]["idf"])
    cosine = T.let(
        in_vocabulary(F.concat("question_terms", "option_terms"), times),
        lambda found: T.let(
            F.struct(
                total(found, lambda e: own(e) * e["known"]["weight"]).alias("dot"),
                (total(found, lambda e: own(e) * own(e)) * F.col("squares")).alias("squares"),
            ),
            lambda s: F.when(s["squares"] > 0, s["dot"] / F.sqrt(s["squares"])).otherwise(F.lit(0.0)),
        ),
    )
    shared = total(
        in_vocabulary(F.col("option_terms"), lambda *_: F.lit(1)),
        lambda e: F.when(e["known"]["weight"] > 0, e["known"]["idf"]).otherwise(F.lit(0.0)),
    )
    return rows.select(
        "group_id",
        "item",
        "label",
        "text",
        F.coalesce(cosine, F.lit(0.0)).alias("tfidf_cosine_sim"),
        F.col("f.unigram_overlap_ratio").alias("unigram_overlap_ratio"),
        F.when(F.col("f.n_shared") > 0, F.coalesce(shared, F.lit(0.0)) / F.col("f.n_shared"))
        .otherwise(F.lit(0.0))
        .alias("idf_weighted_score"),
        *[F.col(f"f.{c}").alias(c) for c in BASE_COLUMNS[3:]],
    )


def option_items(questions: DataFrame) -> DataFrame:
    """The four options of each question as items."""
    parts = F.array(
        *[
            F.struct(F.lit(n).alias("label"), F.coalesce(F.col(n), F.lit("")).alias("text"))
            for n in V.LABELS
        ]
    )
    return questions.select("row_id", "article", "question", parts.alias("options"))


# -- question ranker --------------------------------------------------------------------


def answer_position(sentence: Column, answer: Column) -> Column:
    def build(spot: Column) -> Column:
        found = spot > 0
        return F.struct(
            F.when(found, (spot - 1) / F.greatest(F.length(sentence), F.lit(1)))
            .otherwise(F.lit(-1.0))
            .alias("position"),
            F.when(found, F.size(T.apostrophe_tokens(F.substr(sentence, F.lit(1), spot - 1))))
            .otherwise(F.lit(0))
            .alias("words_before"),
            F.when(
                found, F.size(T.apostrophe_tokens(F.substr(sentence, spot + F.length(answer))))
            )
            .otherwise(F.size(T.apostrophe_tokens(sentence)))
            .alias("words_after"),
        )

    return T.let(T.answer_at(sentence, answer), build)


def score_columns(scores: Column) -> list[Column]:
    """The five verifier values of a question from the scores of its options, the
    answer's first: its score, the best other, the margin, its rank and the spread.
    All are 0 where there are no scores."""

    def build(s: Column) -> Column:
        own, rest = F.get(s, F.lit(0)), F.slice(s, F.lit(2), F.greatest(F.size(s), F.lit(1)))
        other = F.coalesce(F.array_max(rest), F.lit(0.0))
        rank = F.size(F.filter(s, lambda p: p > own)) + 1
        return F.array(own, other, own - other, rank.cast("double"), F.array_max(s) - F.array_min(s))

    made = T.let(scores, lambda s: F.when(F.size(s) > 0, build(s)))
    return [F.coalesce(F.get(made, F.lit(i)), F.lit(0.0)).alias(name) for i, name in enumerate(V.RANKER_FEATURES[-5:])]


def ranker_features(rows: DataFrame) -> DataFrame:
    """The 39 ranker columns beside question rows that carry
    ``n_sentences, article_overlap`` and, if known, the five verifier values."""
    q, s, a = F.col("question"), F.col("sentence"), F.col("answer_text")
    staged = (
        rows.withColumn("qt", T.apostrophe_tokens(q))
        .withColumn("st", T.apostrophe_tokens(s))
        .withColumn("ap", answer_position(s, a))
        # tokens hold no blank: a pair of them stands in the sentence where the padded
        # text of its tokens holds the padded pair
        .withColumn("sp", F.concat(F.lit(" "), F.array_join("st", " "), F.lit(" ")))
    )
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    wh, kind = F.col("wh_word"), F.col("answer_kind")
    expected = F.when(kind == "date", "when").when(kind == "person", "who").otherwise("what")
    tail = F.slice("qt", F.lit(2), F.greatest(F.size("qt"), F.lit(1)))
    known = set(rows.columns)
    pairs_in_sentence = lambda pairs: F.when(
        F.size(pairs) > 0,
        F.when(F.col("sp").isNotNull(), F.size(F.filter(pairs, lambda p: F.contains("sp", p))) / F.size(pairs)),
    ).otherwise(F.lit(0.0))
    values = {
        "question_word_count": F.size("qt").cast("double"),
        "question_char_count": F.length(q).cast("double"),
        "starts_with_wh": flag(wh != ""),
        "is_cloze": flag(F.col("template") == "cloze"),
        "has_blank": flag(F.contains(q, F.lit(V.BLANK))),
        "contains_answer_text": flag((a != "") & F.contains(F.lower(q), F.lower(a))),
        "has_verb_like_token": flag(T.verb_like(tail)),
        "second_word_bad": flag(F.get("qt", F.lit(1)).isin(V.RANKER_SECOND)),
        "trailing_word_bad": flag(F.try_element_at("qt", F.lit(-1)).isin(V.RANKER_LAST)),
        "double_punctuation": flag(q.rlike(r"\?\?|!!")),
        **{f"wh_{w}": flag(wh == w) for w in V.WH_WORDS},
        "answer_kind_date": flag(kind == "date"),
        "answer_kind_person": flag(kind == "person"),
        "answer_kind_acronym": flag(kind == "acronym"),
        "answer_kind_proper_noun": flag(kind == "properNoun"),
        "answer_kind_keyword": flag(kind == "keyword"),
        "wh_matches_answer_kind": flag(wh == expected),
        "answer_candidate_score": F.col("answer_score"),
        "answer_word_count": F.size(T.apostrophe_tokens(a)).cast("double"),
        "source_sentence_index": F.col("sent_idx").cast("double"),
        "source_sentence_position": F.col("sent_idx") / F.greatest("n_sentences", F.lit(1)),
        "source_sentence_word_count": F.size("st").cast("double"),
        "answer_position_in_sentence": F.col("ap.position"),
        "words_before_answer": F.col("ap.words_before").cast("double"),
        "words_after_answer": F.col("ap.words_after").cast("double"),
        "question_source_unigram_overlap": T.ratio_of_left(F.col("qt"), F.col("st")),
        "question_article_unigram_overlap": F.col("article_overlap"),
        "question_source_bigram_overlap": T.let(T.padded_bigrams(F.col("qt")), pairs_in_sentence),
    }
    for name in V.RANKER_FEATURES[-5:]:
        values[name] = F.col(name) if name in known else F.lit(0.0)
    keep = [c for c in rows.columns if c not in ("article_overlap", "n_sentences") and c not in values]
    return staged.select(*keep, *[values[n].alias(n) for n in V.RANKER_FEATURES])


# -- distractor ranker ----------------------------------------------------------------------


def distractor_features(answer: Column, option: Column, article_lower: Column) -> list[Column]:
    return _distractor_features(
        F.lower(answer), F.length(answer), option, F.lower(option), article_lower, T.lexical_cosine(answer, option))


def _distractor_features(low_answer: Column, length: Column, option: Column, low: Column, article_lower: Column, cosine: Column) -> list[Column]:
    return [
        F.levenshtein(low_answer, low).cast("double").alias("edit_distance"),
        F.abs(length - F.length(option)).cast("double").alias("length_difference"),
        F.contains(article_lower, low).cast("double").alias("in_article"),
        cosine.alias("lexical_cosine"),
    ]


def answer_parts(answer: Column) -> list[Column]:
    """What the features of all its options read of an answer, to be bound once."""
    return [
        F.lower(answer).alias("low_answer"),
        F.length(answer).alias("answer_length"),
        T.cosine_words(answer).alias("answer_words"),
    ]


def answered_features(answer: Column, option: Column, low: Column, article_lower: Column) -> list[Column]:
    """``distractor_features`` of bound ``answer_parts`` and an option with its lower case."""
    cosine = T.let(T.cosine_words(low), lambda words: T.words_cosine(answer["answer_words"], words))
    return _distractor_features(answer["low_answer"], answer["answer_length"], option, low, article_lower, cosine)


def distractor_training_rows(questions: DataFrame) -> DataFrame:
    """Human wrong options as positives, fixed words as negatives.

    Features are made inside the question row, so the article is neither
    copied per option nor shuffled.
    """
    human = [
        F.struct(F.lit(n).alias("option_id"), F.col(n).alias("text"), F.lit(1).alias("label"))
        for n in V.LABELS
    ]
    fixed = [
        F.struct(F.lit(f"n{i}").alias("option_id"), F.lit(w).alias("text"), F.lit(0).alias("label"))
        for i, w in enumerate(V.CONSTANT_NEGATIVES)
    ]
    pool = F.filter(
        F.array(*human, *fixed),
        lambda o: (o["option_id"] != F.col("answer")) & o["text"].isNotNull(),
    )
    made = T.let(
        F.lower("article"),
        lambda low: F.transform(
            pool,
            lambda o: F.struct(
                o["option_id"].alias("option_id"),
                *distractor_features(F.col("correct_answer"), o["text"], low),
                o["label"].alias("label"),
            ),
        ),
    )
    return questions.select("row_id", F.inline(made))
