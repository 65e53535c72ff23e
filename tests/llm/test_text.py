"""Encoding, chats, rules, urls, alignment and classifiers on small inputs."""

import hashlib
import re
import struct

import numpy as np
import pytest

from quizlake.llm import bpe, chat_format, decontaminate, language_id, line_dedup, quality_rules, toxicity, url_filters
from quizlake.llm.queries import tokenizer_file

PIECES = ["a", "B", "É", "é", "<|endoftext|>", "<|", " ", "\n", "\x1c", "\x85", "Σ", "ς", "İ", "ﬁ", "漢", "😀",
          "1", "'s", "'LL", "...", "ǅ", "ẞ", "aaaa", "the", "한", "क्षि"]


def random_texts(n=3000):
    rng = np.random.default_rng(1)
    return ["".join(PIECES[k] for k in rng.integers(0, len(PIECES), rng.integers(0, 40))) for _ in range(n)]


def test_bpe_equals_the_library(spark, odd_docs):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.load(path)
    texts = random_texts() + ["x" * 3000] + [r["text"] for r in odd_docs.select("text").collect()]
    for text, (ids, decoded) in zip(texts, bpe.encode_texts(own, texts), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(want)}I", ids)) == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_passes_columns_through(odd_docs, no_docs):
    path = tokenizer_file("word_bpe_49k.json")
    made = bpe.encode(odd_docs.withColumnRenamed("d", "ids"), path)
    assert made.count() == odd_docs.count()
    assert [c for c in made.columns if c not in ("ids", "decoded")] == [c for c in odd_docs.columns if c != "d"]
    assert sorted(map(repr, made.select(*odd_docs.drop("d").columns).collect())) == sorted(map(repr, odd_docs.drop("d").collect()))
    assert bpe.encode(no_docs, path).collect() == bpe.digests(no_docs, path).collect() == []


HARD = ["<|im_end|><|im_start|>assistant ok", "<", "|im_end|>", "<\\|", "<\\\\|x<|", "\n\n lead", "", None, "漢字 é <|im_sep|>", "tail <"]


def test_chat_round_trip(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    rows = [(c, t, ["user", "assistant", None, "a<|im_sep|>\nb"][(c + t) % 4], HARD[(c * 3 + t) % len(HARD)]) for c in range(12) for t in range(9)]
    rows += [(None, 0, "assistant", "no id"), (3, None, "user", "no turn"), (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(df, path).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_segments_do_not_change_the_result(spark, monkeypatch):
    path = tokenizer_file("byte_bpe_50k.json")
    turns = [("user" if k % 2 else "assistant", HARD[k % len(HARD)] or "x") for k in range(60)]
    whole = chat_format.segment(turns, path)
    parts = [chat_format.segment(turns[k : k + 7], path) for k in range(0, 60, 7)]
    assert whole.ids == [i for p in parts for i in p.ids] and whole.text == "".join(p.text for p in parts)
    assert whole.mask.tolist() == [m for p in parts for m in p.mask]
    assert whole.turns() == turns and whole.learned() == [x for r, x in turns if r == "assistant" and x]
    df = spark.createDataFrame([(1, k, r, x) for k, (r, x) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    assert "".join(r["text"] for r in chat_format.format_chats(df, path).orderBy("part").collect()) == whole.text
    assert chat_format.digests(df.limit(0), path).collect() == []


def brute_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    from collections import Counter

    n = Counter(wins)
    hit = {i + k for i, x in enumerate(wins) if n[x] > 1 for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(spark, odd_docs, no_docs):
    made = quality_rules.quality_rules(odd_docs)
    assert made.count() == odd_docs.count() and set(odd_docs.columns) <= set(made.columns)
    for r in made.collect():
        want = brute_rules(r["text"])
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["host_rate"] <= 1
    assert quality_rules.quality_rules(no_docs).collect() == quality_rules.verdicts(no_docs).collect() == []


def test_bad_hosts_fail_and_small_ones_follow_the_prior(spark):
    good, bad = "a b c d e f g h i j k l", "x"
    # thirty hosts fail in 0 to 20 of 100 documents, one always
    rows = [(i, bad if i // 30 % 100 < i % 30 * 2 // 3 else good, f"h{i % 30}") for i in range(3000)] + [(10_000 + i, bad, "junk") for i in range(200)] + [(20_000, bad, "tiny"), (20_001, good, "junk")]
    made = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert made[0]["kept"] and not made[20_001]["kept"] and not made[20_001]["base_failed"]
    assert made[20_000]["host_rate"] < made[10_000]["host_rate"]


URLS = [
    (1, "http://x.org/a", "org/", "allow"), (2, "https://a.example.org/es/1?q", "example.org/es/", "block"),
    (3, "http://EXAMPLE.org/en/12#f", "example.org/en/1", "block"), (4, "http://notexample.org/es/", "org/", "allow"),
    (5, "http://x.com/de/", "com/de/", "block"), (6, "http://x.com/DE/", None, "allow"), (7, None, None, "allow"),
    (8, "no scheme", None, "allow"), (9, "http://org", None, "allow"), (10, "http://www.cheap-pills.example.net/z", None, "block"),
    (11, "http://x.net/wp-admin", None, "block"), (12, "http://x.net/wp-administrator", None, "allow"), (13, "", None, "allow"),
    (14, "http://x.net/cgi-bin/a/b.exe?x", None, "block"), (None, "http://x.com/fr/", "com/fr/", "allow"), (1, "http://x.org/a", "org/", "allow"),
]


def test_url_filters(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", 1) for i, u, _, _ in URLS], "page_id long, url string, host string, rule string, a int")
    made = url_filters.verdicts(pages, url_filters.compiled(spark))
    got = sorted(((r["page_id"], r["rule"], r["verdict"]) for r in made.collect()), key=repr)
    assert got == sorted(((i, rule, verdict) for i, _, rule, verdict in URLS), key=repr)
    assert url_filters.verdicts(pages.limit(0), url_filters.compiled(spark)).collect() == []


def test_every_pattern_rule_is_filed_under_a_token_of_its_own():
    assert all(url_filters.pattern_rule(r)[4] for r in url_filters.PATTERN_RULES)
    assert url_filters.pattern_rule("*abc*")[4] == [] and url_filters.host_rule("block", "example.org/en/1")[4] == ["example", "org", "en"]


def brute_align(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item):
        for j, b in enumerate(passage):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a == b else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = (rng.integers(0, 5, rng.integers(1, 25)).astype(np.uint64) for _ in range(2))
        assert decontaminate.align(a, b)[0] == brute_align(a, b)


def test_decontamination_finds_exact_and_edited_copies(spark, odd_docs, no_docs):
    item = "quick brown foxes jump over seven lazy dogs while nine grey owls watch from the tall old oak"
    edited = item.replace("seven", "eight").replace("grey ", "").replace("tall", "very tall")
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "ab"), (None, "one two three four five six"), (1, item)], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(300))
    docs = spark.createDataFrame([(1, filler + " " + item.upper() + "! " + filler), (2, edited), (3, filler), (4, None), (5, ""), (6, "the tall old oak"), (6, item)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 1), (2, 1), (6, 1)} and got[1, 1] == 1.0 and got[2, 1] < 1
    assert sorted(r["doc_id"] for r in decontaminate.keep_clean(docs, benchmark).collect()) == [3, 4, 5, 6]
    assert decontaminate.keep_clean(odd_docs, benchmark).columns == odd_docs.columns
    assert decontaminate.keep_clean(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    assert decontaminate.leaks(no_docs, benchmark).collect() == []


def test_toxicity_learns_and_handles_odd_rows(spark, odd_docs, no_docs):
    rng = np.random.default_rng(7)
    word = lambda: f"w{rng.integers(0, 300)}"
    docs = [(i, " ".join([word() for _ in range(40)] + (["nasty"] if i % 4 == 0 else []))) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(600)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(df, labels).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in rows) and any(r["held_out"] for r in rows)
    odd = toxicity.toxicity(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in odd)
    assert {r["score"] for r in toxicity.toxicity(df, labels.limit(0)).collect()} == {0.5}
    assert toxicity.keep_clean(odd_docs, labels).columns == odd_docs.columns
    assert toxicity.toxicity(no_docs, labels).collect() == []


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 0


def test_language_id_odd_rows(odd_docs, no_docs):
    rows = language_id.language_id(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r["lang_pred"] for r in rows} <= {"en", "de", "und"}
    assert all(0 <= r["score"] <= 1 for r in rows)
    silent = [r for r in rows if r["doc_id"] in (0, 1, 2, 3)]
    assert silent and all(r["lang_pred"] == "und" and r["score"] == 0 for r in silent)
    assert language_id.language_id(no_docs).collect() == []


def test_unseen_words_back_off():
    counts = [(0, "a", "known", 5), (0, "b", "other", 5)] + [(n, lang, g, 3) for lang, w in (("a", "known"), ("b", "other")) for n in language_id.ORDERS for g in language_id.grams(w, n)]
    model = language_id.Model.of(counts)
    assert model.judge("known unknown knowing")[0] == "a" and model.judge("mother others")[0] == "b"


@pytest.fixture(scope="module")
def piped(spark, folder, tmp_path_factory):
    import corpus_pipeline

    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_path_factory.mktemp('stages')}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        found.append((name, docs, spark.read.parquet(out)))
        docs = found[-1][2]
    return found


def test_pipeline_stages_keep_columns_and_decide(spark, folder, piped):
    for name, before, after in piped[:-1]:
        assert after.columns == before.columns, name
        assert after.count() <= before.count()
    cut = piped[1]
    got = dict(cut[2].select("doc_id", "text").collect())
    rows = line_dedup.cleaned(cut[1]).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert got == {r["doc_id"]: r["text"] for r in rows if not 0 < r["n_lines"] == r["n_removed"]}
    assert len(got) < len(rows)
    last = piped[-1][2]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    silent = {r["doc_id"] for r in piped[0][1].collect() if not (r["text"] or "").split()}
    assert all(r["ids"] or r["doc_id"] in silent for r in last.collect())
    for r in last.select("text", "ids", "decoded").collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids)}I", r["ids"])) == ids
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert not any(i in r["text"] for i in items for r in piped[3][2].select("text").collect())


def test_pipeline_run_equals_its_stages(spark, folder, piped):
    import corpus_pipeline

    got = sorted(r["doc_id"] for r in corpus_pipeline.run(spark, folder).select("doc_id").collect())
    assert got == sorted(r["doc_id"] for r in piped[-1][2].select("doc_id").collect())


def test_pipeline_stages_on_odd_rows(spark, odd_docs, folder, tmp_path):
    """Null ids and texts, repeated rows, columns named like those of the stages."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    clash = {"n_lines": F.lit("mine"), "n_removed": F.lit(9), "leaks": F.lit(1), "score": F.lit(0.1), "node": F.lit("x")}
    docs = odd_docs.withColumns(clash)
    silent = {r["doc_id"] for r in docs.collect() if not (r["text"] or "").split()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = f"{tmp_path}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        after = spark.read.parquet(out)
        assert after.columns == docs.columns and 0 < after.count() <= docs.count()
        assert {(r["n_lines"], r["n_removed"], r["leaks"], r["node"]) for r in after.collect()} == {("mine", 9, 1, "x")}
        docs = after
    assert silent <= {r["doc_id"] for r in docs.collect()}
    assert not any(r["doc_id"] not in silent and not r["text"].split() for r in docs.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_pipeline_of_an_empty_table(spark, no_docs, folder):
    import corpus_pipeline

    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0
