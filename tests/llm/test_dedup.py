"""Suffix-array dedup, line dedup and the Jaccard join against brute force."""

import hashlib
import random
import re

import pytest

from quizlake.llm import graph, jaccard_join, line_dedup, suffix_dedup


def order(df):
    from quizlake.llm.common import identity

    rows = df.select(*identity(df["doc_id"], df["text"]), "doc_id", "text").distinct().collect()
    return sorted(((r["d"], r["t"], r["doc_id"], r["text"]) for r in rows), key=lambda r: r[:2])


def brute_bytes(docs, width=100):
    seen, found = set(), []
    for _, _, doc_id, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if b[i : i + width] in seen:
                gone[i : i + width] = b"\1" * width
            seen.add(b[i : i + width])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        found.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def test_suffix_dedup_equals_brute_force(spark, odd_docs):
    got = {tuple(r) for r in suffix_dedup.digests(odd_docs).collect()}
    assert got == set(brute_bytes(order(odd_docs)))
    assert suffix_dedup.digests(odd_docs).count() == odd_docs.count()


def test_suffix_dedup_hot_keys(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    assert {tuple(r) for r in suffix_dedup.digests(odd_docs).collect()} == set(brute_bytes(order(odd_docs)))


def test_suffix_dedup_empty_table(no_docs):
    assert suffix_dedup.digests(no_docs).collect() == []


def test_column_wise_construction_equals_sorting():
    rng = random.Random(1)
    for _ in range(30):
        chunks = [bytes(rng.choice(b"ab\xc3") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 20))]
        owner, size, lcp = suffix_dedup.bwt_and_lcp(chunks)
        got = [chunks[i][len(chunks[i]) - k :] for i, k in zip(owner, size, strict=True)]
        assert [(x, i) for x, i in zip(got, owner, strict=True)] == sorted(
            ((c[k:], i) for i, c in enumerate(chunks) for k in range(len(c) + 1)))
        for a in range(1, len(got)):
            n = 0
            while n < min(len(got[a]), len(got[a - 1])) and got[a][n] == got[a - 1][n]:
                n += 1
            assert lcp[a] == n


def brute_lines(docs, least):
    def lines(text):
        return [(i, x) for i, x in enumerate((text or "").split("\n")) if re.search(line_dedup.WORD, x)]

    count = lambda x: len(re.findall(line_dedup.WORD, x))
    first, runs = {}, []
    for k, (_, _, _, text) in enumerate(docs):
        own = lines(text)
        for a in range(len(own)):
            for z in range(a, len(own)):
                run = tuple(x for _, x in own[a : z + 1])
                if sum(map(count, run)) >= least:
                    first.setdefault(run, (k, a))
                    runs.append((run, k, a, [i for i, _ in own[a : z + 1]]))
    gone = {}
    for run, k, a, places in runs:
        if first[run] != (k, a):
            gone.setdefault(k, set()).update(places)
    found = []
    for k, (_, _, doc_id, text) in enumerate(docs):
        out = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(k, ()))
        found.append((doc_id, len(lines(text)), len(gone.get(k, ())), out))
    return found


@pytest.mark.parametrize("least", [1, 6, 50])
def test_line_dedup_equals_brute_force(spark, least):
    rng = random.Random(least)
    pool = ["a b c", "d e", "f", "g h i j", "", "  ", "k l m n o p q"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(25)]
    docs += [(30, None), (None, docs[3][1]), (31, "\n".join(pool * 8)), (32, "\n".join(pool * 8))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in line_dedup.cleaned(df, least).select("doc_id", "n_lines", "n_removed", "text").collect()]
    assert sorted(got, key=repr) == sorted(brute_lines(order(df), least), key=repr)


def test_line_dedup_odd_rows(odd_docs, no_docs):
    kept = line_dedup.cleaned(odd_docs)
    assert kept.count() == odd_docs.count() and set(odd_docs.columns) < set(kept.columns)
    assert line_dedup.cleaned(no_docs).collect() == []


def brute_sets(text):
    w = jaccard_join.split_words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_jaccard_join_equals_brute_force(spark, odd_docs):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(x if rng.random() > 0.01 * (i % 5) else f"e{i}" for x in base)) for i in range(60)]
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
    docs += [(1000 + k, x) for k, (_, x) in enumerate(odd)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = {i: brute_sets(x) for i, x in docs}
    near = {i: {j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}
    root = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += near[x]
    got = {r["d"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_classes(df).collect()}
    assert got == {i: (root[i], len(near[i])) for i in sets}


def test_jaccard_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(x if rng.random() > 0.004 else f"e{i}" for x in base)) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one = sorted(map(tuple, jaccard_join.jaccard_classes(df).collect()))
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    assert sorted(map(tuple, jaccard_join.jaccard_classes(df).collect())) == one


def test_one_of_each_class_stays(odd_docs, no_docs):
    kept = jaccard_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("text is null").count() == 2
    assert kept.filter("doc_id = 99").count() == 0
    assert jaccard_join.one_of_each(no_docs).collect() == []


def test_components(spark):
    edges = [("a", "b"), ("b", "c"), ("x", "y"), ("z", "y"), *[(f"n{i:03}", f"n{i + 1:03}") for i in range(50)]]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u string, v string")).collect()))
    assert got["c"] == "a" and got["z"] == "x" and got["n050"] == "n000"


def test_pruning_bound():
    assert jaccard_join.least_equal(20) < 16 and jaccard_join.least_equal(200) < 160
