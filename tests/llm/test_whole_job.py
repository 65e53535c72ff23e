"""No row, leak or class is lost where a key is missing, repeated or frequent."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import GroupedData

from quizlake.llm import decontaminate, graph, jaccard_join, toxicity


@pytest.mark.parametrize("n", [7, 9, 1000])
def test_leaks_are_found_however_many_documents_hold_them(spark, n):
    item = [f"i{k}" for k in range(50)]
    partial = [f"p{k}" for k in range(40)]
    fifth = " ".join(f"e{k}" if k % 5 == 4 else w for k, w in enumerate(item))
    fourth = " ".join(f"e{k}" if k % 4 == 3 else w for k, w in enumerate(item))
    part = " ".join(f"e{k}" if k in (8, 16) else w for k, w in enumerate(partial[:24]))
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(partial))], "item_id long, text string")
    rows = [(t * n + k, x) for t, x in enumerate([fifth, fourth, part]) for k in range(n)]
    # the seeds that the copies lack stand elsewhere, so counts of an item differ
    rows += [(10**6 + k, " ".join(item[k : k + 4])) for k in range(47)]
    found = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(d, 1 if d < 2 * n else 2) for d in range(3 * n)]


def seeded(texts, rng):
    """An index whose seeds are chosen by counts that are no one's."""
    index = decontaminate.Index.of(texts)
    return index.seeded(np.array([rng.randint(0, 3) for _ in range(index.features)]))


def test_no_passage_that_reaches_the_threshold_is_left_out():
    """Against the alignment of whole texts, without seeds and windows: items with
    words replaced, left out and added at rates up to the threshold and beyond."""
    rng = random.Random(8)
    found = 0
    for _ in range(1500):
        letters = [f"w{k}" for k in range(rng.choice([4, 10, 200]))]
        item = [rng.choice(letters) for _ in range(rng.randint(3, 40))]
        around = lambda: [rng.choice([*letters, "x", "y", "z"]) for _ in range(rng.randint(0, 30))]
        replaced, left_out, added = (rng.choice([0, 0.1, 0.3, 0.5]) for _ in range(3))
        edited = []
        for w in item:
            if rng.random() >= left_out:
                edited.append(w if rng.random() >= replaced else "z")
            if rng.random() < added:
                edited.append("y")
        text = " ".join(around() + edited + around())
        index = seeded([(1, " ".join(item))], rng)
        read = index.read(text)
        best = decontaminate.align(index.items[0][1], read)[0]
        got = [round(r[1] * 2 * len(item)) for r in index.leaks(read)]
        assert got == ([best] if best >= len(item) else [])
        found += len(got)
    assert found > 300


@pytest.mark.parametrize("m", [30, 48, 60])
def test_edits_that_leave_no_three_words_in_a_row(spark, m):
    item = [f"i{k}" for k in range(m)]
    after_two = " ".join(w + (" new" if k % 2 else "") for k, w in enumerate(item))
    third = " ".join("new" if k % 3 == 2 else w for k, w in enumerate(item))
    after_each = " ".join(w + " new" for w in item)
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame([(1, after_two), (2, third), (3, after_each), (4, "new " * 50)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in decontaminate.leaks(docs, benchmark).collect()}
    assert sorted(got) == [1, 2, 3] and got[1] > 0.7 and min(got.values()) >= 0.5


def test_seeds_are_the_rarest_words_and_pairs():
    texts = [(1, "the of the of the of rare thing"), (2, "one two three")]
    index = decontaminate.Index.of(texts)
    counts = np.full(index.features, 1000)
    for w in ("rare", "thing", "one"):
        counts[index.known[w]] = 1
    index = index.seeded(counts)
    many = np.diff(index.first)
    assert all(many[index.known[w]] for w in ("rare", "thing", "one"))
    held = {i: int((index.places[:, 0] == i).sum()) for i in (0, 1)}
    assert held[0] >= 9 and held[1] >= 4  # more than half of the words and pairs of each


def test_one_block_of_items_is_broadcast_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 4)
    alive, most = set(), []
    make = type(spark.sparkContext).broadcast

    def broadcast(self, value):
        made = make(self, value)
        destroy = made.destroy
        alive.add(id(made))
        most.append(len(alive))
        made.destroy = lambda *a: (alive.discard(id(made)), destroy(*a))
        return made

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before {x} after") for k, x in items], "doc_id long, text string")
    got = decontaminate.leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(k, k) for k in range(12)]
    assert len(most) >= 6 and max(most) <= 2 and not alive


def test_a_group_of_near_copies_takes_one_edge_a_text_and_round(spark):
    """2,000 texts that share 40 keys in different ways, and the rows of each round."""
    rng = random.Random(2)
    pairs = [(f"n{k:05d}", f"{band}-{rng.choice('aab')}") for k in range(2_000) for band in range(40)]
    pairs += [("lone", "own"), ("m1", "two"), ("m2", "two")]
    df = spark.createDataFrame(pairs, "node string, key string")
    seen, plain = [], graph.followed

    def followed(edges):
        seen.append((edges.count(), edges.select("label").distinct().count()))
        return plain(edges)

    graph.followed = followed
    try:
        got = dict(map(tuple, graph.connected(df).collect()))
    finally:
        graph.followed = plain
    assert got == {f"n{k:05d}": "n00000" for k in range(2_000)} | {"m1": "m1", "m2": "m1"}
    assert seen and all(edges == texts <= 2_002 for edges, texts in seen) and len(seen) <= 4


def test_long_chains_are_one_component(spark):
    edges = [(f"c{(k * 7919) % 300:03d}", f"c{(k * 7919 + 7919) % 300:03d}") for k in range(299)]
    got = graph.components(spark.createDataFrame(edges, "u string, v string")).collect()
    assert len(got) == 300 and {r["root"] for r in got} == {"c000"}


def near_copies(name: str, n: int) -> list[str]:
    words = [f"{name}{k}" for k in range(60)]
    return [" ".join([*words, f"{name}end{k}"]) for k in range(n)]


def test_classes_that_share_ids_stay_apart(spark, tmp_path):
    from quizlake.llm import queries

    rows = [(None, x) for name in ("a", "b") for x in near_copies(name, 3)]
    rows += [(i, x) for name in ("c", "d") for i, x in enumerate(near_copies(name, 2), 5)]
    rows += [(i, x) for i, x in zip([None, 9, 8], near_copies("e", 3), strict=True)]
    rows += [(None, "f0 f1"), (None, None), (20, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = jaccard_join.one_of_each(docs).select("text").collect()
    assert sorted((r["text"] or "")[:1] for r in kept) == ["", "", "a", "b", "c", "d", "e", "f"]
    got = queries.QUERIES["op8_ngram_jaccard_join"](spark, str(tmp_path)).collect()
    shown = {}
    for r in got:
        shown.setdefault(r["class_id"], []).append((r["doc_id"], r["n_links"]))
    by_size = lambda x: (len(x), str(x))
    assert sorted(map(sorted_rows, shown.values()), key=by_size) == sorted(map(sorted_rows, [
        [(None, 2)] * 3, [(None, 2)] * 3, [(5, 1), (6, 1)], [(5, 1), (6, 1)], [(None, 2), (9, 2), (8, 2)],
        [(None, 0)], [(None, 0)], [(20, 0)]]), key=by_size)
    assert sorted_rows(shown[8]) == sorted_rows([(None, 2), (8, 2), (9, 2)]) and shown[20] == [(20, 0)] and -(2**63) not in shown


def sorted_rows(rows):
    return sorted(rows, key=str)


def test_no_more_than_two_blocks_are_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 50)
    monkeypatch.setattr(jaccard_join, "BIN", 100)
    held = []
    apply = GroupedData.applyInPandas

    def spy(grouped, run, schema):
        sizes = apply(grouped, lambda frame: pd.DataFrame({"n": [len(frame)]}), "n long")
        held.extend(r["n"] for r in sizes.collect())
        return apply(grouped, run, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", spy)
    rows = [(f"big{k}", 1, f"t{k}", "big", 1000) for k in range(1000)]
    rows += [(f"g{k}m{j}", 1, f"g{k} t{j}", f"g{k}", 2) for k in range(100) for j in range(2)]
    members = spark.createDataFrame(rows, "node string, copies long, x string, grp string, size long")
    jaccard_join.verified(members)
    assert sum(held) == 1000 * 20 + 200 and max(held) < 200


def test_without_labels_all_documents_stay(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1, None), (10**9, 1, 1)], "doc_id long, quality int, toxic int")
    for usable in (labels.limit(0), labels):
        kept = toxicity.keep_clean(odd_docs, usable)
        assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
