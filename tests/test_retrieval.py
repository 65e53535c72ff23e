"""Retrieval against brute force, and the greedy pick against a plain loop."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quizlake.operators import options as OP, retrieval as RT

WORDS = ["the", "of", "and", "river", "stone", "city", "light", "cell", "star", "king", "tower", "glass"]


def corpus(seed=7, n=160):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(WORDS[3:]) for _ in range(rng.randint(1, 2)))
        tail = " ".join(rng.choice(WORDS[: rng.choice([2, 3, 12])]) for _ in range(rng.randint(1, 6)))
        rows.append((f"r{i:03d}", text, text, rng.choice(["term", "date"]), f"{text} {tail}"))
    # a third of all records are copies of one
    rows += [(f"z{i:03d}", "stone", "stone", "term", "stone the of the") for i in range(n // 2)]
    asked = [(f"q{i:02d}", " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 7))), [rng.choice(["term", "date"])]) for i in range(25)]
    return rows, asked


@pytest.mark.parametrize("hot_share", [0.05, 0.3, 1.0])
@pytest.mark.parametrize("k", [3, 12])
def test_equals_brute_force(spark, hot_share, k):
    rows, asked = corpus()
    idf = {w: 1.0 + i / 3 for i, w in enumerate(WORDS)}
    vocab = spark.createDataFrame([(w, 1, x) for w, x in idf.items()], "term string, df long, idf double")
    records = spark.createDataFrame(rows, "opt_id string, text string, option_key string, option_category string, document string")
    queries = spark.createDataFrame(asked, "q_id string, query_text string, categories array<string>")

    def vector(text):
        return {w: round((1 + math.log(n)) * idf[w] * RT.SCALE) for w, n in Counter(text.split()).items()}

    def best(query, rows):
        found = {}
        q = vector(query)
        for _, _, key, _, document in rows:
            r = vector(document)
            dot = sum(q[w] * r[w] for w in q if w in r)
            if dot:
                found[key] = max(found.get(key, 0.0), dot / math.sqrt(sum(x * x for x in r.values())))
        return sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]

    want = {}
    for q_id, query, categories in asked:
        inside = best(query, [r for r in rows if r[3] in categories])
        if len(inside) < k:
            both = dict(best(query, rows))
            both.update({key: max(s, both.get(key, 0.0)) for key, s in inside})
            inside = sorted(both.items(), key=lambda x: (-x[1], x[0]))[:k]
        want[q_id] = {key for key, _ in inside}
    got = {}
    for r in RT.retrieve(queries, records, vocab, k, hot_share).collect():
        got.setdefault(r.q_id, set()).add(r.option_key)
    assert got == {q: keys for q, keys in want.items() if keys}


def test_select_diverse(spark):
    keys = ["", "the answer here", "red stone", "red stone wall", "stone red", "blue sky", "answer", "grey", "white"]
    rows = spark.createDataFrame([(keys,)], "keys array<string>")
    entries = F.transform("keys", lambda k: F.struct(k.alias("key"), k.alias("text")))
    picked = rows.select(F.transform(OP.select_diverse(entries, F.lit("answer")), lambda e: e["key"]).alias("p"))
    assert picked.first().p == ["red stone", "blue sky", "grey"]
