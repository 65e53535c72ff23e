import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quizlake.llm import spelling


def plain_words(rows):
    total = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def plain_groups(words):
    out, form = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        top = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 10 * n else None
        out[w] = (n, len(others), words[form[w]] if form[w] else None)
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


def made(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def crowded(seed=3, size=400, letters="abé"):
    """Words over few letters: near pairs of every kind, ties and chains."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(7, 10))) for _ in range(size)}
    return {w: rng.choice([2, 2, 3, 20, 30, 200, 300, 3000, 40000]) for w in sorted(words)}


@pytest.mark.parametrize("unit", [20_000, 30, 4])
def test_groups_equal_brute_force(spark, monkeypatch, unit):
    """Small units: keys are dealt anew by exact halves and then in blocks."""
    monkeypatch.setattr(spelling, "UNIT", unit)
    words = crowded()
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = made(spelling.spelling_variants(df))
    assert got == plain_groups(words)
    assert any(r[0] and r[0] != r[1] for r in got.values())


def test_one_hot_half(spark, monkeypatch):
    """A third of the words share their first half."""
    monkeypatch.setattr(spelling, "UNIT", 50)
    rng = random.Random(1)
    words = {"zzzzzz" + "".join(rng.choice("ab") for _ in range(7)): rng.choice([2, 40]) for _ in range(200)}
    words |= crowded(9, 200, "abcd")
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert made(spelling.spelling_variants(df)) == plain_groups(words)


def test_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert made(spelling.grouped(odd_docs)) == plain_groups(plain_words(rows))
    assert spelling.grouped(no_docs).count() == 0
    mixed = [(1, "Überraschung ÜBERRASCHUNG Ueberraschung straße STRASSE"), (2, "ÜBERRASCHUNG überraschung a×b÷cdefg A×b÷cdefg"),
             (None, "aaaaaaa " * 25 + "aaaaaaaa aaaaaaaa aaaaaab aaaaaab")]
    df = spark.createDataFrame(mixed, "doc_id long, text string")
    assert made(spelling.grouped(df)) == plain_groups(plain_words(mixed))


def test_long_words(spark):
    mixed = [(1, "z" * 3000 + " " + "z" * 3000), (2, "z" * 2999 + " " + "z" * 2999), (3, ("q" * 200 + " ") * 2 + ("q" * 199 + "r ") * 30)]
    df = spark.createDataFrame(mixed, "doc_id long, text string")
    assert made(spelling.grouped(df)) == plain_groups(plain_words(mixed))


def test_whole_table(spark, folder, duck):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = duck.execute(spelling.SQL).fetchall()
    want = {w: (form, root, n, k, None if m is None else int(m)) for w, form, root, n, k, m in want}
    assert made(spelling.grouped(docs)) == want


def test_intervals_of_both_directions_stay_in_step():
    words = sorted({"banana", "ananas", "bandana", "nabana", "ana"})
    index, text = spelling.Index(words), "\0".join([*words, ""])
    cyclic = text * 2
    for pattern in ("an", "na", "ban", "a\0b", "\0ana\0", "x"[:0]):
        if any(c not in text for c in pattern):
            continue
        codes = index.symbols(pattern)
        for cut in range(len(pattern) + 1):
            state = index.whole(1)
            for c in codes[cut:]:
                state = index.extend(state, np.array([c]), 1)
            for c in codes[:cut][::-1]:
                state = index.extend(state, np.array([c]), 0)
            want = sum(cyclic[i : i + len(pattern)] == pattern for i in range(len(text)))
            assert state[2, 0] == want
            rotations = sorted(range(len(text)), key=lambda i: cyclic[i : i + len(text)])
            first = min((r for r, i in enumerate(rotations) if cyclic[i:].startswith(pattern)), default=None)
            assert not want or state[0, 0] == first
