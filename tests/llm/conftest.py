import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, t int, rank int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns
    whose names clash with those the operators use."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Überraschung", "漢字", "x" * 40, "idiot"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    passage = " ".join(f"word{i}" for i in range(60))
    texts = [
        None, "", " \n\t", "!!!", "one two", "a b c d e", passage, passage + "\nanother line here", "first\n" + passage,
        passage.replace("word7 ", "changed "), long, "z" * 5000, "ab" * 400, long[:3000], "<|endoftext|> <|im_end|>",
    ]
    rows = [(i, x, "en" if i % 2 else None, "s" if i % 3 else None, len(x or ""), "d", 1, None) for i, x in enumerate(texts)]
    rows += [rows[6], rows[6], (99, passage, None, None, None, None, None, None), (None, passage, "de", "s", 1, None, 2, 3),
             (None, None, None, None, None, None, None, None), (6, "other text with the same id", "en", "s", 3, "x", 0, 0)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
