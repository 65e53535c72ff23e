"""Hints of many answers read the opening sentences of their passage once."""

from __future__ import annotations

from pyspark.sql import functions as F

from quizlake.functions import text as T
from quizlake.operators import questions as Q

SENTENCES = [
    "Short one.", "The Slab was found in the Valley ,", "A soldier found the slab  near Rosetta.", None,
    "It is known as the Slab, of course it is.",
]


def test_hints_read_the_opening_sentences_once(spark):
    answers = ["slab", "", "Rosetta", "found", None, "(x"]
    df = spark.createDataFrame(
        [(SENTENCES, a, i) for a in answers for i in (0, 1, 2, 4)], "ss array<string>, a string, i int")
    alone = Q.hints(F.col("ss"), F.col("a"), F.col("i"))
    shared = T.let(Q.openings(F.col("ss")), lambda op: Q.hints(F.col("ss"), F.col("a"), F.col("i"), op))
    rows = df.select(alone.alias("x"), shared.alias("y"), "a", "i").collect()
    assert len(rows) == 24 and all(r.x == r.y for r in rows)
    # an opening is long enough and its own length counts after its ends are clean
    assert {(r.a, r.x[0]) for r in rows if r.a == "slab"} == {("slab", "Short one")}
    assert {r.x[0] for r in rows if r.a == "Rosetta"} == {"The Slab was found in the Valley"}
    opened = df.select(F.transform(Q.openings(F.col("ss")), lambda x: x["tidy"]).alias("t")).first().t
    assert opened == ["The Slab was found in the Valley", "A soldier found the slab near Rosetta", "It is known as the Slab, of course it is"]
