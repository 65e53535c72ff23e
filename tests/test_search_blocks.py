"""Retrieval over an index in several blocks, without a row for a pair of query and record."""

import pytest
from pyspark.sql import functions as F

from quizlake.operators import options as OP, retrieval as RT
from test_retrieval import WORDS, corpus


@pytest.fixture
def tables(spark):
    rows, asked = corpus()
    vocab = spark.createDataFrame([(w, 1, 1.0 + i / 3) for i, w in enumerate(WORDS)], "term string, df long, idf double")
    records = spark.createDataFrame(rows, "opt_id string, text string, option_key string, option_category string, document string")
    return spark.createDataFrame(asked, "q_id string, query_text string, categories array<string>"), records, vocab


def test_blocks_give_the_rows_of_one_block(tables, monkeypatch):
    want = sorted(map(tuple, RT.retrieve(*tables, 12, 0.3).collect()))
    monkeypatch.setattr(RT, "BLOCK_ROWS", 30)
    assert sorted(map(tuple, RT.retrieve(*tables, 12, 0.3).collect())) == want


def test_pairs_are_no_rows(tables):
    """The plan that the lists come from joins queries with no record."""
    queries, records, vocab = tables
    lists = RT.search_lists(queries, RT.build_index(records, vocab), 12)
    assert lists.count() == len({r.q_id for r in RT.retrieve(queries, records, vocab, 12).collect()})
    assert max(len(r.found) for r in lists.collect()) <= 12
    rows, lists = (OP._joined(queries, x).select("q_id", "found") for x in (lists.select("q_id", F.inline("found")), lists))
    assert sorted(rows.collect(), key=str) == sorted(lists.collect(), key=str)


def test_rows_of_one_key_are_one_query(tables):
    """Its terms and categories count once a row, and so do the rows that it finds."""
    queries, records, vocab = tables
    one = queries.where("q_id = 'q00'")
    twice = one.selectExpr("q_id", "concat(query_text, ' ', query_text) as query_text", "categories")
    want = {r.option_key: r.score for r in RT.retrieve(twice, records, vocab, 3, 1.0, top_up=False).collect()}
    got = RT.retrieve(one.union(one), records, vocab, 3, 1.0, top_up=False).collect()
    assert len(got) == 2 * len(want) and {r.option_key for r in got} == set(want)
    assert all(r.score == pytest.approx(2 * want[r.option_key]) for r in got)


def test_terms_are_counted_in_parts_of_their_own(spark):
    """Small parts are not joined by the size of their texts."""
    from quizlake.operators import corpus as K

    texts = spark.range(200).selectExpr("cast(id as string) as row_id", "'river stone' as text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert K.dealt(texts, "row_id").rdd.getNumPartitions() == parts
    assert texts.repartition("row_id").rdd.getNumPartitions() < parts
