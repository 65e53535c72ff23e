"""Streams give what the batch gives."""

from check import canonical
from quizlake.catalog import ORACLES, QUERIES
from quizlake.sources import storage


def same(spark, duck, folder, name):
    got = QUERIES[name](spark, folder).toPandas()
    want = duck.execute(ORACLES[name]).fetch_df()
    assert [repr(r) for r in canonical(got)] == [repr(r) for r in canonical(want)]


def test_stream_candidates(spark, duck, folder):
    same(spark, duck, folder, "stream_candidates")


def test_stream_attempts(spark, duck, folder):
    same(spark, duck, folder, "stream_attempts")


def test_text_files_and_index(spark, tmp_path):
    (tmp_path / "one.txt").write_text("  First line.\nSecond line. ")
    rows = storage.read_text_passages(spark, str(tmp_path)).collect()
    assert [r.article for r in rows] == ["First line.\nSecond line."]
    records = spark.createDataFrame([("a", "x", "term"), ("b", "y", "date")], "opt_id string, text string, option_category string")
    path = str(tmp_path / "index")
    assert not storage.index_is_current(spark, records, path)
    storage.write_index(records, path)
    assert storage.index_is_current(spark, records, path)
    assert not storage.index_is_current(spark, records.limit(1), path)
