"""Question files with broken records, and the daily grades of a stream that is restarted."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quizlake.sources import storage
from quizlake.streaming import jobs as J

HEADER = "row_id,article,question,A,B,C,D,answer"


def written(tmp_path, *lines, name="q.csv"):
    path = tmp_path / name
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_embedded_newlines_quotes_and_commas(spark, tmp_path):
    path = written(tmp_path, '1,"One, two.\nThree ""four"".",Why?,a,b,c,d,A', "2,Plain.,Who?,a,b,c,d,B")
    rows = {r["row_id"]: r for r in storage.read_questions(spark, path).collect()}
    assert rows["1"]["article"] == 'One, two.\nThree "four".' and rows["2"]["answer"] == "B"
    good, rejects = storage.read_checked_questions(spark, path)
    assert sorted(r["row_id"] for r in good.collect()) == ["1", "2"] and rejects.count() == 0


@pytest.mark.parametrize("multi_line", [True, False])
def test_broken_records_are_kept_as_rejects(spark, tmp_path, multi_line):
    path = written(tmp_path, "1,Text.,Why?,a,b,c,d,A", "2,too few,Who?", "3,Text.,Who?,a,b,c,d,B,one more", "4,Text.,When?,a,b,c,d,C")
    good, rejects = storage.read_checked_questions(spark, path, multi_line=multi_line)
    assert good.columns == HEADER.split(",")
    assert sorted(r["row_id"] for r in good.collect()) == ["1", "4"]
    assert sorted(r["record"].split(",")[0] for r in rejects.collect()) == ["2", "3"]


def test_an_open_quote_loses_nothing_without_a_trace(spark, tmp_path):
    path = written(tmp_path, "1,Text.,Why?,a,b,c,d,A", '2,"never closed,Who?,a,b,c,d,B', "3,Text.,Who?,a,b,c,d,B")
    good, rejects = storage.read_checked_questions(spark, path)
    text = "\n".join(r["record"] for r in rejects.collect())
    assert [r["row_id"] for r in good.collect()] == ["1"] and "never closed" in text and "3,Text." in text
    good, rejects = storage.read_checked_questions(spark, path, multi_line=False)
    assert sorted(r["row_id"] for r in good.collect()) == ["1", "3"] and rejects.count() == 1


def test_missing_columns_and_empty_files(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("row_id,article\n1,x\n")
    with pytest.raises(ValueError, match="question"):
        storage.read_checked_questions(spark, str(path))
    good, rejects = storage.read_checked_questions(spark, written(tmp_path))
    assert good.count() == rejects.count() == 0


def test_days_of_a_restarted_stream(spark, tmp_path):
    """A late row that still counts, one out of order, and one that is too late."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    keys = spark.createDataFrame([("r", "A", "a", "a", "b", "c", "d")], "row_id string, answer string, correct_answer string, A string, B string, C string, D string")
    at = lambda day, hour: dt.datetime(2024, 3, day, hour)

    def add(*rows):
        made = spark.createDataFrame([(i, t, "r", s) for i, t, s in rows], "event_id long, ts timestamp, row_id string, selected string")
        made.coalesce(1).write.mode("append").parquet(source)

    def run():
        schema = "event_id long, ts timestamp, row_id string, selected string"
        attempts = spark.readStream.schema(schema).parquet(source)
        made = J.run_daily_grades(attempts, keys, out, state).collect()
        assert len({r["day"] for r in made}) == len(made)
        return {r["day"]: (r["n_attempts"], r["n_correct"]) for r in made}

    add((1, at(4, 9), "A"), (2, at(4, 10), "B"), (3, at(5, 11), "A"))
    assert run() == {"2024-03-04": (2, 1), "2024-03-05": (1, 1)}
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").iterdir() if p.name.startswith("day=")}
    add((4, at(5, 8), "A"), (5, at(6, 1), "B"))
    assert run() == {"2024-03-04": (2, 1), "2024-03-05": (2, 2), "2024-03-06": (1, 0)}
    after = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "out").iterdir() if p.name.startswith("day=")}
    assert before["day=2024-03-04"] == after["day=2024-03-04"]
    add((6, at(9, 1), "A"))
    run()
    add((7, at(4, 12), "A"), (8, at(9, 0), "B"))
    assert run() == {"2024-03-04": (2, 1), "2024-03-05": (2, 2), "2024-03-06": (1, 0), "2024-03-09": (2, 1)}
    assert run()["2024-03-09"] == (2, 1)
