"""The shared folder and what is kept in it."""

import os

import pytest

from quizlake.sources import storage


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://h", "local-cluster[2,1,1024]"])
def test_only_a_local_master_gets_a_folder_of_its_own(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.own_folder(master)


def test_local_master_gets_a_folder():
    assert os.path.isdir(storage.own_folder("local[8]"))


def test_changed_input_is_not_answered_from_the_cache(spark, tmp_path):
    def build():
        return spark.read.parquet(f"{tmp_path}/t.parquet")

    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    first = storage.once(spark, "t", str(tmp_path), build)
    again = storage.once(spark, "t", str(tmp_path), build)
    assert first is again and first.count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert storage.once(spark, "t", str(tmp_path), build).count() == 5


def test_dropped_table_is_gone(spark):
    table = storage.settle(spark.range(4))
    files = [f.removeprefix("file://") for f in table.inputFiles()]
    assert all(map(os.path.exists, files)) and files
    storage.drop(table)
    assert not any(map(os.path.exists, files))
