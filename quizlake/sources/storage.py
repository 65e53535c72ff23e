"""Reading and writing: folders, CSV, text files, models and metadata."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quizlake.operators import reshape as R

QUESTION_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ["row_id", *R.REQUIRED]]
)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.  Where it is
    unset, a local master, as in tests, gets one of its own; any other master
    has executors that would not see it, so that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        folder = own_folder(spark.sparkContext.master)
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def own_folder(master: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="quizlake-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the
    application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path, fs = _file_system(spark, path)
    fs.deleteOnExit(hadoop_path)
    return path


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a table that is read more than once: written to the
    shared folder and read back, so a lost executor costs no recomputation and
    later joins know its size."""
    path = new_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove a settled table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("table-"):
            hadoop_path, fs = _file_system(spark, folder)
            fs.delete(hadoop_path, True)


def release(spark: SparkSession) -> None:
    """Shuffle files of finished steps go once the JVM has collected the objects
    that name them; on a large heap that may be long after the step."""
    spark._jvm.System.gc()


def stamp(spark: SparkSession, folder: str) -> tuple:
    """Name, length and time of every file below a folder: changes whenever an
    input table is written anew."""
    hadoop_path, fs = _file_system(spark, folder)
    files, found = fs.listFiles(hadoop_path, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


_BUILT: dict[tuple, object] = {}


def once(spark: SparkSession, name: str, folder: str, build):
    """Build a shared intermediate once per application and state of the input
    folder, as a retrieval index is built once and then searched; a table is
    settled first.  A changed file in the folder builds it anew."""
    key = (spark.sparkContext.applicationId, name, folder, stamp(spark, folder))
    if key not in _BUILT:
        made = build()
        _BUILT[key] = settle(made) if isinstance(made, DataFrame) else made
    return _BUILT[key]


def through_csv(df: DataFrame) -> DataFrame:
    """Write as CSV with a header and read it back with the same schema."""
    spark = df.sparkSession
    path = new_folder(spark, "log")
    write_csv(df, path)
    return spark.read.schema(df.schema).csv(path, header=True, multiLine=True, escape='"')


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def read_questions(spark: SparkSession, path: str, schema: T.StructType = QUESTION_SCHEMA, multi_line: bool = True) -> DataFrame:
    """CSV question table; the header is checked by name first.  Files without line
    breaks inside quotes are split among tasks with ``multi_line=False``."""
    return _questions(spark, path, schema, multi_line, None)


def _questions(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, broken: str | None) -> DataFrame:
    header = spark.read.csv(path, header=True).columns
    missing = sorted(set(R.REQUIRED) - set(header))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    kinds = {f.name: f for f in schema.fields}
    fields = [kinds.get(c, T.StructField(c, T.StringType(), True)) for c in header]
    reader = spark.read.option("mode", "PERMISSIVE")
    if broken:
        fields.append(T.StructField(broken, T.StringType(), True))
        reader = reader.option("columnNameOfCorruptRecord", broken)
    return reader.schema(T.StructType(fields)).csv(path, header=True, multiLine=multi_line, escape='"')


def read_checked_questions(
    spark: SparkSession, path: str, schema: T.StructType = QUESTION_SCHEMA, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the rejects (``record, reason``): records with too few
    or too many fields, or a quote that is not closed, as they stand in the file.
    The file is read once."""
    broken = "_broken"
    rows = settle(_questions(spark, path, schema, multi_line, broken))
    rejects = rows.where(F.col(broken).isNotNull()).select(F.col(broken).alias("record"), F.lit("malformed record").alias("reason"))
    return rows.where(F.col(broken).isNull()).drop(broken), rejects


def read_text_passages(spark: SparkSession, path: str) -> DataFrame:
    """One plain-text file is one passage, keyed by its path."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("article"),
    )


def write_index(records: DataFrame, path: str) -> DataFrame:
    """Corpus records as parquet by category, and a manifest of the input."""
    records.write.mode("overwrite").partitionBy("option_category").parquet(f"{path}/records")
    manifest = fingerprint(records)
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash; equal inputs give equal rows."""
    h = F.pmod(F.xxhash64(*df.columns), F.lit(2**40))
    return df.agg(F.count("*").alias("n_rows"), F.sum(h).alias("fingerprint"))


def index_is_current(spark: SparkSession, records: DataFrame, path: str) -> bool:
    """False where no manifest is written yet; any other fault is raised."""
    hadoop_path, fs = _file_system(spark, f"{path}/manifest")
    if not fs.exists(hadoop_path):
        return False
    old = spark.read.parquet(f"{path}/manifest").first()
    return old == fingerprint(records).first()


# -- versioned stores: folders that a manifest names --------------------------------------------


def version_name() -> str:
    return f"version-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _file_system(spark, path)
    return fs.exists(hadoop_path)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    folder, fs = _file_system(spark, f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The latest manifest of a store, or none."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    rows = spark.read.text(f"{path}/manifests/{numbers[-1]}", wholetext=True)
    return json.loads(rows.first()["value"])


def publish(spark: SparkSession, path: str, content: dict) -> int:
    """Makes ``content`` the latest manifest.  It is written aside and then renamed
    to the next number: a rename that another writer was faster with fails, and
    this one takes the number after.  Readers see the old manifest or the new one."""
    aside = f"{path}/aside-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.text(aside)
    source, fs = _file_system(spark, aside)
    part = next(f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-"))
    folder, _ = _file_system(spark, f"{path}/manifests")
    fs.mkdirs(folder)
    number = max([0, *_numbers(spark, path)])
    while True:
        number += 1
        target, _ = _file_system(spark, f"{path}/manifests/{number}")
        if not fs.exists(target) and fs.rename(part, target):
            break
    fs.delete(source, True)
    return number
