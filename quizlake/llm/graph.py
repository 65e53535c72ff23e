"""Connected components of string nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quizlake.sources.storage import drop, settle


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of ``pairs`` (node, key) that shares a key with
    another one; ``root`` is the smallest node of its component.

    A round takes the smallest label of each key, then for each label the smallest
    one of its keys: one edge a label, however many nodes a key holds.  Labels
    follow these edges to their ends, keys that hold one label only are done, and
    the rest goes on with the ends.  At least half of the labels go in a round."""
    size = F.count("*").alias("n")
    members = F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h")
    keys = settle(pairs.distinct().groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z"), size, members).filter("a != z"))
    # keys with the same nodes say the same
    chosen = settle(keys.groupBy("a", "z", "n", "h").agg(F.min("key").alias("key")).select("key"))
    live = settle(pairs.distinct().join(chosen, "key").select("key", F.col("node").alias("label")))
    names = settle(live.select(F.col("label").alias("node"), "label").distinct())
    while True:
        least = live.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least != most")
        open_ = settle(live.join(least.select("key", "least"), "key"))
        if open_.isEmpty():
            return names.select("node", F.col("label").alias("root"))
        ends = followed(open_.groupBy("label").agg(F.min("least").alias("up")))
        moved = settle(names.join(ends, "label", "left").select("node", F.coalesce("end", "label").alias("label")))
        drop(names)
        drop(live)
        names, live = moved, settle(open_.join(ends, "label").select("key", F.col("end").alias("label")).distinct())
        drop(open_)
        drop(ends)


def followed(edges: DataFrame) -> DataFrame:
    """(label, end): where the edges (label, up), which never rise, lead."""
    now = settle(edges.select("label", F.col("up").alias("end")))
    while True:
        up = now.select(F.col("label").alias("end"), F.col("end").alias("top"))
        new = settle(now.join(up, "end", "left").select("label", F.coalesce("top", "end").alias("end"), (F.col("top") < F.col("end")).alias("moved")))
        done = new.filter("moved").isEmpty()
        drop(now)
        now = new.drop("moved")
        if done:
            return now


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) that has a neighbour."""
    key = F.concat_ws("\0", "u", "v").alias("key")
    return connected(edges.filter("u != v").select(F.explode(F.array("u", "v")).alias("node"), key))
