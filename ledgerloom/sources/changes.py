"""What changed in a folder of files since the last look, by name, size, time and, where these differ, content."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

STATE = "path string, size long, modified timestamp, sha256 string"


def listing(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """path, size and modified of the files of a folder; no content is read."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and content of the given files only; a file that went meanwhile has no row."""
    if not paths:
        return spark.createDataFrame([], "path string, content binary")
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]
    return spark.read.format("binaryFile").option("ignoreMissingFiles", True).load(literal).select("path", "content")


def compare(found: DataFrame, state: DataFrame) -> DataFrame:
    """path, size, modified, before (the hash on record) and kind: new, suspect (size or time differ), same or removed.

    found: path, size, modified. state: STATE. A removed file keeps the size and time on record.
    """
    old = state.select(F.col("path").alias("known"), F.col("size").alias("old_size"), F.col("modified").alias("old_modified"), F.col("sha256").alias("before"))
    df = found.join(old, F.col("path") == F.col("known"), "full_outer")
    differs = ~F.col("size").eqNullSafe(F.col("old_size")) | ~F.col("modified").eqNullSafe(F.col("old_modified"))
    kind = F.when(F.col("path").isNull(), "removed").when(F.col("known").isNull(), "new").when(differs, "suspect").otherwise("same")
    return df.select(F.coalesce("path", "known").alias("path"), F.coalesce("size", "old_size").alias("size"), F.coalesce("modified", "old_modified").alias("modified"), "before", kind.alias("kind"))


def settle(seen: DataFrame, hashed: DataFrame) -> DataFrame:
    """path, size, modified, sha256, status of compare()'s rows once new and suspect files are hashed (path, sha256).

    status: new, changed, touched (the same content again), unchanged, removed, or unreadable where a file has no hash.
    """
    df = seen.join(hashed, "path", "left")
    status = F.when(F.col("kind") == "same", "unchanged").when(F.col("kind") == "removed", "removed").when(F.col("sha256").isNull(), "unreadable")
    status = status.when(F.col("kind") == "new", "new").when(F.col("sha256") == F.col("before"), "touched").otherwise("changed")
    return df.select("path", "size", "modified", F.coalesce("sha256", "before").alias("sha256"), status.alias("status"))


def changes(spark: SparkSession, folder: str, state: DataFrame, pattern: str = "*.json") -> DataFrame:
    """settle() of a folder against the state of the last look; only new and suspect files are read.

    Their paths go through the driver, which holds the folder's listing for Spark anyway.
    """
    seen = cut(compare(listing(spark, folder, pattern), state))
    paths = [r["path"] for r in seen.filter("kind in ('new', 'suspect')").select("path").collect()]
    return settle(seen, contents(spark, paths).select("path", F.sha2("content", 256).alias("sha256")))


def state_after(settled: DataFrame) -> DataFrame:
    """STATE for the next look: removed files are forgotten, unreadable ones are tried again."""
    return settled.filter("status not in ('removed', 'unreadable')").select("path", "size", "modified", "sha256")
