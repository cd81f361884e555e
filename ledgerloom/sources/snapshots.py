"""Retrieved files kept under the hash of their content: each content once, whoever sends it and however often."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry_ops
from ..session import cut
from . import versions

MANIFEST = "retrieved_at string, dataset_id string, updated string, sha256 string, bytes int, csv_file string, status string"
CONTENT = "sha256 string, csv_file string, content binary"


def manifest(spark: SparkSession, home: str) -> DataFrame:
    """All retrievals so far, in no order: MANIFEST."""
    return versions.read_all(spark, f"{home}/manifest", MANIFEST)


def contents(spark: SparkSession, home: str) -> DataFrame:
    """CONTENT: everything that the manifest knows, under the name of its first retrieval."""
    done = versions.committed(spark, f"{home}/manifest")
    return versions.read_all(spark, f"{home}/content", CONTENT, done[-1] if done else 0)


def commit(files: DataFrame, home: str, run_ts: str) -> DataFrame:
    """Store files(dataset_id, updated, content) and append their rows to the manifest; the rows.

    What is new is written as a version of its own that counts only when the manifest has the same one, so a run that died between the
    two is repeated over what it left; what is there is never written again. Of equal contents in a run one is stored: the first
    name counts as downloaded, the others as unchanged.
    """
    spark = files.sparkSession
    done = versions.committed(spark, f"{home}/manifest")
    build = 1 + (done[-1] if done else 0)
    rows = registry_ops.snapshots(files, manifest(spark, home), run_ts)
    first = rows.groupBy("sha256").agg(F.min("csv_file").alias("kept"))
    rows = rows.join(first, "sha256").withColumn("status", F.when(F.col("csv_file") == F.col("kept"), F.col("status")).otherwise("unchanged"))
    rows = cut(rows.withColumn("csv_file", F.col("kept")).select(*[c.split()[0] for c in MANIFEST.split(", ")]))
    new = rows.filter("status = 'downloaded'").select("sha256", "csv_file").distinct()
    own = files.select(F.sha2("content", 256).alias("sha256"), F.col("content").cast("binary").alias("content")).join(new, "sha256")
    versions.write(own.groupBy("sha256", "csv_file").agg(F.first("content").alias("content")), f"{home}/content", build, keep=None)
    versions.write(rows, f"{home}/manifest", build, keep=None)
    return rows
