"""Session building, the loader for the driver's Parquet tables, checkpoints and numbered rows."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def build_session(app: str = "ledgerloom", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster settings come from the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return builder.config(map=base | (conf or {})).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder. Only Spark's readers touch the path, so any Spark-readable store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint df in the folder of spark.checkpoint.dir.

    Without that setting a folder is made here for local masters only; on a cluster a machine-local one would lose data.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "checkpoints"))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, in the store that all executors share; the one who asks for it writes there."""
    cut(spark.range(0))  # so that the folder of checkpoints is settled
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def numbered(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df with `number`, from 0, within each key in the given order; a key of any size is dealt to as many tasks as its rows need.

    Rows are ranged by key and order; a partition's first number in a key follows from the counts of the partitions before it.
    """
    spark = df.sparkSession
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(cut(df).repartitionByRange(n, *by).sortWithinPartitions(*by).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition of the key
    starts = dealt.groupBy("_part", key).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).withColumnRenamed(key, "_key").withColumnRenamed("_part", "_own")
    both = dealt.join(starts, (F.col("_part") == F.col("_own")) & F.col(key).eqNullSafe(F.col("_key")))
    return both.withColumn("number", F.col("_at") - F.col("_first") + F.col("_before")).select(*df.columns, "number")
