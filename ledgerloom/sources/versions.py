"""Tables kept as numbered versions in one folder.

A version is a folder of Parquet files and counts once its writer has finished, so that readers never see half a write, and a
write that is repeated under its number leaves what it left before. Any store that Spark writes to will do.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"v=(\d{10})")


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_of(folder: str, version: int) -> str:
    return f"{folder}/v={version:010d}"


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all versions that were begun, ascending."""
    fs, path = _place(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(int(m[1]) for m in (_NAME.fullmatch(s.getPath().getName()) for s in fs.listStatus(path)) if m)


def committed(spark: SparkSession, folder: str, upto: int | None = None) -> list[int]:
    """Numbers of the finished versions, ascending."""
    fs, _ = _place(spark, folder)
    done = [n for n in numbers(spark, folder) if upto is None or n <= upto]
    return [n for n in done if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path_of(folder, n)}/_SUCCESS"))]


def drop(spark: SparkSession, folder: str, version: int) -> None:
    fs, _ = _place(spark, folder)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path_of(folder, version)), True)


def read(spark: SparkSession, folder: str, schema: str, upto: int | None = None) -> DataFrame:
    """The last finished version (not above `upto`); without one, no rows."""
    numbers = committed(spark, folder, upto)
    return spark.read.schema(schema).parquet(path_of(folder, numbers[-1])) if numbers else spark.createDataFrame([], schema)


def read_all(spark: SparkSession, folder: str, schema: str, upto: int | None = None) -> DataFrame:
    """Rows of all finished versions."""
    numbers = committed(spark, folder, upto)
    return spark.read.schema(schema).parquet(*[path_of(folder, n) for n in numbers]) if numbers else spark.createDataFrame([], schema)


def write(df: DataFrame, folder: str, version: int, *, keep: int | None = 2) -> None:
    """Write a version, over what an interrupted writer left under its number; of the older ones the last `keep` - 1 stay (None: all)."""
    df.write.mode("overwrite").parquet(path_of(folder, version))
    if keep is not None:
        for n in committed(df.sparkSession, folder, version)[:-keep]:
            drop(df.sparkSession, folder, n)
