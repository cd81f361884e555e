"""Incremental processing: a folder of bulletin files brought up to date, and the registry as a stream of sightings.

`refresh` looks at a folder, reads new and changed files only, sets broken ones aside without losing a row, and commits what it
found as one version. `upsert_registry` merges each micro-batch of sightings into a versioned registry, under the batch's number, so
that a batch that was killed and comes again leaves the same registry. `parse_new` appends the entries of new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry_ops, segment
from ..session import cut
from ..sources import changes, readers, versions


def bulletin_stream(spark: SparkSession, path: str) -> DataFrame:
    """bulletin_id and pages of the text files in a folder, as they arrive."""
    df = spark.readStream.schema(readers.TEXT_SCHEMA).option("multiLine", True).json(path)
    return df.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("bulletin_id"), "pages")


def parse_new(spark: SparkSession, path: str, out: str, checkpoint: str) -> None:
    """Append the entries of all files not seen before to a Parquet folder; returns when they are written."""
    query = segment.split_entries(bulletin_stream(spark, path)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query.outputMode("append").trigger(availableNow=True).start().awaitTermination()


BULLETINS = (
    "bulletin_id string, path string, sha256 string, status string, why string, needs_ocr boolean, has_text boolean, n_pages int, n_chars int, extraction_method string, n_entries int, "
    "empty_bullets int, marker_found boolean, notes array<string>, version long, first_seen string, last_read string"
)
ENTRIES = f"{segment.ENTRY_SCHEMA}, version long"


def refresh(spark: SparkSession, folder: str, home: str, run_ts: str, pattern: str = "*.json") -> DataFrame:
    """Bring the tables in `home` up to date with the files of a folder; path, size, modified, sha256 and status of each file.

    home/files is the state of the folder, home/bulletins has a row for each file ever seen, home/entries the entries of each run. All
    three get the same new version, files last: its version is what the readers below go by, and a run that dies before it is
    repeated over what it left. A broken file gets status corrupt, unreadable or no_text and keeps the entries of its last good
    reading; a removed one keeps its row and loses its entries. Without a change no version is written.
    """
    done = versions.committed(spark, f"{home}/files")
    last = done[-1] if done else 0
    state = versions.read(spark, f"{home}/files", changes.STATE, last)
    settled = cut(changes.changes(spark, folder, state, pattern))
    moved = settled.filter("status in ('new', 'changed', 'unreadable', 'removed')")
    if moved.isEmpty():
        if not settled.filter("status = 'touched'").isEmpty():  # so that these are not read again
            _commit(changes.state_after(settled), versions.read(spark, f"{home}/bulletins", BULLETINS, last), home, last + 1, None)
        return settled
    wanted = settled.filter("status in ('new', 'changed')")
    read = readers.checked(changes.contents(spark, [r["path"] for r in wanted.select("path").collect()]))
    read = cut(read.select("path", "bulletin_id", "status", "why", "pages", "method", "has_text_layer"))
    good = read.filter("status = 'ok'")
    parsed = cut(segment.parse(good))
    facts = segment.diagnose(good, parsed).drop("n_bulleted")
    found = moved.select("path", "sha256", F.col("status").alias("change")).join(read.select("path", "status", "why", F.col("bulletin_id").alias("name")), "path", "left")
    found = found.join(facts.withColumnRenamed("bulletin_id", "name"), "name", "left").withColumn("name", F.coalesce("name", F.regexp_extract("path", r"([^/]+?)(?:\.json)?$", 1)))
    entries = segment.split_entries(good, parsed).withColumn("version", F.lit(last + 1).cast("long"))
    before = versions.read(spark, f"{home}/bulletins", BULLETINS, last)
    _commit(changes.state_after(settled), _merged(before, found, last + 1, run_ts), home, last + 1, entries)
    return settled


def _merged(before: DataFrame, found: DataFrame, version: int, run_ts: str) -> DataFrame:
    """BULLETINS after a run: found has a row for each file that is new, changed, unreadable or removed."""
    old = before.select(*[F.col(c).alias(f"old_{c}") for c in before.columns])
    df = found.join(old, F.col("name") == F.col("old_bulletin_id"), "full_outer")
    c, untouched = F.col, F.col("change").isNull()
    status = F.when(c("change") == "removed", "removed").otherwise(F.coalesce("status", F.lit("unreadable")))
    good = ~untouched & F.coalesce(status == "ok", F.lit(False))
    facts = ("n_pages", "n_chars", "extraction_method", "n_entries", "empty_bullets", "marker_found", "notes")
    return df.select(
        F.coalesce("name", "old_bulletin_id").alias("bulletin_id"), F.coalesce("path", "old_path").alias("path"), F.when(untouched, c("old_sha256")).otherwise(c("sha256")).alias("sha256"),
        F.when(untouched, c("old_status")).otherwise(status).alias("status"), F.when(untouched, c("old_why")).otherwise(F.coalesce("why", F.lit(""))).alias("why"),
        F.when(untouched, c("old_needs_ocr")).otherwise(F.coalesce("needs_ocr", F.lit(True))).alias("needs_ocr"), F.when(untouched, c("old_has_text")).otherwise(F.coalesce("has_text", F.lit(False))).alias("has_text"),
        *[F.when(good, c(k)).otherwise(c(f"old_{k}")).alias(k) for k in facts], F.when(good, F.lit(version)).otherwise(c("old_version")).cast("long").alias("version"),
        F.coalesce("old_first_seen", F.lit(run_ts)).alias("first_seen"), F.when(untouched, c("old_last_read")).otherwise(F.lit(run_ts)).alias("last_read"),
    )


def _commit(state: DataFrame, bulletins: DataFrame, home: str, version: int, entries: DataFrame | None) -> None:
    if entries is not None:
        versions.write(entries, f"{home}/entries", version, keep=None)
    versions.write(bulletins, f"{home}/bulletins", version)
    versions.write(state, f"{home}/files", version)


def bulletins(spark: SparkSession, home: str) -> DataFrame:
    """BULLETINS as of the last finished run; its columns are what `review.bulletin_issues` reads as diagnostics."""
    done = versions.committed(spark, f"{home}/files")
    return versions.read(spark, f"{home}/bulletins", BULLETINS, done[-1] if done else 0)


def entries(spark: SparkSession, home: str) -> DataFrame:
    """Entries as of the last finished run: of each bulletin those of its last good reading."""
    done = versions.committed(spark, f"{home}/files")
    every = versions.read_all(spark, f"{home}/entries", ENTRIES, done[-1] if done else 0)
    return every.join(bulletins(spark, home).filter("status <> 'removed'").select("bulletin_id", "version"), ["bulletin_id", "version"], "left_semi")


REGISTRY = "bulletin_id string, pdf_url string, date_discovered string, last_seen string, still_on_index boolean, note string"


def merge_batch(sightings: DataFrame, batch: int, folder: str) -> None:
    """Version batch + 1 of the registry: the version before it with the sightings(bulletin_id, pdf_url, seen, seq) of one batch.

    A batch shows a part of the index only, so rows that it lacks stay as they are. Of several sightings of a bulletin the last one by seq
    counts. The version before is never above `batch`, so a repeated batch starts from where it started first.
    """
    spark = sightings.sparkSession
    before = versions.read(spark, folder, REGISTRY, batch)
    last = sightings.groupBy("bulletin_id").agg(F.max_by(F.struct("pdf_url", "seen"), "seq").alias("x")).select("bulletin_id", "x.pdf_url", "x.seen")
    touched = before.join(last.select("bulletin_id"), "bulletin_id", "left_semi")
    merged = registry_ops.upsert(touched, last, "")
    merged = merged.withColumns({"date_discovered": F.coalesce(F.nullif("date_discovered", F.lit("")), "seen"), "last_seen": F.col("seen")}).select(*before.columns)
    rest = before.join(last.select("bulletin_id"), "bulletin_id", "left_anti")
    versions.write(rest.unionByName(merged), folder, batch + 1)


def upsert_registry(sightings: DataFrame, folder: str, checkpoint: str) -> None:
    """Merge a stream of sightings(bulletin_id, pdf_url, seen, seq) into the registry; returns when all that is there has been merged."""
    query = sightings.writeStream.foreachBatch(lambda df, batch: merge_batch(df, batch, folder)).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry as of the last merged batch."""
    return versions.read(spark, folder, REGISTRY)
