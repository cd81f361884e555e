"""Registry of bulletins: idempotent upsert, append-only manifests, snapshots and incremental selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address, rules


def upsert(registry: DataFrame, found: DataFrame, today: str) -> DataFrame:
    """Registry after a look at the index, by bulletin_id: new rows enter, vanished ones stay and are flagged, the first date stays.

    registry: bulletin_id, pdf_url, date_discovered, last_seen, still_on_index, note, further columns of the index. found:
    bulletin_id, pdf_url, further columns; what the index says now replaces the old value. note gets one more
    `url_changed_from=` each time the address of a bulletin changes.
    """
    more = [c for c in found.columns if c not in ("bulletin_id", "pdf_url")]
    new = found.select(F.col("bulletin_id").alias("k"), F.col("pdf_url").alias("url"), *[F.col(c).alias(f"new_{c}") for c in more])
    df = registry.join(new, registry["bulletin_id"] == F.col("k"), "full_outer")
    seen, known = F.col("k").isNotNull(), F.col("bulletin_id").isNotNull()
    moved = seen & known & (F.col("pdf_url") != "") & (F.col("url") != F.col("pdf_url"))
    before, change = F.coalesce("note", F.lit("")), F.concat(F.lit("url_changed_from="), "pdf_url")
    return df.select(
        F.coalesce("bulletin_id", "k").alias("bulletin_id"), F.coalesce("url", "pdf_url").alias("pdf_url"), F.coalesce("date_discovered", F.lit(today)).alias("date_discovered"),
        F.when(seen, F.lit(today)).otherwise(F.col("last_seen")).alias("last_seen"), seen.alias("still_on_index"),
        F.when(moved & (before != ""), F.concat_ws("; ", before, change)).when(moved, change).otherwise(before).alias("note"),
        *[F.when(seen, F.col(f"new_{c}")).otherwise(F.col(c) if c in registry.columns else F.lit(None)).alias(c) for c in more],
        *[F.col(c) for c in registry.columns if c not in (*more, "bulletin_id", "pdf_url", "date_discovered", "last_seen", "still_on_index", "note")],
    )


def unprocessed(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been handled yet."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def to_geocode(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Distinct keys that are absent from the cache or failed there; cache(query_key, status)."""
    return wanted.select("query_key").distinct().join(cache.filter("not startswith(status, 'error')").select("query_key"), "query_key", "left_anti")


def pruned_cache(cache: DataFrame, fresh: DataFrame, wanted: DataFrame) -> DataFrame:
    """Cache of the wanted keys only; fresh rows replace old ones."""
    kept = cache.join(fresh.select("query_key"), "query_key", "left_anti").unionByName(fresh)
    return kept.join(wanted.select("query_key").distinct(), "query_key", "left_semi").orderBy("query_key")


def accept_geocode(answers: DataFrame) -> DataFrame:
    """query_key, status, bbl, bin, label, returned_number, returned_street of JSON answers: the first of five features that agrees.

    answers: query_key, borough, number, street, json with features[{properties{housenumber, street, county, label,
    addendum{pad{bbl, bin}}}}]. House numbers agree as parsed, streets in their canonical form, the county by its borough, and
    the feature must have a BBL. Without one that agrees, the first feature is shown as a mismatch.
    """
    shape = "struct<features:array<struct<properties:struct<housenumber:string,street:string,county:string,label:string,addendum:struct<pad:struct<bbl:string,bin:string>>>>>>"
    features = F.slice(F.from_json("json", shape)["features"], 1, 5)
    wanted = address.house_number(F.col("number"), F.col("borough"))["text"]
    df = answers.withColumns({"features": features, "hn": wanted, "way": address.canonical_street(F.col("street"))})

    def agrees(f: Column) -> Column:
        p = f["properties"]
        same = (address.house_number(p["housenumber"], F.col("borough"))["text"] == F.col("hn")) & (address.canonical_street(F.coalesce(p["street"], F.lit(""))) == F.col("way"))
        same &= address.lookup(rules.COUNTIES, p["county"]) == F.col("borough")
        return F.coalesce(same & (p["addendum"]["pad"]["bbl"] != ""), F.lit(False))

    hit = F.get(F.filter("features", agrees), F.lit(0))["properties"]
    df = df.withColumns({"hit": hit, "any": F.get("features", F.lit(0))["properties"]})
    status = F.when(F.col("hit").isNotNull(), "ok").when(F.coalesce(F.size("features"), F.lit(0)) > 0, "mismatch").otherwise("no_match")
    blank = lambda c: F.coalesce(c, F.lit(""))
    shown = lambda c: blank(F.coalesce(F.col(f"hit.{c}"), F.when(F.col("hit").isNull(), F.col(f"any.{c}"))))
    return df.select(
        "query_key", status.alias("status"), blank(F.col("hit.addendum.pad.bbl")).alias("bbl"), blank(F.col("hit.addendum.pad.bin")).alias("bin"), shown("label").alias("label"),
        shown("housenumber").alias("returned_number"), shown("street").alias("returned_street"),
    )


def latest_snapshot(manifest: DataFrame) -> DataFrame:
    """One row: the last retrieved file, and when it was first retrieved; manifest(seq, csv_file, retrieved_at)."""
    last = manifest.agg(F.max_by("csv_file", "seq").alias("csv_file"))
    first = manifest.groupBy("csv_file").agg(F.min_by("retrieved_at", "seq").alias("first_retrieved"))
    return first.join(last, "csv_file")


def snapshots(files: DataFrame, manifest: DataFrame, run_ts: str) -> DataFrame:
    """The manifest rows of retrieved files(dataset_id, updated, content): their name carries the date and the content's hash.

    Content that the manifest(sha256, csv_file, ...) has already keeps its first name and is `unchanged`; the manifest only grows.
    """
    hashed = files.select("dataset_id", "updated", F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("bytes"))
    before = manifest.groupBy("sha256").agg(F.min("csv_file").alias("known"))
    name = F.concat_ws("_", "dataset_id", "updated", F.concat(F.substring("sha256", 1, 8), F.lit(".csv")))
    df = hashed.join(before, "sha256", "left")
    status = F.when(F.col("known").isNull(), "downloaded").otherwise("unchanged")
    return df.select(F.lit(run_ts).alias("retrieved_at"), "dataset_id", "updated", "sha256", "bytes", F.coalesce("known", name).alias("csv_file"), status.alias("status"))


def new_content(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content hash the manifest does not have; files(path, content)."""
    hashed = files.withColumn("sha256", F.sha2("content", 256))
    return hashed.join(manifest.select("sha256").distinct(), "sha256", "left_anti")


def with_counts(registry: DataFrame, actions: DataFrame, diagnostics: DataFrame, run_ts: str) -> DataFrame:
    """Registry with the figures of the last parse: parsed, parsed_at (of the first parse), n_actions, n_matches, how the text was extracted, its pages and characters, errors.

    registry: bulletin_id, parsed, parsed_at, processing_errors. diagnostics: those of `segment.diagnose`. Of the old errors those of
    the download stay, of the new notes all but orphan lines. Bulletins without diagnostics keep what they have.
    """
    facts = {"extraction_method": "string", "page_count": "int", "text_chars": "int", "has_text_layer": "boolean"}
    registry = registry.withColumns({k: F.lit("" if kind == "string" else None).cast(kind) for k, kind in facts.items() if k not in registry.columns})
    linked = F.col("pops_relation").isin("pops_text_and_property_match", "pops_text_only", "property_match_only")
    per = actions.groupBy("bulletin_id").agg(F.count("*").alias("n_actions"), F.count_if(linked).alias("n_matches"))
    told = diagnostics.select("bulletin_id", "needs_ocr", "marker_found", "notes", F.col("extraction_method").alias("method"), "n_pages", "n_chars", F.lit(True).alias("diagnosed"))
    df = registry.join(told, "bulletin_id", "left").join(per, "bulletin_id", "left")
    seen, before = F.coalesce("diagnosed", F.lit(False)), (F.lower(F.col("parsed").cast("string")) == "true") & (F.col("parsed_at") != "")
    old = F.filter(F.split("processing_errors", "; "), lambda e: e.rlike("^(?:download_failed|pdf_replaced_upstream)(?::|$)|^url_changed"))
    notes = F.filter(F.coalesce("notes", F.array().cast("array<string>")), lambda n: ~n.startswith("orphan line"))
    missing = F.when(F.coalesce("marker_found", F.lit(True)), F.array().cast("array<string>")).otherwise(F.array(F.lit("structure_marker_missing")))
    return df.select(
        "bulletin_id", F.when(seen, ~F.coalesce("needs_ocr", F.lit(False))).otherwise(F.lower(F.col("parsed").cast("string")) == "true").alias("parsed"),
        F.when(seen & ~before, F.lit(run_ts)).otherwise(F.col("parsed_at")).alias("parsed_at"), F.when(seen, F.coalesce("n_actions", F.lit(0))).alias("n_actions"),
        F.when(seen, F.coalesce("n_matches", F.lit(0))).alias("n_matches"), F.when(seen, F.coalesce("method", F.lit(""))).otherwise(F.col("extraction_method")).alias("extraction_method"),
        F.when(seen, F.col("n_pages")).otherwise(F.col("page_count")).alias("page_count"), F.when(seen, F.col("n_chars")).otherwise(F.col("text_chars")).alias("text_chars"),
        F.when(seen, ~F.coalesce("needs_ocr", F.lit(False))).otherwise(F.col("has_text_layer")).alias("has_text_layer"), F.when(seen, F.array_join(F.concat(old, notes, missing), "; ")).otherwise(F.col("processing_errors")).alias("processing_errors"),
    )
