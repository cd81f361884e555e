"""What a run publishes: the end-to-end run from bulletins to actions, the public export, and the tables of the site history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import cut
from ..sources import versions
from . import analytics, resolve, segment

RELATIONS = ("pops_text_and_property_match", "pops_text_only", "property_match_only")

# The columns of the public export in order, and the names that differ from those of an action.
EXPORT_COLUMNS = (
    "enforcement_id", "pops_id", "pops_bbl", "pops_bin", "pops_address_normalized", "pops_borough", "pops_latitude", "pops_longitude",
    "pops_building_name", "pops_type", "pops_year_established", "pops_required_hours", "respondent", "respondent_role", "bulletin_month",
    "bulletin_year", "enforcement_date", "violation_category", "violation_description", "penalty_amount", "enforcement_text", "pdf_url",
    "source_pdf", "source_page", "match_method", "match_confidence", "match_score", "match_status", "match_notes", "pops_relation",
    "pops_keyword_tier", "pops_keyword_hits", "manual_review_status", "review_note", "possible_duplicate_of", "duplicate_basis",
    "violation_category_terms", "bulletin_id", "address_raw", "borough", "geocoded_bbl", "geocoded_bin",
)
EXPORT_NAMES = {
    "respondent": "owner", "respondent_role": "owner_role_as_stated", "pops_bbl": "bbl", "pops_bin": "bin", "pops_address_normalized": "normalized_address",
    "pops_borough": "pops_borough_master", "pops_latitude": "latitude", "pops_longitude": "longitude", "pops_building_name": "building_name",
}
SITE_FIELDS = {
    "pops_bbl": "bbl", "pops_bin": "bin", "pops_address_normalized": "address_normalized", "pops_borough": "borough", "pops_latitude": "latitude",
    "pops_longitude": "longitude", "pops_building_name": "building_name", "pops_type": "pops_type", "pops_year_established": "year_established",
    "pops_required_hours": "required_hours",
}
REQUIREMENTS = {
    "required_hours": "required_hours", "required_size": "required_size", "required_amenity": "required_amenities", "other_required": "other_requirements",
    "permitted_amenity": "permitted_amenities_text",
}


def with_site(actions: DataFrame, master: DataFrame, key: str = "enforcement_id") -> DataFrame:
    """Actions with the fields of the site they are linked to; blank for the others and for fields that the master lacks.

    The master is not broadcast, however small the optimiser takes it to be; actions without a site are dealt by their key to 64 keys that no site has.
    """
    have = {to: c for to, c in SITE_FIELDS.items() if c in master.columns}
    none = F.concat(F.lit("\0"), F.pmod(F.xxhash64(key), F.lit(64)).cast("string"))
    sites = master.select(F.col("pops_id").alias("_site"), *[F.col(c).cast("string").alias(to) for to, c in have.items()]).filter("_site <> ''")
    df = actions.withColumn("_own", F.coalesce(F.nullif("pops_id", F.lit("")), none)).join(sites.hint("merge"), F.col("_own") == F.col("_site"), "left").drop("_own", "_site")
    return df.withColumns({to: F.coalesce(F.col(to) if to in have else F.lit(None).cast("string"), F.lit("")) for to in SITE_FIELDS})


def export(actions: DataFrame) -> DataFrame:
    """The public export: linked or worded actions that no reviewer rejected, with all columns of EXPORT_COLUMNS; missing ones are blank."""
    own = actions.filter(F.col("pops_relation").isin(*RELATIONS) & (F.col("manual_review_status") != "reviewed_rejected"))
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in actions.columns else F.lit("")
    return own.select(*[value(c).alias(EXPORT_NAMES.get(c, c)) for c in EXPORT_COLUMNS])


def run(bulletins: DataFrame, master: DataFrame, geocodes: DataFrame, decisions: DataFrame, read: DataFrame | None = None) -> DataFrame:
    """Bulletins to reviewed actions: entries, fields, links, wording, categories, decisions, duplicates and site fields.

    bulletins: bulletin_id (YYYY-MM), pages, pdf_url, source_pdf. read: `segment.parse` of them, where it is at hand (for diagnostics, too). The result has one row per entry and what `export` and
    `review.record_issues` read.

    Texts are moved twice: to number the repeats of a bulletin, and to meet the outcome of their evidence. All else comes to that outcome (site
    fields, lists of sites) or is a small table beside the actions; what nobody reads, such as duplicates, is left out by Spark.
    """
    said, about = F.col("enforcement_text"), ("pdf_url", "source_pdf")
    rows = segment.split_entries(bulletins, keep=about) if read is None else segment.split_entries(bulletins, read).join(bulletins.select("bulletin_id", *about).hint("merge"), "bulletin_id")
    rows = rows.filter("bulletin_id is not null").withColumn("enforcement_text", segment.entry_text()).drop("lines")
    rows = segment.stable_ids(rows.withColumn("norm", text.normalised(said)), F.replace("bulletin_id", F.lit("-"), F.lit(""))).drop("norm")
    acts = segment.fields(cut(segment.with_spans(rows)))  # parsed once, read by all that follows
    found = with_site(resolve.outcomes(acts, master, geocodes), master, "alike")
    blank = text.blank_out(said, F.concat(F.transform("addresses", lambda a: a["raw"]), F.array("respondent")))
    acts = acts.withColumn("wording", text.detect(said, blank))
    tier = F.col("wording.tier")
    acts = acts.withColumns(
        {
            "pops_keyword_tier": tier, "pops_keyword_hits": F.array_join("wording.hits", ";"),
            "address_raw": F.coalesce("primary.raw", F.lit("")), "address_number": F.coalesce("primary.number", F.lit("")), "address_street": F.coalesce("primary.street", F.lit("")),
            "bulletin_year": F.substring("bulletin_id", 1, 4), "bulletin_month": F.substring("bulletin_id", 6, 2), "source_page": F.col("page"),
        }
    ).drop("wording")
    acts = segment.flag_duplicates(acts.withColumn("seq", F.struct("bulletin_id", "page", "entry"))).withColumn("possible_duplicate_of", F.col("duplicate_of")).drop("seq")
    acts = acts.join(given(decisions, master), "enforcement_id", "left")
    acts = resolve.in_words(acts.withColumn("alike", resolve.alike()).join(found.hint("merge"), "alike")).drop("alike", "look_for")
    matched, tier = F.col("match_status") == "matched", F.col("pops_keyword_tier")
    acts = acts.withColumns({"pops_relation": resolve.relation(tier, matched), "classes": F.when((tier != "") | matched, text.classify(said))})
    acts = acts.withColumns({"violation_category": F.coalesce(F.array_join("classes.categories", ";"), F.lit("")), "violation_category_terms": F.coalesce(F.when(F.size("classes.terms") > 0, F.to_json("classes.terms")), F.lit(""))})
    reviewed = resolve.decide_on(acts).withColumnRenamed("review_status", "manual_review_status")
    moved = F.col("match_method") == "manual"
    return reviewed.withColumns({c: F.when(moved, F.col(f"there.{c}")).otherwise(F.col(c)) for c in SITE_FIELDS}).drop("classes", "there")


FEW, SMALL = 50_000, 8 << 20  # decisions, and their bytes, that may go to every task


def given(decisions: DataFrame, master: DataFrame) -> DataFrame:
    """enforcement_id, d (its last decision) and there (the fields of the site that it names); sent to all tasks if it is small (counted first)."""
    last = with_site(resolve.last_decisions(decisions).withColumn("pops_id", F.col("d.to")), master)
    last = cut(last.select("enforcement_id", "d", F.struct(*SITE_FIELDS).alias("there")))
    n, size = last.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("d", "there")))), F.lit(0))).first()
    return last.hint("broadcast" if n <= FEW and size <= SMALL else "merge")


# The tables of the site history, their columns and types. The last four have no source yet and stay empty.
HISTORY = {
    "source_document": "source_id string, source_type string, title string, url string, retrieved_at string, sha256 string, local_path string",
    "pops_site": "pops_id string, borough string, address_normalized string, bbl string, bin string, latitude double, longitude double, building_name string, pops_type string, year_established int, developer string, current_status_note string, source_id string",
    "pops_requirement": "requirement_id bigint, pops_id string, requirement_type string, value_text string, valid_from string, valid_to string, source_id string",
    "enforcement_action": "enforcement_id string, pops_id string, bulletin_year int, bulletin_month int, enforcement_date string, respondent string, penalty_amount bigint, violation_category string, violation_description string, enforcement_text string, pops_relation string, match_method string, match_confidence string, manual_review_status string, source_pdf string, source_page int, pdf_url string",
    "comptroller_audit": "audit_row int, audit_id string, audit_date string, audit_address string, full_compliance_as_printed string, pops_id string, match_method string, match_confidence string, findings_text string, audit_pdf_page int",
    "pops_event": "event_id bigint, pops_id string, event_type string, event_date string, event_date_precision string, summary string, source_table string, source_key string, source_id string, confidence string",
    "dob_inspection": "inspection_id string, pops_id string, inspection_date string, inspection_result string, corrective_action string, compliance_status string, source_id string",
    "complaint_311": "complaint_id string, pops_id string, complaint_date string, complaint_category string, resolution string, status string, source_id string",
    "pops_modification": "modification_id string, pops_id string, modification_type string, approved_date string, effective_from string, effective_to string, description string, source_id string",
    "building_record": "record_id string, pops_id string, bin string, bbl string, record_type string, record_date string, description string, source_id string",
}
HISTORY_READS = {"owner", "bulletin_id", *(column.split(" ")[0] for column in HISTORY["enforcement_action"].split(", "))}  # columns of the export that `history` reads
MASTER_SOURCE = "master"


def shaped(df: DataFrame, schema: str, names: dict[str, str] | None = None) -> DataFrame:
    """df with the columns and types of a schema, some under another name in df; a column that df lacks is NULL, and so is a value that doesn't fit."""
    names, out = names or {}, []
    for column in schema.split(", "):
        to, kind = column.split(" ")
        have = names.get(to, to)
        value = F.col(have) if have in df.columns else F.lit(None)
        out.append((value.cast("string").try_cast(kind) if kind != "string" else value.cast("string")).alias(to))
    return df.select(*out)


def history(master: DataFrame, actions: DataFrame, audit: DataFrame, *, audit_id: str, inspected: str, about: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The tables of HISTORY by name.

    actions: the public export, with enforcement_id, bulletin_id, pdf_url and source_pdf. audit: audit_row, address, outcome, pops_id, method,
    confidence and, if there are any, findings and page. about: url, retrieved_at and sha256 of the master, audit_url. An event carries its date
    as far as it is known and the precision of that date. Surrogate ids are hashes of what they stand for, so a rebuild gives the same ones.
    """
    c, s = F.col, lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    spark, about = master.sparkSession, about or {}
    sites = master.withColumns({"current_status_note": F.lit(""), "source_id": F.lit(MASTER_SOURCE)})
    long = master.select("pops_id", *[(c(column).cast("string") if column in master.columns else F.lit("")).alias(kind) for kind, column in REQUIREMENTS.items()])
    long = long.unpivot("pops_id", list(REQUIREMENTS), "requirement_type", "value_text")
    needs = long.withColumn("value_text", F.trim("value_text")).filter("value_text <> ''").withColumns({"source_id": F.lit(MASTER_SOURCE), "requirement_id": F.xxhash64("pops_id", "requirement_type", "value_text")})
    acts = actions.filter("pops_id <> ''")
    blank = {k: F.nullif(F.col(k), F.lit("")) for k in ("pops_id", "findings") if k in audit.columns}
    printed = audit.withColumns(blank | {"audit_id": F.lit(audit_id), "audit_date": F.lit(inspected)})
    linked = audit.filter("pops_id <> ''")
    kinds = ("pops_id", "event_type", "event_date", "event_date_precision", "summary", "source_table", "source_key", "source_id", "confidence")

    def event(df: DataFrame, *values) -> DataFrame:
        return df.select(*[(F.lit(v) if isinstance(v, str) else v).cast("string").alias(k) for k, v in zip(kinds, values, strict=True)])

    built = c("year_established").try_cast("int")
    made = event(sites.filter(built.isNotNull()), c("pops_id"), "agreement", built, "year", s("building completed ", built), "pops_site", c("pops_id"), MASTER_SOURCE, "high")
    seen = event(linked, c("pops_id"), "audit_inspection", F.lit(inspected), "year", s("audit ", audit_id, ": ", c("outcome")), "comptroller_audit", c("audit_row"), audit_id, c("confidence"))
    sure = F.when(c("manual_review_status").isin(*analytics.CONFIRMED), "high").otherwise("needs_review")
    said = s("[", c("pops_relation"), "] ", F.coalesce(F.nullif("violation_category", F.lit("")), F.lit("uncategorised")), "; $", F.coalesce(F.nullif(c("penalty_amount").cast("string"), F.lit("")), F.lit("?")), "; ", F.substring("enforcement_text", 1, 140))
    month = F.concat_ws("-", "bulletin_year", F.lpad(c("bulletin_month").cast("string"), 2, "0"))
    done = event(acts, c("pops_id"), "enforcement", month, "month", said, "enforcement_action", c("enforcement_id"), s("bulletin_", c("bulletin_id")), sure)
    events = made.unionByName(seen).unionByName(done)
    events = events.withColumn("event_id", F.xxhash64("source_table", "source_key", "event_type", "pops_id"))
    first = acts.groupBy("bulletin_id").agg(F.min_by(F.struct("pdf_url", "source_pdf"), "enforcement_id").alias("x"))
    papers = first.select(s("bulletin_", c("bulletin_id")).alias("source_id"), F.lit("bulletin").alias("source_type"), s("monthly bulletin ", c("bulletin_id")).alias("title"), c("x.pdf_url").alias("url"), F.lit("").alias("retrieved_at"), F.lit("").alias("sha256"), c("x.source_pdf").alias("local_path"))
    known = [(MASTER_SOURCE, "master", "site master", *[about.get(k, "") for k in ("url", "retrieved_at", "sha256", "path")]), (audit_id, "audit", "audit report", about.get("audit_url", ""), "", "", about.get("audit_path", ""))]
    found = {
        "source_document": spark.createDataFrame(known, HISTORY["source_document"]).unionByName(papers), "pops_site": sites, "pops_requirement": needs,
        "enforcement_action": acts, "comptroller_audit": printed, "pops_event": events,
    }
    names = {
        "enforcement_action": {"respondent": "owner" if "owner" in acts.columns else "respondent"},
        "comptroller_audit": {"audit_address": "address", "full_compliance_as_printed": "outcome", "match_method": "method", "match_confidence": "confidence", "findings_text": "findings", "audit_pdf_page": "page"},
    }
    return {name: shaped(found[name], schema, names.get(name)) if name in found else spark.createDataFrame([], schema) for name, schema in HISTORY.items()}


TIMELINE = "pops_id, event_date, event_date_precision, event_type, summary, source_table, source_key, confidence"
SORTED = {"pops_event": ["pops_id", "event_date"], "enforcement_action": ["pops_id", "enforcement_id"], "pops_site": ["pops_id"], "pops_requirement": ["pops_id"]}


def store(tables: dict[str, DataFrame], home: str, database: str = "history", *, buckets: int = 8) -> None:
    """Write the tables of `history` to the catalog: bucketed by site and sorted, each behind a view of its name, with the view pops_timeline.

    A build writes tables of its own beside those of the build before and then turns the views over, one statement a table, so a reader
    sees a table as it was or as it is; a build that dies leaves the views alone. What the views no longer show is dropped.
    """
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{home}'")
    build = 1 + max([0, *(n for name in tables for n in versions.numbers(spark, f"{home}/{name}"))])
    for name, df in tables.items():
        writer = df.write.format("parquet").mode("overwrite").option("path", versions.path_of(f"{home}/{name}", build))
        if name in SORTED:
            writer = writer.bucketBy(buckets, "pops_id").sortBy(*SORTED[name])
        writer.saveAsTable(f"{database}.{name}_v{build}")
    for name in tables:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {database}.{name}_v{build}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.pops_timeline AS SELECT {TIMELINE} FROM {database}.pops_event_v{build} ORDER BY pops_id, event_date")
    for name in tables:
        for n in versions.numbers(spark, f"{home}/{name}"):
            if n < build:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_v{n}")
                versions.drop(spark, f"{home}/{name}", n)


def timeline(events: DataFrame) -> DataFrame:
    """The view over pops_event: one row per event in the order of site and date."""
    return events.select("pops_id", "event_date", "event_date_precision", "event_type", "summary", "source_table", "source_key", "confidence").orderBy("pops_id", "event_date")
