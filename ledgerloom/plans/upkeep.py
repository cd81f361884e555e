"""Queries of upkeep: changed and broken files, the streamed registry, stored history, content by hash, documents in parts, the analysis set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics, master, publish
from ..session import cut, scratch
from ..session import table as T
from ..sources import changes, readers, snapshots
from ..streaming import incremental
from .actions import ACTIONS_SQL, actions
from .linking import BOROUGH_SQL, CANONICAL, _public, _sites

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""WITH d AS (SELECT doc_id AS k, CAST(octet_length(encode(text)) AS BIGINT) AS n, sha256(text) AS h FROM documents)
SELECT 'd/' || k || '.json' AS path, n AS size, 'u' || k % 2 AS modified, h AS sha256, CASE WHEN k % 7 = 0 THEN 'new' WHEN k % 3 <> 0 AND k % 2 = 0 THEN 'unchanged' WHEN k % 5 = 0 THEN 'touched' ELSE 'changed' END AS status FROM d WHERE k % 11 <> 0
UNION ALL SELECT 'd/' || k || '.json', n - CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END, 'u0', CASE WHEN k % 5 = 0 OR (k % 3 <> 0 AND k % 2 = 0) THEN h ELSE 'old' END, 'removed' FROM d WHERE k % 11 = 0 AND k % 7 <> 0""")
def file_changes(spark, d) -> DataFrame:
    """Documents as files: some new, some gone, some of another size or time than the state says, of which every fifth has its old content."""
    k, n, h = F.col("doc_id"), F.octet_length("text").cast("long"), F.sha2("text", 256)
    path = F.concat(F.lit("d/"), k.cast("string"), F.lit(".json")).alias("path")
    docs = T(spark, d, "documents")
    found = docs.filter(k % 11 != 0).select(path, n.alias("size"), F.concat(F.lit("u"), (k % 2).cast("string")).alias("modified"))
    same = (k % 5 == 0) | ((k % 3 != 0) & (k % 2 == 0))
    state = docs.filter(k % 7 != 0).select(path, (n - F.when(k % 3 == 0, 1).otherwise(0)).alias("size"), F.lit("u0").alias("modified"), F.when(same, h).otherwise("old").alias("sha256"))
    seen = changes.compare(found, state)
    hashed = docs.select(path, h.alias("sha256")).join(seen.filter("kind in ('new', 'suspect')").select("path"), "path", "left_semi")
    return changes.settle(seen, hashed)


@query("""SELECT CAST(doc_id AS VARCHAR) AS bulletin_id, CASE doc_id % 6 WHEN 1 THEN 'corrupt' WHEN 2 THEN 'no_text' WHEN 3 THEN 'unreadable' WHEN 4 THEN 'corrupt' ELSE CASE WHEN trim(text) = '' THEN 'no_text' ELSE 'ok' END END AS status,
CASE WHEN doc_id % 6 IN (0, 5) AND trim(text) <> '' THEN md5(text) ELSE '' END AS page FROM documents""")
def quarantined_files(spark, d) -> DataFrame:
    """Documents as extracted text files: whole ones, cut ones, one without a text layer, one without content, one of other bytes."""
    k = F.col("doc_id")
    doc = F.to_json(F.struct(F.lit("m").alias("method"), F.array("text").alias("pages"), F.lit(1).alias("n_pages"), F.length("text").alias("n_chars"), F.array().cast("array<string>").alias("errors"), (k % 6 != 2).alias("has_text_layer")))
    content = F.when(k % 6 == 1, F.substring(doc, F.lit(1), F.length(doc) - 1).cast("binary")).when(k % 6 == 4, F.unhex(F.lit("fffe7b7d"))).when(k % 6 != 3, doc.cast("binary"))
    files = T(spark, d, "documents").select(F.concat(F.lit("s/"), k.cast("string"), F.lit(".json")).alias("path"), content.alias("content"))
    return readers.checked(files).select("bulletin_id", "status", F.coalesce(F.md5(F.get("pages", F.lit(0))), F.lit("")).alias("page"))


@query("""SELECT 'b' || o_custkey AS bulletin_id, arg_max('u' || o_orderkey % 3, o_orderkey) AS pdf_url, CAST(count(*) > 0 AS BOOLEAN) AS still_on_index FROM orders GROUP BY o_custkey""")
def registry_stream(spark, d) -> DataFrame:
    """Orders as a stream of sightings of customers' pages, merged batch by batch into the versioned registry."""
    home = scratch(spark, "registry")
    kept = T(spark, d, "orders")
    kept.repartitionByRange(3, "o_orderkey").write.parquet(f"{home}/in")  # a file of its own is needed, as a stream reads folders
    stream = spark.readStream.schema(kept.schema).parquet(f"{home}/in")
    key = F.col("o_orderkey")
    sightings = stream.select(F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("bulletin_id"), F.concat(F.lit("u"), (key % 3).cast("string")).alias("pdf_url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"), key.alias("seq"))
    incremental.upsert_registry(sightings, f"{home}/registry", f"{home}/state")
    return incremental.registry(spark, f"{home}/registry").select("bulletin_id", "pdf_url", "still_on_index")


_ACTS_SQL = "a AS (SELECT *, CAST(enforcement_id AS VARCHAR) AS id FROM acts WHERE pops_relation IN ('pops_text_and_property_match', 'pops_text_only', 'property_match_only') AND review_status <> 'reviewed_rejected')"


@query(f"""WITH {ACTIONS_SQL}, {_ACTS_SQL}, e AS (SELECT pops_id, ym AS d FROM a UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST(1950 + c_custkey % 60 AS VARCHAR) FROM customer WHERE c_custkey % 9 <> 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), '2016' FROM supplier WHERE s_suppkey % 2 = 0) SELECT pops_id, count(*) AS events, min(d) AS first, max(d) AS last, count(DISTINCT 'x') AS builds FROM e GROUP BY pops_id""")
def history_store(spark, d) -> DataFrame:
    """The history written to the catalog twice; events a site from the stored, bucketed table."""
    k = F.col("s_suppkey").cast("string")
    rows = T(spark, d, "supplier").select(F.col("s_suppkey").alias("audit_row"), F.lit("no").alias("outcome"), F.when(F.col("s_suppkey") % 2 == 0, k).otherwise("").alias("pops_id"), F.lit("high").alias("confidence"))
    sites = cut(_sites(spark, d))  # read by several tables, as the actions are
    acts = _public(spark, d, sites)
    acts = cut(acts.select(*[c for c in acts.columns if c in publish.HISTORY_READS]))
    tables = publish.history(sites.withColumnRenamed("year", "year_established"), acts, rows, audit_id="A1", inspected="2016")
    home = scratch(spark, "history")
    name = f"history_{home.rpartition('-')[2]}"
    for _ in range(2):
        publish.store(tables, home, name)
    events = spark.table(f"{name}.pops_event")
    return events.groupBy("pops_id").agg(F.count("*").alias("events"), F.min("event_date").alias("first"), F.max("event_date").alias("last"), F.lit(1).cast("long").alias("builds"))


@query("""WITH e AS (SELECT event_type || event_id // 4 AS content, 'd' || event_id AS dataset_id, strftime(ts, '%Y-%m-%d') AS updated FROM events), f AS (SELECT sha256(content) AS sha256, dataset_id || '_' || updated || '_' || left(sha256(content), 8) || '.csv' AS name, content FROM e)
SELECT sha256, min(name) AS csv_file, count(*) AS retrievals, min(md5(content)) AS stored FROM f GROUP BY sha256""")
def content_store(spark, d) -> DataFrame:
    """Events as retrieved files, of which up to four have one content, stored under their hash."""
    content = F.concat("event_type", F.floor(F.col("event_id") / 4).cast("string"))
    files = T(spark, d, "events").select(F.concat(F.lit("d"), F.col("event_id").cast("string")).alias("dataset_id"), F.date_format("ts", "yyyy-MM-dd").alias("updated"), content.alias("content"))
    home = scratch(spark, "content")
    rows = snapshots.commit(files, home, "t1")
    held = snapshots.contents(spark, home).select("sha256", F.md5("content").alias("stored"))
    return rows.groupBy("sha256").agg(F.min("csv_file").alias("csv_file"), F.count("*").alias("retrievals")).join(held, "sha256")


@query("""WITH k AS (SELECT l_suppkey AS site, l_orderkey * 10 + l_linenumber AS seq, l_linestatus AS status, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey * 10 + l_linenumber, l_linestatus) - 1 AS n FROM lineitem),
p AS (SELECT site, n // 100 AS part, count(*) AS n, md5(string_agg(seq || ':' || status, ';' ORDER BY seq, status)) AS e FROM k GROUP BY 1, 2)
SELECT s_suppkey AS site, CAST(coalesce(part, 0) AS INTEGER) AS part, CAST(coalesce(max(part) OVER (PARTITION BY site) + 1, 1) AS INTEGER) AS parts, coalesce(n, 0) AS n, coalesce(e, md5('')) AS e FROM supplier LEFT JOIN p ON site = s_suppkey""")
def nested_site_parts(spark, d) -> DataFrame:
    """Suppliers with their order lines in parts of a hundred."""
    kids = T(spark, d, "lineitem").select(F.col("l_suppkey").alias("site"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_linestatus").alias("status"))
    df = master.nested_parts(T(spark, d, "supplier").select(F.col("s_suppkey").alias("site")), kids, "site", "seq", ["status"], size=100)
    said = F.array_join(F.transform("e", lambda x: F.concat_ws(":", x["seq"].cast("string"), x["status"])), ";")
    return df.select("site", "part", "parts", F.size("e").cast("long").alias("n"), F.md5(said).alias("e"))


SITES_SQL = """sites AS (SELECT CAST(c_custkey AS VARCHAR) AS pops_id, CAST(c_nationkey AS VARCHAR) AS borough, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE CAST(1950 + c_custkey % 60 AS VARCHAR) END AS year_established FROM customer),
audit AS (SELECT s_suppkey AS audit_row, CAST(s_suppkey * 3 AS VARCHAR) AS pops_id, CASE s_suppkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Construction' END AS outcome FROM supplier)"""


def _accounts(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Sites, actions, audit rows and accounts: customers, orders, suppliers (each about the customer of three times its key)."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    sites = T(spark, d, "customer").select(k.cast("string").alias("pops_id"), F.col("c_nationkey").cast("string").alias("borough"), F.when(k % 9 == 0, "").otherwise((k % 60 + 1950).cast("string")).alias("year_established"))
    acts = actions(spark, d).withColumn("enforcement_id", F.col("enforcement_id").cast("string"))
    audit = T(spark, d, "supplier").select(s.alias("audit_row"), (s * 3).cast("string").alias("pops_id"), F.when(s % 3 == 0, "Yes").when(s % 3 == 1, "No").otherwise("Construction").alias("outcome"), F.concat(F.lit("seen "), s.cast("string")).alias("findings"), F.when(s % 2 == 0, "high").otherwise("low").alias("confidence"))
    return sites, acts, audit, analytics.accountability(sites, acts, audit)


FOLLOWED_SQL = """t AS (SELECT pops_id, bool_or(tier = 'A') AS a, bool_or(tier IN ('A', 'B')) AS ab, count(*) AS n FROM tiered WHERE tier IS NOT NULL GROUP BY pops_id), fo AS (SELECT s.*, coalesce(lower(u.outcome), 'not_in_audit') AS audit_group, coalesce(a, false) AS a, coalesce(ab, false) AS ab, coalesce(n, 0) AS n
FROM sites s LEFT JOIN t USING (pops_id) LEFT JOIN audit u USING (pops_id)), de AS (SELECT *, CASE WHEN try_cast(year_established AS INTEGER) BETWEEN 1961 AND 1969 THEN 'old' WHEN try_cast(year_established AS INTEGER) BETWEEN 1970 AND 1979 THEN 'old' WHEN try_cast(year_established AS INTEGER) >= 1980 THEN 'new' ELSE 'unknown' END AS age FROM fo)"""


@query(f"""WITH {ACTIONS_SQL}, {SITES_SQL}, {FOLLOWED_SQL} SELECT 'audit' AS kind, audit_group AS key, count(*) AS sites, count(*) FILTER (a) AS n_a, count(*) FILTER (ab) AS n_ab, count(*) FILTER (n > 0) AS n_any FROM fo GROUP BY audit_group
UNION ALL SELECT 'borough', borough, count(*), CAST(coalesce(sum(n_a), 0) AS BIGINT), count(*) FILTER (n_a > 0), NULL FROM sites LEFT JOIN (SELECT pops_id, count(*) AS n_a FROM tiered WHERE tier = 'A' GROUP BY 1) USING (pops_id) GROUP BY borough
UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(DISTINCT ym), count(*) FILTER (tier = 'A'), count(*) FILTER (tier = 'B'), count(*) FILTER (tier = 'C') FROM tiered GROUP BY year""")
def analysis_tables(spark, d) -> DataFrame:
    """Three of the tables of the analysis set, under common column names."""
    sites, acts, _, accounts = _accounts(spark, d)
    acts = acts.withColumns({"respondent": F.concat(F.lit("Holder "), "pops_id"), "categories": F.array(F.lit("other"))})
    bulletins = acts.select(F.col("ym").alias("bulletin_id")).distinct()
    made = analytics.tables(acts, sites, accounts, bulletins)
    shown = lambda name, kind, *cols: made[name].select(F.lit(kind).alias("kind"), *[(F.lit(None).cast("long") if c is None else F.col(c).cast("string" if k == 0 else "long")).alias(to) for k, (c, to) in enumerate(zip(cols, ("key", "sites", "n_a", "n_ab", "n_any"), strict=True))])
    out = shown("q10_audit_followup", "audit", "audit_group", "sites", "tierA", "tierAB", "any_linked")
    out = out.unionByName(shown("q8_borough", "borough", "borough", "sites", "tierA_actions", "tierA_sites", None))
    return out.unionByName(shown("q7_by_year", "year", "year", "bulletins", "tierA_actions", "tierB_actions", "tierC_actions"))


@query(f"""WITH {ACTIONS_SQL}, {SITES_SQL}, {FOLLOWED_SQL}, w AS (SELECT max(ym) AS last FROM acts WHERE pops_relation IN ('pops_text_and_property_match', 'pops_text_only')) SELECT (SELECT count(DISTINCT ym) FROM acts) AS bulletins, (SELECT min(ym) || ' to ' || max(ym) FROM acts) AS span,
(SELECT count(*) FROM t WHERE n >= 2) AS repeat_sites, (SELECT count(*) FROM (SELECT pops_id FROM tiered WHERE tier = 'A' GROUP BY 1 HAVING count(*) >= 2)) AS repeat_entities, w.last AS last_wording, (SELECT count(DISTINCT ym) FROM acts WHERE ym > w.last) AS bulletins_after,
count(*) FILTER (age = 'old' AND a) AS q9_old_with_a, count(*) FILTER (age = 'old') AS q9_old, count(*) FILTER (age = 'new' AND a) AS q9_new_with_a, count(*) FILTER (age = 'new') AS q9_new,
count(*) FILTER (audit_group = 'no') AS q10_no, count(*) FILTER (audit_group = 'no' AND a) AS q10_no_a, count(*) FILTER (audit_group = 'yes') AS q10_yes, count(*) FILTER (audit_group = 'yes' AND a) AS q10_yes_a, count(*) FILTER (audit_group = 'no' AND ab) AS q10_no_ab,
CAST(0 AS BIGINT) AS audit_unlinked_rows, (SELECT string_agg(outcome || ':' || n, ';' ORDER BY outcome) FROM (SELECT outcome, count(*) AS n FROM audit GROUP BY outcome)) AS audit_status_counts, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS review_open FROM de, w GROUP BY w.last""")
def full_summary(spark, d) -> DataFrame:
    """The figures of the summary beyond the tiers' own."""
    _, acts, audit, accounts = _accounts(spark, d)
    worded = F.col("pops_relation").isin("pops_text_and_property_match", "pops_text_only")
    acts = acts.withColumns({"respondent": F.concat(F.lit("Holder "), "pops_id"), "duplicate_of": F.lit(""), "pops_keyword_tier": F.when(worded, "strong").otherwise("")})
    bulletins = acts.select(F.col("ym").alias("bulletin_id")).distinct()
    issues = T(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "open").otherwise("resolved").alias("status"))
    out = analytics.full_summary(acts, accounts, bulletins, audit, issues)
    counts = F.array_join(F.transform(F.map_entries("audit_status_counts"), lambda x: F.concat_ws(":", x["key"], x["value"].cast("string"))), ";")
    names = ("bulletins", "span", "repeat_sites", "repeat_entities", "last_wording", "bulletins_after", "q9_old_with_a", "q9_old", "q9_new_with_a", "q9_new", "q10_no", "q10_no_a", "q10_yes", "q10_yes_a", "q10_no_ab", "audit_unlinked_rows", "review_open")
    return out.select(*names, counts.alias("audit_status_counts"))


@query(f"""WITH s AS (SELECT c_custkey AS k, {BOROUGH_SQL} AS borough, CAST(c_custkey % 900 + 1 AS VARCHAR) AS num, {CANONICAL} AS street, CAST(1000000000 + c_custkey AS VARCHAR) AS bbl FROM customer),
w AS (SELECT borough, num, street, list_sort(list(CAST(k AS VARCHAR))) AS own, list_sort(list(CAST(k AS VARCHAR)) FILTER (k % 2 = 0)) AS told, string_agg(bbl, ';' ORDER BY bbl) FILTER (k % 2 = 0) AS bbls FROM s GROUP BY 1, 2, 3),
a AS (SELECT o_orderkey AS o, strftime(o_orderdate, '%Y-%m') || '-' || k AS bulletin_id, w.*, k, CAST(o_orderkey % 30 * 1000 + 1500 AS VARCHAR) AS amount, CASE k % 5 WHEN 0 THEN 'East ' || (k % 89 + 4) || ' Street' WHEN 1 THEN 'West ' || (k % 89 + 4) || ' Street' WHEN 2 THEN '6 Avenue' WHEN 3 THEN '23 Street' ELSE 'Park Avenue South' END AS said
FROM orders JOIN s ON k = o_custkey JOIN w ON w.borough = s.borough AND w.num = s.num AND w.street = s.street),
m AS (SELECT *, CASE WHEN told IS NULL THEN own ELSE told END AS ids, '$' || amount || ' in total penalties issued to Holder ' || k || ' LLC, the owner of ' || num || ' ' || said || ', ' || borough || ', for a shut public plaza, case ' || o || '.' AS text FROM a)
SELECT 'EA-' || replace(bulletin_id, '-', '') || '-' || left(sha1(trim(regexp_replace(lower(text), '[^a-z0-9$]+', ' ', 'g'))), 10) AS enforcement_id, CASE WHEN len(ids) = 1 THEN ids[1] ELSE '' END AS pops_id, CASE WHEN len(ids) = 1 THEN CAST(1000000000 + CAST(ids[1] AS BIGINT) AS VARCHAR) ELSE '' END AS bbl,
'Holder ' || k || ' LLC' AS owner, amount AS penalty_amount, CASE WHEN told IS NULL THEN 'address_exact' ELSE 'bbl' END AS match_method, CASE WHEN len(ids) = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status,
CASE WHEN told IS NULL THEN 'not confirmed by the geocoder (not_geocoded)' ELSE 'bbl via geocode; address agrees too' END || CASE WHEN len(ids) > 1 THEN '; ' || len(ids) || ' candidates at level ' || CASE WHEN told IS NULL THEN 'address_exact' ELSE 'bbl' END ELSE '' END AS match_notes,
coalesce(bbls, '') AS geocoded_bbl, CASE WHEN told IS NULL THEN '' ELSE '2000000' END AS geocoded_bin, CASE WHEN len(ids) = 1 THEN 'pops_text_and_property_match' ELSE 'pops_text_only' END AS pops_relation,
CASE WHEN len(ids) = 1 THEN 'auto_confirmed' ELSE 'needs_review' END AS manual_review_status, bulletin_id, '1' AS source_page, num || ' ' || said AS address_raw FROM m""")
def bulletins_to_export(spark, d) -> DataFrame:
    """The whole run: orders as entries of monthly bulletins about a customer's site, parsed, linked, worded, reviewed and exported.

    The geocoder knows the addresses of customers of even keys; customers may share an address.
    """
    c = F.col
    sites = cut(_sites(spark, d))
    street = F.initcap(F.lower("street_canonical"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a few bytes an order become pages of text, which adaptive execution does not see
    orders = T(spark, d, "orders").repartition(tasks, "o_custkey").join(sites.hint("merge"), c("o_custkey") == c("pops_id").cast("long"))
    amount = lambda k: (k % 30 * 1000 + 1500).cast("string")
    said = lambda k: F.concat(F.lit("\n• $"), amount(k), F.lit(" in total penalties issued to Holder "), c("pops_id"), F.lit(" LLC, the owner of "), c("num"), F.lit(" "), street, F.lit(", "), c("borough"), F.lit(", for a shut\npublic plaza, case "), k.cast("string"), F.lit("."))
    per = orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "pops_id", "borough", "num", "street_canonical").agg(F.collect_list("o_orderkey").alias("own"))  # where the join left them
    per = per.select(F.concat_ws("-", "month", "pops_id").alias("bulletin_id"), "borough", F.array_join(F.array_sort(F.transform("own", said)), "").alias("entries"))
    page = F.concat(F.lit("These are the individual enforcement highlights for\nMay 2024:\n"), c("borough"), c("entries"))
    made = per.select("bulletin_id", F.array(page).alias("pages"), F.lit("u").alias("pdf_url"), F.lit("p").alias("source_pdf"))
    geocodes = sites.filter(c("pops_id").cast("long") % 2 == 0).select(c("address_key").alias("query_key"), "bbl", F.lit("2000000").alias("bin"), F.lit("ok").alias("status"))
    none = spark.createDataFrame([], "enforcement_id string, seq int, decision string, pops_id string, note string")
    out = publish.export(publish.run(made, sites, geocodes, none))
    return out.select("enforcement_id", "pops_id", "bbl", "owner", "penalty_amount", "match_method", "match_status", "match_notes", "geocoded_bbl", "geocoded_bin", "pops_relation", "manual_review_status", "bulletin_id", "source_page", "address_raw")
