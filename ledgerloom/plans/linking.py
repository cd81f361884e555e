"""Queries of linking: match hierarchy, range and fuzzy joins, overlays, registries, audit links, candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address
from ..operators import audit, joins, master, publish, registry_ops, resolve, review
from ..session import cut
from ..session import table as T
from .actions import ACTIONS_SQL, actions, streets

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


NUMBER, WRITTEN, CANONICAL = streets("c_custkey")
WRITTEN_NUMBER = "CAST(c_custkey % 89 + 4 AS VARCHAR)"
BOROUGH_SQL = "CASE c_nationkey % 5 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Bronx' WHEN 2 THEN 'Brooklyn' WHEN 3 THEN 'Queens' ELSE 'Staten Island' END"


def _spark(sql: str) -> str:
    """The expression in Spark's name for text."""
    return sql.replace("AS VARCHAR", "AS STRING")


def _sites(spark, d) -> DataFrame:
    """Customers as a site master with generated addresses."""
    df = T(spark, d, "customer").selectExpr(
        "cast(c_custkey as string) as pops_id", f"{BOROUGH_SQL} as borough", f"{_spark(NUMBER)} as num", f"{_spark(WRITTEN)} as street", "c_name as building_name",
        "cast(1000000000 + c_custkey as string) as bbl", "cast(case when c_custkey % 10 = 0 then 1000000 else 2000000 + c_custkey end as string) as bin",
        "case when c_custkey % 9 = 0 then '0' else cast(1950 + c_custkey % 60 as string) end as year",
    )
    return master.normalise(df)


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS pops_id, CAST(1000000000 + c_custkey AS VARCHAR) AS bbl, CAST(CASE WHEN c_custkey % 10 = 0 THEN 1000000 ELSE 2000000 + c_custkey END AS VARCHAR) AS bin, c_custkey % 10 = 0 AS bin_is_placeholder,
CASE WHEN c_custkey % 9 = 0 THEN '' ELSE CAST(1950 + c_custkey % 60 AS VARCHAR) END AS year, {CANONICAL} AS street_canonical, {BOROUGH_SQL} || '|' || {NUMBER} || '|' || {CANONICAL} AS address_key FROM customer""")
def master_normalise(spark, d) -> DataFrame:
    return _sites(spark, d).select("pops_id", "bbl", "bin", "bin_is_placeholder", "year", "street_canonical", "address_key")


@query(f"""SELECT c_custkey, {CANONICAL} AS street FROM customer""")
def canonical_street(spark, d) -> DataFrame:
    df = T(spark, d, "customer").selectExpr("c_custkey", f"{_spark(WRITTEN)} as written")
    return df.select("c_custkey", address.canonical_street(F.col("written")).alias("street"))


@query("""WITH h AS (SELECT c_custkey AS k, c_custkey % 900 + 100 AS lo, c_custkey % 50 + 1 AS more FROM customer)
SELECT k, CASE k % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'range' WHEN 2 THEN 'queens' ELSE 'range' END AS kind,
CAST(CASE k % 4 WHEN 2 THEN lo * 1000 + more ELSE lo END AS INTEGER) AS low,
CAST(CASE k % 4 WHEN 0 THEN lo WHEN 1 THEN lo + more WHEN 2 THEN lo * 1000 + more ELSE lo // 10 * 10 + 9 END AS INTEGER) AS high FROM h""")
def house_number(spark, d) -> DataFrame:
    written = "case c_custkey % 4 when 0 then concat(lo, 'A') when 1 then concat(lo, ' - ', lo + more) when 2 then concat(lo, '-', more) else concat(lo, '-9') end"
    df = T(spark, d, "customer").selectExpr("c_custkey", "c_custkey % 900 + 100 as lo", "c_custkey % 50 + 1 as more").selectExpr("c_custkey as k", f"{written} as raw", "case when c_custkey % 4 = 2 then 'Queens' else 'Bronx' end as b")
    hn = address.house_number(F.col("raw"), F.col("b"))
    return df.select("k", hn["kind"].alias("kind"), hn["low"].alias("low"), hn["high"].alias("high"))


_SITES_SQL = f"""s AS (SELECT c_custkey AS k, {BOROUGH_SQL} AS borough, c_custkey % 900 + 1 AS num, {CANONICAL} AS street FROM customer)"""


MISSPELT = f"CASE c_custkey % 5 WHEN 0 THEN 'East ' || {WRITTEN_NUMBER} || 'th Stret' WHEN 1 THEN 'West ' || {WRITTEN_NUMBER} || ' Stret' WHEN 2 THEN '6 Avenu' WHEN 3 THEN '23 Stret' ELSE 'Park Avenue' END"


@query(f"""WITH s AS (SELECT c_custkey AS k, {BOROUGH_SQL} AS borough, c_custkey % 900 + 1 AS num, {CANONICAL} AS street, {MISSPELT} AS misspelt, CASE c_custkey % 5 WHEN 0 THEN 'EAST ' || {WRITTEN_NUMBER} || ' STRET' WHEN 1 THEN 'WEST ' || {WRITTEN_NUMBER} || ' STRET'
WHEN 2 THEN '6 AVENU' WHEN 3 THEN '23 STRET' ELSE 'PARK AVENUE' END AS wrong FROM customer), a AS (SELECT o_orderkey AS id, o_orderkey % 7 AS kind, s.* FROM orders JOIN s ON k = o_custkey),
hits AS (SELECT id, 1 AS level, k AS site FROM a WHERE kind IN (0, 4)
UNION ALL SELECT id, 2, k FROM a WHERE kind = 1 AND k % 10 <> 0
UNION ALL SELECT a.id, CASE kind WHEN 5 THEN 4 WHEN 6 THEN 5 ELSE 3 END, s.k FROM a JOIN s ON s.borough = a.borough AND s.street = a.street AND s.num BETWEEN a.num AND a.num + CASE kind WHEN 5 THEN 2 ELSE 0 END WHERE kind IN (1, 2, 6) OR (kind = 5 AND a.borough <> 'Queens')),
best AS (SELECT id, min(level) AS level FROM hits GROUP BY id), per AS (SELECT h.id, h.level, list_sort(list(DISTINCT CAST(site AS VARCHAR))) AS ids FROM hits h JOIN best b ON h.id = b.id AND h.level = b.level GROUP BY 1, 2),
m AS (SELECT a.*, level, ids, CASE level WHEN 1 THEN 'bbl' WHEN 2 THEN 'bin' WHEN 3 THEN 'address_exact' WHEN 4 THEN 'address_range' WHEN 5 THEN 'address_fuzzy' ELSE 'none' END AS method,
CASE level WHEN 1 THEN CASE kind WHEN 0 THEN 'bbl via text' ELSE 'bbl via geocode' END WHEN 2 THEN 'bin via text' WHEN 3 THEN 'not confirmed by the geocoder (not_geocoded)' WHEN 4 THEN 'number ranges overlap'
WHEN 5 THEN CASE WHEN k % 5 = 4 THEN 'one compass word more or less' ELSE 'street name alike by ' || CAST(round(200.0 * length(wrong) / (length(wrong) + length(street))) AS INTEGER) END || ' (''' || misspelt || ''' ~ ''' || street || ''')'
ELSE CASE WHEN kind IN (0, 3) THEN 'no address to look up' ELSE 'no site at this address' END END AS note FROM a LEFT JOIN per ON per.id = a.id)
SELECT id AS action_id, CASE WHEN len(ids) = 1 THEN ids[1] ELSE '' END AS pops_id, method AS match_method,
CASE WHEN len(ids) > 1 OR level IS NULL THEN 'none' WHEN level <= 3 THEN 'high' WHEN level = 4 THEN 'medium' WHEN k % 5 < 2 THEN 'medium' ELSE 'low' END AS match_confidence,
CASE WHEN level IS NULL THEN 'no_match' WHEN len(ids) = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status, CASE WHEN len(ids) > 1 THEN array_to_string(ids, ';') ELSE '' END AS match_candidates,
note || CASE WHEN len(ids) > 1 THEN '; ' || len(ids) || ' candidates at level ' || method ELSE '' END AS match_notes,
CASE WHEN level >= 3 THEN borough || '|' || num || CASE kind WHEN 5 THEN '-' || (num + 2) ELSE '' END || '|' || CASE kind WHEN 6 THEN wrong ELSE street END ELSE '' END AS matched_address_key,
CASE kind WHEN 4 THEN CAST(1000000000 + k AS VARCHAR) ELSE '' END AS geocoded_bbl, '' AS geocoded_bin, CASE kind WHEN 0 THEN 'no_address' WHEN 3 THEN 'no_address' WHEN 4 THEN 'ok' ELSE 'not_geocoded' END AS geocode_status FROM m""")
def match_hierarchy(spark, d) -> DataFrame:
    """All five levels: written BBL and BIN, exact address, geocoded BBL, number range (none in Queens, where it is one number), misspelt street."""
    acts, sites, geocodes = _linked(spark, d)
    return resolve.link(acts, sites, geocodes).drop("match_score")  # a join of keys, which costs less to read twice than to store


def _linked(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as actions of seven kinds about their customer as a site, the sites, and the geocoder's answers."""
    sites = cut(_sites(spark, d))  # its streets are worked out once
    orders = T(spark, d, "orders").select(F.col("o_orderkey").alias("action_id"), F.col("o_custkey").cast("string").alias("cust"))
    wrong = T(spark, d, "customer").selectExpr("cast(c_custkey as string) as cust", f"{_spark(MISSPELT)} as misspelt")
    df = orders.join(sites.select("pops_id", "borough", "num", "street", "bbl", "bin"), F.col("cust") == F.col("pops_id")).join(wrong, "cust").withColumn("kind", F.col("action_id") % 7)
    kind = F.col("kind")
    said = F.when(kind == 0, F.concat(F.lit("BBL: "), "bbl")).when(kind == 1, F.concat(F.lit("BIN # "), "bin")).otherwise("nothing")
    number = F.when(kind == 4, (F.col("cust").cast("int") + 10_000).cast("string")).when(kind == 5, F.concat_ws("-", "num", (F.col("num").cast("int") + 2).cast("string"))).otherwise(F.col("num"))
    street = F.when(kind == 4, F.lit("Nowhere Oval")).when(kind == 6, F.col("misspelt")).otherwise(F.col("street"))
    one = F.struct(F.lit("").alias("raw"), number.alias("number"), street.alias("street"), F.lit(None).cast("string").alias("borough"), F.lit(True).alias("anchored"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    acts = df.select("action_id", "borough", said.alias("enforcement_text"), F.when(kind.isin(1, 2, 4, 5, 6), F.array(one)).otherwise(F.array().cast(address.ADDRESS_TYPE)).alias("candidates"))
    key = F.concat(F.col("borough"), F.lit("|"), (F.col("pops_id").cast("int") + 10_000).cast("string"), F.lit("|NOWHERE OVAL"))
    geocodes = sites.select(key.alias("query_key"), "bbl", F.lit("").alias("bin"), F.lit("ok").alias("status"))
    return acts.withColumn("identifiers", address.identifiers(F.col("enforcement_text"))), sites, geocodes


@query("""WITH q AS (SELECT l_orderkey, l_linenumber, l_quantity AS lo, l_quantity + 3 AS hi, l_suppkey AS k FROM lineitem), s AS (SELECT s_suppkey AS k, s_suppkey % 50 AS lo, s_suppkey % 50 + s_suppkey % 4 AS hi FROM supplier)
SELECT l_orderkey, l_linenumber, q.k, CAST(s.lo AS BIGINT) AS low, CAST(s.hi AS BIGINT) AS high FROM q JOIN s ON q.k = s.k AND q.lo <= s.hi AND q.hi >= s.lo""")
def range_overlap_join(spark, d) -> DataFrame:
    q = T(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_quantity as lo", "l_quantity + 3 as hi", "l_suppkey as k")
    s = T(spark, d, "supplier").selectExpr("s_suppkey as k", "s_suppkey % 50 as low", "s_suppkey % 50 + s_suppkey % 4 as high")
    return joins.overlapping(q, s, ["k"], ("lo", "hi"), ("low", "high")).select("l_orderkey", "l_linenumber", "k", "low", "high")


@query(f"""WITH x AS (SELECT DISTINCT {BOROUGH_SQL} AS borough, {CANONICAL} AS right_name, CASE c_custkey % 5 WHEN 0 THEN 'EAST ' || {WRITTEN_NUMBER} || ' STRET' WHEN 1 THEN 'WEST ' || {WRITTEN_NUMBER} || ' STRET' WHEN 2 THEN '6 AVENU' WHEN 3 THEN '23 STRET' ELSE 'PARK AVENUE' END AS street FROM customer)
SELECT borough, street, right_name AS street_canonical, CAST(CASE WHEN street = 'PARK AVENUE' THEN 88 ELSE round_even(200.0::DOUBLE * length(street) / (length(street) + length(right_name)), 6) END AS DOUBLE) AS ratio, street = 'PARK AVENUE' AS variant FROM x""")
def similar_streets(spark, d) -> DataFrame:
    """Misspelt streets, and streets without their compass word, against the sites' streets."""
    asked = T(spark, d, "customer").selectExpr(f"{BOROUGH_SQL} as borough", f"{_spark(MISSPELT)} as written").select("borough", address.canonical_street(F.col("written")).alias("street"), F.lit(1).alias("hn"))
    return resolve.similar_streets(asked, _sites(spark, d)).withColumn("ratio", F.bround("ratio", 6))


@query(f"""WITH {_SITES_SQL}, h AS (SELECT k AS id, 0 AS t, k || ' (No. ' || k || ' Hall, ' || num || ' ' || street || ') [building name in text]' AS hint FROM s WHERE k % 4 = 0
UNION ALL SELECT k, 1, k || ' (' || num || ' ' || street || ') [same house number, similar street name]' FROM s WHERE k % 4 = 1
UNION ALL SELECT k, 1, (k - 2) || ' (No. ' || (k - 2) || ' Hall, ' || o.num || ' ' || o.street || ') [building name in text]' FROM (SELECT s.k, o.num, o.street FROM s JOIN s o ON o.k = s.k - 2 WHERE s.k % 4 = 2) o)
SELECT CAST(id AS VARCHAR) AS enforcement_id, string_agg(hint, ' | ' ORDER BY t) AS suggested FROM h GROUP BY id""")
def suggest_candidates(spark, d) -> DataFrame:
    """Customers as actions that give a site's name, its number and misspelt street, another site's name, or nothing; a site's number is its id."""
    sites = cut(_sites(spark, d)).withColumns({"building_name": F.concat(F.lit("No. "), "pops_id", F.lit(" Hall")), "seq": F.col("pops_id").cast("long"), "hn_low": F.col("pops_id").cast("int")})
    wrong = T(spark, d, "customer").selectExpr("cast(c_custkey as string) as pops_id", f"{_spark(MISSPELT)} as misspelt")
    kind = F.col("seq") % 4
    said = F.when(kind == 0, F.concat(F.lit("at NO. "), "pops_id", F.lit(" hall, shut"))).when(kind == 2, F.concat(F.lit("beside no. "), (F.col("seq") - 2).cast("string"), F.lit(" Hall"))).when(kind == 3, F.concat(F.lit("the no. "), "pops_id", F.lit(" halls"))).otherwise("nothing")
    acts = sites.select("pops_id", "seq", "borough", "num").join(wrong, "pops_id").select(
        F.col("pops_id").alias("enforcement_id"), said.alias("enforcement_text"), "borough", F.when(kind < 2, F.col("pops_id")).otherwise("").alias("address_number"), F.col("misspelt").alias("address_street"))
    return review.suggestions(acts, sites)


@query("""SELECT item_id, doc_id FROM documents JOIN benchmark ON contains(documents.text, benchmark.text)""")
def name_in_text(spark, d) -> DataFrame:
    """Benchmark passages in documents."""
    return resolve.passages_in_text(T(spark, d, "documents"), T(spark, d, "benchmark")).select("item_id", "doc_id")


@query("""SELECT item_id, doc_id, CAST(place AS BIGINT) AS place, substr(body, CAST(greatest(place - 20, 1) AS BIGINT), 60) AS snippet FROM (SELECT item_id, doc_id, instr(d.text, b.text) AS place, d.text AS body, row_number() OVER (PARTITION BY item_id ORDER BY doc_id) AS n
FROM documents d JOIN benchmark b ON contains(d.text, b.text)) WHERE n <= 3""")
def passage_snippets(spark, d) -> DataFrame:
    found = resolve.passages_in_text(T(spark, d, "documents"), T(spark, d, "benchmark"))
    ranked = found.withColumn("n", F.row_number().over(Window.partitionBy("item_id").orderBy("doc_id"))).filter("n <= 3")
    return ranked.select("item_id", "doc_id", "place", "snippet")


@query(f"""WITH {_SITES_SQL}, a AS (SELECT s_suppkey AS id FROM supplier), x AS (SELECT id, s.* FROM a JOIN s ON k = id)
SELECT x.id AS action_id, CAST(s.borough AS VARCHAR) AS borough, true AS inferred FROM x JOIN s ON s.num = x.num AND s.street = x.street GROUP BY ALL""")
def borough_expand_semi(spark, d) -> DataFrame:
    """Suppliers as actions with an address and no borough: tried in every borough, kept where the site master has the address."""
    sites = _sites(spark, d)
    df = T(spark, d, "supplier").join(sites, F.col("s_suppkey") == F.col("pops_id").cast("long"))
    one = F.struct(F.lit("").alias("raw"), F.col("num").alias("number"), "street", F.lit(None).cast("string").alias("borough"), F.lit(True).alias("anchored"), F.lit(0).alias("start"), F.lit(0).alias("end"))
    acts = df.select(F.col("s_suppkey").alias("action_id"), F.array(one).alias("candidates"), F.lit("").alias("borough"))
    return resolve.evidence(acts, sites, spark.createDataFrame([], "query_key string, bbl string, bin string, status string")).select("action_id", "borough", "inferred")


@query("""WITH a AS (SELECT d.doc_id, CASE d.doc_id % 4 WHEN 0 THEN 'pops_text_and_property_match' WHEN 1 THEN 'pops_text_only' WHEN 2 THEN 'property_match_only' ELSE 'none' END AS rel, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN quality = 1 THEN 'reviewed_confirmed' WHEN toxic = 1 THEN 'reviewed_rejected' WHEN rel = 'pops_text_and_property_match' AND doc_id % 3 = 0 THEN 'auto_confirmed' WHEN rel <> 'none' THEN 'needs_review' ELSE '' END AS review_status,
CASE WHEN quality = 1 AND toxic = 1 THEN 'site' ELSE '' END AS pops_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'manual' ELSE 'none' END AS match_method FROM a""")
def overlay_decisions(spark, d) -> DataFrame:
    c = F.col
    rel = F.when(c("doc_id") % 4 == 0, "pops_text_and_property_match").when(c("doc_id") % 4 == 1, "pops_text_only").when(c("doc_id") % 4 == 2, "property_match_only").otherwise("none")
    acts = T(spark, d, "documents").select(c("doc_id").alias("enforcement_id"), rel.alias("pops_relation"), F.when(c("doc_id") % 3 == 0, "high").otherwise("none").alias("match_confidence"), F.lit("no_match").alias("match_status"), F.lit("").alias("pops_id"), F.lit("none").alias("match_method"))
    word = F.when(c("quality") == 1, " Confirm ").when(c("toxic") == 1, "REJECT").otherwise("note")
    dec = T(spark, d, "labels").select(c("doc_id").alias("enforcement_id"), F.lit(1).alias("seq"), word.alias("decision"), F.when((c("quality") == 1) & (c("toxic") == 1), "site").otherwise("").alias("pops_id"), F.lit("").alias("note"))
    return resolve.overlay(acts, dec).select(c("enforcement_id").alias("doc_id"), "review_status", "pops_id", "match_method")


@query("""WITH old AS (SELECT o_orderkey AS k, 'u' || o_custkey AS url FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'moved' ELSE 'u' || o_custkey END AS url FROM orders WHERE o_orderkey % 4 <> 0)
SELECT CAST(coalesce(old.k, new.k) AS VARCHAR) AS bulletin_id, coalesce(new.url, old.url) AS pdf_url, CASE WHEN old.k IS NULL THEN '2024-02-01' ELSE '2024-01-01' END AS date_discovered, CASE WHEN new.k IS NULL THEN '2024-01-01' ELSE '2024-02-01' END AS last_seen,
new.k IS NOT NULL AS still_on_index, CASE WHEN old.url <> new.url THEN CASE WHEN old.k % 2 = 0 THEN 'kept; ' ELSE '' END || 'url_changed_from=' || old.url WHEN old.k % 2 = 0 THEN 'kept' ELSE '' END AS note FROM old FULL JOIN new ON old.k = new.k""")
def registry_upsert(spark, d) -> DataFrame:
    o = T(spark, d, "orders").withColumn("url", F.concat(F.lit("u"), F.col("o_custkey").cast("string")))
    key = F.col("o_orderkey").cast("string").alias("bulletin_id")
    old = o.filter("o_orderkey % 3 <> 0").select(key, F.col("url").alias("pdf_url"), F.lit("2024-01-01").alias("date_discovered"), F.lit("2024-01-01").alias("last_seen"), F.lit(True).alias("still_on_index"), F.when(F.col("o_orderkey") % 2 == 0, "kept").otherwise("").alias("note"))
    new = o.filter("o_orderkey % 4 <> 0").select(key, F.when(F.col("o_orderkey") % 10 == 0, "moved").otherwise(F.col("url")).alias("pdf_url"))
    return registry_ops.upsert(old, new, "2024-02-01")


@query("""SELECT e.event_type AS csv_file, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_retrieved FROM events e WHERE e.event_type = (SELECT arg_max(event_type, event_id) FROM events) GROUP BY 1""")
def latest_snapshot(spark, d) -> DataFrame:
    m = T(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("csv_file"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("retrieved_at"))
    first = m.groupBy("csv_file").agg(F.min("retrieved_at").alias("first_retrieved"))
    return first.join(registry_ops.latest_snapshot(m).select("csv_file"), "csv_file")


@query("""WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT CAST(event_id AS VARCHAR) AS query_key, CASE WHEN k IS NULL THEN 'no_match' WHEN k % 5 = 0 THEN 'ok' ELSE 'mismatch' END AS status, CASE WHEN k % 5 = 0 THEN CAST(1000000000 + k AS VARCHAR) ELSE '' END AS bbl, CASE WHEN k % 5 = 0 THEN CAST(2000000 + k AS VARCHAR) ELSE '' END AS bin,
CASE WHEN k IS NULL THEN '' WHEN k % 5 = 0 THEN 'good' ELSE 'first' END AS label, CASE WHEN k IS NULL THEN '' WHEN k % 5 = 0 THEN '12-14' ELSE '9' END AS returned_number, CASE WHEN k IS NULL THEN '' WHEN k % 5 = 0 THEN 'E 5 ST' ELSE 'Elm' END AS returned_street FROM e""")
def geocode_accept(spark, d) -> DataFrame:
    """A wrong answer first; the second agrees, or differs in its number, street, county, or lot."""
    k = F.get_json_object("props", "$.k").try_cast("long")
    e = T(spark, d, "events").select(F.col("event_id").cast("string").alias("query_key"), k.alias("k")).withColumns({"borough": F.lit("Brooklyn"), "number": F.lit("12 - 14"), "street": F.lit("East Fifth Street")})

    def feature(number, street, county, label, bbl, bin_):
        pad = F.struct(F.struct(bbl.alias("bbl"), bin_.alias("bin")).alias("pad"))
        return F.struct(F.struct(number.alias("housenumber"), street.alias("street"), county.alias("county"), label.alias("label"), pad.alias("addendum")).alias("properties"))

    m, lit = F.col("k") % 5, F.lit
    good = feature(
        F.when(m == 1, "12-18").otherwise("12-14"), F.when(m == 2, "W 5 ST").otherwise("E 5 ST"), F.when(m == 3, "Queens County").otherwise("Kings County"), lit("good"),
        F.when(m == 4, "").otherwise((1000000000 + F.col("k")).cast("string")), (2000000 + F.col("k")).cast("string"),
    )
    first = feature(lit("9"), lit("Elm"), lit("Kings County"), lit("first"), lit("9"), lit("8"))
    answer = F.when(F.col("k").isNotNull(), F.to_json(F.struct(F.array(first, good).alias("features")))).otherwise('{"features":[]}')
    return registry_ops.accept_geocode(e.withColumn("json", answer))


AUDIT_LINK_SQL = f"""s AS (SELECT c_custkey AS k, {NUMBER} AS num, {CANONICAL} AS street FROM customer), a AS (SELECT s_suppkey AS audit_row, s_suppkey % 4 AS kind, num, street FROM supplier JOIN s ON k = s_suppkey),
r AS (SELECT audit_row, list_sort(list(DISTINCT CAST(s.k AS VARCHAR))) AS ids FROM a JOIN s ON s.street = a.street AND s.num = a.num WHERE kind <> 3 GROUP BY 1),
linked AS (SELECT a.audit_row, CASE WHEN ids IS NULL THEN 'no_match' WHEN len(ids) = 1 THEN 'matched' ELSE 'ambiguous' END AS match_status, CASE WHEN ids IS NULL THEN 'none' ELSE 'address_exact' END AS method,
CASE WHEN len(ids) = 1 THEN CASE kind WHEN 1 THEN 'medium' ELSE 'high' END ELSE 'none' END AS confidence, CASE WHEN len(ids) = 1 THEN ids[1] ELSE '' END AS pops_id, coalesce(array_to_string(ids, ';'), '') AS candidates FROM a LEFT JOIN r USING (audit_row))"""


def _audit_rows(spark, d) -> DataFrame:
    sites = cut(_sites(spark, d))  # its streets are worked out once
    rows = T(spark, d, "supplier").select(F.col("s_suppkey").alias("audit_row")).join(sites.select(F.col("pops_id").cast("long").alias("audit_row"), "num", "street"), "audit_row")
    plain, kind = F.concat_ws(" ", "num", "street"), F.col("audit_row") % 4
    said = F.when(kind == 0, plain).when(kind == 1, F.concat(F.lit("77 Nowhere Oval / "), plain)).when(kind == 2, F.concat(plain, F.lit(" - Some Tower"))).otherwise("99999 Nowhere Oval")
    return audit.link(rows.select("audit_row", said.alias("address")), sites)


@query(f"WITH {AUDIT_LINK_SQL} SELECT * FROM linked")
def audit_link_segments(spark, d) -> DataFrame:
    return _audit_rows(spark, d)


@query(f"""WITH {AUDIT_LINK_SQL} SELECT 'comptroller_audit_link' AS issue_type, 'medium' AS severity, 'R-' || left(sha1('audit|' || audit_row), 10) AS review_id, CASE WHEN pops_id <> '' THEN pops_id ELSE candidates END AS pops_id_candidate
FROM linked WHERE match_status <> 'matched' OR confidence <> 'high'""")
def audit_review(spark, d) -> DataFrame:
    return review.audit_issues(_audit_rows(spark, d)).select("issue_type", "severity", "review_id", "pops_id_candidate")


@query("""WITH s AS (SELECT s_suppkey AS k, s_suppkey % 7 + 1 AS page, s_suppkey || 'A ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Long Oak St.' ELSE 'long oak street' END AS place FROM supplier WHERE s_suppkey % 3 <> 0),
t AS (SELECT *, 'Auditors saw ' || place || ', gate ' || k || ' shut.' || CASE WHEN k % 5 = 0 THEN ' Then ' || place || ' again.' ELSE '' END AS said FROM s)
SELECT CAST(k AS INTEGER) AS audit_row, array_to_string(list_transform(range(CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END), lambda x: '[p.' || page || '] ' || said), ' || ') AS findings FROM t""")
def body_findings(spark, d) -> DataFrame:
    """A report of seven pages that names two of three audited addresses, some of them twice in a breath, before its appendix."""
    k = F.col("s_suppkey")
    place = F.concat(k.cast("string"), F.when(k % 2 == 0, "A Long Oak St.").otherwise("A long oak  street"))
    said = F.concat(F.lit("Auditors saw "), place, F.lit(", gate "), k.cast("string"), F.lit("\n shut."), F.when(k % 5 == 0, F.concat(F.lit(" Then "), place, F.lit(" again."))).otherwise(""))
    pages = T(spark, d, "supplier").filter("s_suppkey % 3 <> 0").select((k % 7 + 1).cast("int").alias("page"), said.alias("text"))
    appendix = T(spark, d, "supplier").select(F.lit(9).alias("page"), F.concat(F.lit("Appendix "), k.cast("string"), F.lit("A Long Oak Street")).alias("text"))
    rows = T(spark, d, "supplier").select(k.cast("int").alias("audit_row"), F.concat(k.cast("string"), F.lit("A Long Oak Street")).alias("address"))
    return audit.findings(pages.unionByName(appendix), rows)


@query("""WITH old AS (SELECT o_orderkey, 't' || o_custkey AS before FROM orders WHERE o_orderkey % 2 = 0) SELECT 'R-' || left(sha1('x|' || o.o_orderkey), 10) AS review_id, coalesce(before, 'now') AS detected_at, CASE WHEN o.o_orderkey % 5 = 0 THEN 'resolved' ELSE 'open' END AS status
FROM orders o LEFT JOIN old ON old.o_orderkey = o.o_orderkey""")
def preserve_first_seen(spark, d) -> DataFrame:
    """Issues whose wording changed since the last run keep the time of their first detection."""
    o = T(spark, d, "orders").withColumn("id", F.col("o_orderkey").cast("string"))
    issues = lambda said: review.issue(o, "x", "low", F.lit(True), "id", F.lit(said), of="enforcement_id")
    stamps = o.filter("o_orderkey % 2 = 0").select(F.col("id").alias("enforcement_id"), F.concat(F.lit("t"), F.col("o_custkey").cast("string")).alias("detected_at"))
    before = issues("old wording").join(stamps, "enforcement_id").select("review_id", "issue_type", "enforcement_id", "bulletin_id", "detected_at")
    return review.queue(issues("new wording"), before, o.filter("o_orderkey % 5 = 0").select(F.col("id").alias("enforcement_id")), "now").select("review_id", "detected_at", "status")


@query("""WITH m AS (SELECT l_orderkey, max(l_quantity) AS top FROM lineitem GROUP BY 1) SELECT l.l_orderkey, CAST(max(top) AS DOUBLE) AS top, string_agg(DISTINCT lpad(CAST(l_partkey AS VARCHAR), 9, '0'), ';' ORDER BY lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS winners FROM lineitem l JOIN m ON m.l_orderkey = l.l_orderkey AND l_quantity = top GROUP BY 1""")
def best_candidate_ties(spark, d) -> DataFrame:
    df = T(spark, d, "lineitem").withColumn("top", F.max("l_quantity").over(Window.partitionBy("l_orderkey"))).filter("l_quantity = top")
    return df.groupBy("l_orderkey").agg(F.max("top").cast("double").alias("top"), F.array_join(F.array_sort(F.collect_set(F.lpad(F.col("l_partkey").cast("string"), 9, "0"))), ";").alias("winners"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def incremental_anti(spark, d) -> DataFrame:
    o = T(spark, d, "orders")
    return registry_ops.unprocessed(o.select("o_orderkey"), o.filter("o_orderstatus = 'F'"), "o_orderkey")


@query(f"""WITH {ACTIONS_SQL} SELECT enforcement_id, pops_relation AS relation FROM acts""")
def relation_case(spark, d) -> DataFrame:
    acts = actions(spark, d)
    rel = F.col("pops_relation")
    worded = F.when(rel.isin("pops_text_and_property_match", "pops_text_only"), "strong").when(rel == "weak_keyword_only", "weak").otherwise("")
    return acts.select("enforcement_id", resolve.relation(worded, rel.isin("pops_text_and_property_match", "property_match_only")).alias("relation"))


_ACTS_SQL = "a AS (SELECT *, CAST(enforcement_id AS VARCHAR) AS id FROM acts WHERE pops_relation IN ('pops_text_and_property_match', 'pops_text_only', 'property_match_only') AND review_status <> 'reviewed_rejected')"


def _public(spark, d, sites: DataFrame | None = None) -> DataFrame:
    """Orders as reviewed actions, of which the public export shows those that are worded or linked."""
    acts = actions(spark, d).withColumnRenamed("review_status", "manual_review_status").withColumnRenamed("penalty", "penalty_amount")
    acts = acts.withColumns({"respondent": F.concat(F.lit("Holder "), "pops_id"), "bulletin_id": F.col("ym"), "bulletin_year": F.substring("ym", 1, 4), "bulletin_month": F.substring("ym", 6, 2), "enforcement_text": F.lit("said"), "violation_category": F.when(F.col("seq") % 2 == 0, "seating").otherwise("")})
    return publish.export(publish.with_site(acts, (_sites(spark, d) if sites is None else sites).withColumnRenamed("year", "year_established")))


@query(f"""WITH {ACTIONS_SQL}, {_ACTS_SQL} SELECT id AS enforcement_id, a.pops_id, CAST(1000000000 + c_custkey AS VARCHAR) AS bbl, {BOROUGH_SQL} AS pops_borough_master, c_name AS building_name, {NUMBER} || ' ' || {CANONICAL} AS normalized_address,
'Holder ' || a.pops_id AS owner, coalesce(CAST(penalty AS VARCHAR), '') AS penalty_amount, '' AS pdf_url, '' AS geocoded_bin, ym AS bulletin_id, 42 AS columns FROM a JOIN customer ON c_custkey = CAST(a.pops_id AS BIGINT)""")
def public_export(spark, d) -> DataFrame:
    """The 42-column export with renamed columns, site fields and blanks for columns that the actions lack."""
    out = _public(spark, d)
    shown = ("enforcement_id", "pops_id", "bbl", "pops_borough_master", "building_name", "normalized_address", "owner", "penalty_amount", "pdf_url", "geocoded_bin", "bulletin_id")
    return out.select(*shown, F.lit(len(out.columns)).alias("columns"))


@query(f"""WITH {ACTIONS_SQL}, {_ACTS_SQL}, e AS (SELECT pops_id, 'enforcement' AS event_type, ym AS event_date, 'month' AS event_date_precision, 'enforcement_action' AS source_table, id AS source_key,
CASE WHEN review_status IN ('auto_confirmed', 'reviewed_confirmed') THEN 'high' ELSE 'needs_review' END AS confidence, '[' || pops_relation || '] ' || CASE WHEN seq % 2 = 0 THEN 'seating' ELSE 'uncategorised' END || '; $' || coalesce(CAST(penalty AS VARCHAR), '?') || '; said' AS summary FROM a
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'agreement', CAST(1950 + c_custkey % 60 AS VARCHAR), 'year', 'pops_site', CAST(c_custkey AS VARCHAR), 'high', 'building completed ' || (1950 + c_custkey % 60) FROM customer WHERE c_custkey % 9 <> 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'audit_inspection', '2016', 'year', 'comptroller_audit', CAST(s_suppkey AS VARCHAR), 'high', 'audit A1: no' FROM supplier WHERE s_suppkey % 2 = 0) SELECT * FROM e""")
def history_events(spark, d) -> DataFrame:
    """The events of the site history: completed buildings, audit inspections and actions."""
    k = F.col("s_suppkey").cast("string")
    rows = T(spark, d, "supplier").select(F.col("s_suppkey").alias("audit_row"), F.lit("no").alias("outcome"), F.when(F.col("s_suppkey") % 2 == 0, k).otherwise("").alias("pops_id"), F.lit("high").alias("confidence"))
    tables = publish.history(_sites(spark, d).withColumnRenamed("year", "year_established"), _public(spark, d), rows, audit_id="A1", inspected="2016")
    return publish.timeline(tables["pops_event"])


@query(f"""WITH {ACTIONS_SQL}, b AS (SELECT DISTINCT ym, CAST(right(ym, 2) AS INTEGER) AS m FROM acts), n AS (SELECT ym, count(*) AS n_actions, count(*) FILTER (pops_relation IN ('pops_text_and_property_match', 'pops_text_only', 'property_match_only')) AS n_matches FROM acts GROUP BY ym)
SELECT b.ym AS bulletin_id, m NOT IN (1, 5) AS parsed, CASE WHEN m % 2 = 0 THEN 'before' WHEN m = 1 THEN '' ELSE 'now' END AS parsed_at, CASE WHEN m <> 1 THEN n_actions END AS n_actions, CASE WHEN m <> 1 THEN n_matches END AS n_matches,
CASE WHEN m <> 1 THEN CASE WHEN m = 5 THEN 'needs_ocr' ELSE 'plain' END ELSE '' END AS extraction_method, CASE WHEN m <> 1 THEN CASE WHEN m = 5 THEN 0 ELSE m END END AS page_count, CASE WHEN m <> 1 THEN CASE WHEN m = 5 THEN 0 ELSE 100 * m END END AS text_chars, CASE WHEN m <> 1 THEN m <> 5 END AS has_text_layer,
CASE WHEN m = 1 THEN 'download_failed: x; other' ELSE concat_ws('; ', 'download_failed: x', CASE WHEN m = 7 THEN 'odd note' END, CASE WHEN m = 3 THEN 'structure_marker_missing' END) END AS processing_errors FROM b JOIN n USING (ym)""")
def registry_counts(spark, d) -> DataFrame:
    """The registry after a parse: January is not extracted, May has no text, March lacks the opening phrase."""
    acts = actions(spark, d).withColumn("bulletin_id", F.col("ym"))
    months = acts.select("bulletin_id").distinct().withColumn("m", F.substring("bulletin_id", 6, 2).cast("int"))
    known = F.col("m") % 2 == 0
    registry = months.select("bulletin_id", F.when(known, "True").otherwise("False").alias("parsed"), F.when(known, "before").otherwise("").alias("parsed_at"), F.lit("download_failed: x; other").alias("processing_errors"))
    notes = F.when(F.col("m") == 7, F.array(F.lit("orphan line: y"), F.lit("odd note"))).otherwise(F.array(F.lit("orphan line: z")))
    bare = F.col("m") == 5
    size = lambda n: F.when(bare, 0).otherwise(n)
    seen = months.filter("m <> 1").select("bulletin_id", bare.alias("needs_ocr"), (F.col("m") != 3).alias("marker_found"), notes.alias("notes"), F.when(bare, "needs_ocr").otherwise("plain").alias("extraction_method"), size(F.col("m")).alias("n_pages"), size(100 * F.col("m")).alias("n_chars"))
    return registry_ops.with_counts(registry, acts, seen, "now")
