"""Queries of tiers, rates, crosstabs, per-site summaries, timelines and review reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import analytics, display, master, registry_ops, review, segment
from ..session import table as T
from .actions import ACTIONS_SQL, actions

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _categories(column):
    return text.classify(column, PART_CATEGORIES)["categories"]


# Categories over the words of part types.
PART_CATEGORIES = {"metal": ("STEEL", "TIN", "BRASS"), "plated": ("PLATED",), "standard": ("STANDARD", "ECONOMY"), "size": ("SMALL", "LARGE", "MEDIUM")}
PART_SQL = """cats AS (
  SELECT p_partkey, unnest(CASE WHEN len(c) > 0 THEN c ELSE ['other'] END) AS category FROM (
    SELECT p_partkey, list_filter([CASE WHEN regexp_matches(p_type, '(?i)STEEL|TIN|BRASS') THEN 'metal' END, CASE WHEN regexp_matches(p_type, '(?i)PLATED') THEN 'plated' END,
      CASE WHEN regexp_matches(p_type, '(?i)STANDARD|ECONOMY') THEN 'standard' END, CASE WHEN regexp_matches(p_type, '(?i)SMALL|LARGE|MEDIUM') THEN 'size' END], lambda x: x IS NOT NULL) AS c FROM part)
)"""


@query(f"""WITH {PART_SQL}, n AS (SELECT category, count(*) AS actions, (SELECT count(*) FROM part) AS total FROM cats GROUP BY category)
SELECT category, actions, (1000 * actions // total + CASE WHEN 2 * (1000 * actions % total) > total OR (2 * (1000 * actions % total) = total AND 1000 * actions // total % 2 = 1) THEN 1 ELSE 0 END) / 1000::DOUBLE AS share FROM n""")
def category_share(spark, d) -> DataFrame:
    return analytics.category_share(T(spark, d, "part").select(_categories(F.col("p_type")).alias("categories")))


@query(f"""WITH {ACTIONS_SQL} SELECT tier, count(*) AS actions, count(DISTINCT pops_id) AS sites, count(penalty) AS with_penalty, CAST(coalesce(sum(penalty), 0) AS BIGINT) AS penalties,
CAST(median(penalty) AS DOUBLE) AS median_penalty, max(penalty) AS max_penalty FROM tiered WHERE tier IS NOT NULL GROUP BY tier""")
def tier_summary(spark, d) -> DataFrame:
    return analytics.tier_totals(actions(spark, d))


@query(f"""WITH {ACTIONS_SQL} SELECT t.pops_id, count(*) AS total_actions, count(*) FILTER (tier = 'A') AS "tierA", count(*) FILTER (tier = 'B') AS "tierB", count(*) FILTER (tier = 'C') AS "tierC",
min(ym) AS first, max(ym) AS last, CAST(coalesce(sum(penalty), 0) AS BIGINT) AS penalties, any_value(c_name) AS name
FROM tiered t JOIN customer ON c_custkey = CAST(t.pops_id AS BIGINT) WHERE tier IS NOT NULL GROUP BY t.pops_id HAVING count(*) >= 2""")
def repeat_sites(spark, d) -> DataFrame:
    sites = T(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("pops_id"), F.col("c_name").alias("name"))
    return analytics.repeats(actions(spark, d), sites)


@query("""WITH named AS (SELECT p_partkey AS seq, p_partkey % 5 AS f, CASE p_partkey % 4 WHEN 0 THEN p_name || ', Inc.' WHEN 1 THEN 'The ' || p_name || ' L.P.' WHEN 2 THEN p_name || ' Owners Corp' ELSE p_name || ' Corporation' END AS respondent,
lower(p_name) || CASE WHEN p_partkey % 4 = 3 THEN ' corporation' ELSE '' END AS entity, CAST(p_partkey % 10 AS VARCHAR) AS site, CAST(floor(p_retailprice) AS BIGINT) AS penalty FROM part)
SELECT entity, count(*) AS actions, arg_min(respondent, seq) AS example_name, string_agg(DISTINCT site, ';' ORDER BY site) AS sites, CAST(sum(penalty) AS BIGINT) AS penalties
FROM named WHERE f <> 0 GROUP BY entity HAVING count(*) >= 2""")
def repeat_entities(spark, d) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_name")
    name = F.when(k % 4 == 0, F.concat(n, F.lit(", Inc."))).when(k % 4 == 1, F.concat(F.lit("The "), n, F.lit(" L.P."))).when(k % 4 == 2, F.concat(n, F.lit(" Owners Corp"))).otherwise(F.concat(n, F.lit(" Corporation")))
    df = T(spark, d, "part").select(k.alias("seq"), name.alias("respondent"), (k % 10).cast("string").alias("pops_id"), F.floor("p_retailprice").alias("penalty"), F.when(k % 5 != 0, "A").otherwise("B").alias("tier"))
    return analytics.repeat_entities(df)


@query(f"""WITH {PART_SQL} SELECT category, count(*) FILTER (year > 1994 AND year <= 1996) AS early, count(*) FILTER (year > 1996 AND year <= 1998) AS middle, count(*) FILTER (year > 1998 AND year <= 2000) AS late
FROM (SELECT category, year(l_shipdate) AS year FROM lineitem JOIN cats ON l_partkey = p_partkey) WHERE year > 1994 AND year <= 2000 GROUP BY category""")
def category_by_era(spark, d) -> DataFrame:
    parts = T(spark, d, "part").select("p_partkey", _categories(F.col("p_type")).alias("categories"))
    rows = T(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return analytics.era_crosstab(rows, {"early": (1994, 1996), "middle": (1996, 1998), "late": (1998, 2000)})


@query(f"""WITH {ACTIONS_SQL}, e AS (SELECT year(l_shipdate) AS year, count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS bulletins, count(*) AS all_entries FROM lineitem GROUP BY 1),
a AS (SELECT year, count(*) FILTER (tier = 'A') AS ta, count(*) FILTER (tier = 'B') AS tb, count(*) FILTER (tier = 'C') AS tc FROM tiered GROUP BY year)
SELECT CAST(coalesce(e.year, a.year) AS INTEGER) AS year, coalesce(bulletins, 0) AS bulletins, coalesce(all_entries, 0) AS all_entries, coalesce(ta, 0) AS "tierA_actions", coalesce(tb, 0) AS "tierB_actions",
coalesce(tc, 0) AS "tierC_actions", CAST(round_even(100.0::DOUBLE * coalesce(ta, 0) / nullif(CAST(coalesce(all_entries, 0) AS DOUBLE), 0), 2) AS DOUBLE) AS "tierA_per_100_entries" FROM e FULL JOIN a ON e.year = a.year""")
def by_year_rates(spark, d) -> DataFrame:
    e = T(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.countDistinct(F.date_format("l_shipdate", "yyyy-MM")).alias("bulletins"), F.count("*").alias("all_entries"))
    a = actions(spark, d).groupBy("year").agg(*[F.count_if(F.col("tier") == t).alias(f"tier{t}_actions") for t in "ABC"])
    df = e.join(a, "year", "full_outer").fillna(0)
    return df.withColumn("tierA_per_100_entries", analytics.percent(F.col("tierA_actions"), F.col("all_entries"), 2))


@query(f"""WITH {ACTIONS_SQL}, s AS (SELECT CAST(c_custkey AS VARCHAR) AS pops_id, n_name AS borough FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT borough, count(DISTINCT s.pops_id) AS sites, count(t.enforcement_id) AS "tierA_actions", count(DISTINCT t.pops_id) AS "tierA_sites",
CAST(round_even(100.0::DOUBLE * count(DISTINCT t.pops_id) / count(DISTINCT s.pops_id), 1) AS DOUBLE) AS pct FROM s LEFT JOIN (SELECT * FROM tiered WHERE tier = 'A') t ON s.pops_id = t.pops_id GROUP BY borough""")
def group_rates(spark, d) -> DataFrame:
    sites = T(spark, d, "customer").join(T(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("site"), F.col("n_name").alias("borough"))
    per = actions(spark, d).filter("tier = 'A'").groupBy("pops_id").agg(F.count("*").alias("n"))
    out = sites.join(per, F.col("site") == F.col("pops_id"), "left").groupBy("borough").agg(
        F.count("*").alias("sites"), F.coalesce(F.sum("n"), F.lit(0)).alias("tierA_actions"), F.count("pops_id").alias("tierA_sites"))
    return out.withColumn("pct", analytics.percent(F.col("tierA_sites"), F.col("sites")))


AGE_SQL = """aged AS (SELECT pops_id, y, CASE WHEN y BETWEEN 1961 AND 1969 THEN '1961-69' WHEN y BETWEEN 1970 AND 1979 THEN '1970s' WHEN y BETWEEN 1980 AND 1989 THEN '1980s' WHEN y BETWEEN 1990 AND 1999 THEN '1990s'
  WHEN y BETWEEN 2000 AND 2100 THEN '2000+' ELSE 'unknown' END AS decade FROM (SELECT CAST(c_custkey AS VARCHAR) AS pops_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1950 + c_custkey % 60 END AS y FROM customer)),
hit AS (SELECT DISTINCT pops_id FROM tiered WHERE tier = 'A')"""
FISHER_SQL = """x AS (SELECT unnest(range(greatest(0, a - d), least(a + b, a + c) + 1)) AS x, * FROM t),
p AS (SELECT *, exp(lgamma(a+b+1) + lgamma(c+d+1) + lgamma(a+c+1) + lgamma(b+d+1) - lgamma(a+b+c+d+1) - lgamma(x+1) - lgamma(a+b-x+1) - lgamma(a+c-x+1) - lgamma(d-a+x+1)) AS pr FROM x)
SELECT a, b, c, d, CAST(round_even(least(1.0, sum(pr) FILTER (pr <= seen * (1 + 1e-7))), 6) AS DOUBLE) AS p FROM (SELECT *, max(CASE WHEN x = a THEN pr END) OVER () AS seen FROM p) GROUP BY a, b, c, d"""


def _aged(spark, d) -> DataFrame:
    """Customers as sites with a year of completion, and whether a tier A action is linked to them."""
    k = F.col("c_custkey")
    sites = T(spark, d, "customer").select(k.cast("string").alias("pops_id"), F.when(k % 11 == 0, "").otherwise((1950 + k % 60).cast("string")).alias("y"))
    hit = actions(spark, d).filter("tier = 'A'").select("pops_id").distinct().withColumn("hit", F.lit(True))
    return sites.join(hit, "pops_id", "left").select("pops_id", analytics.decade(F.col("y")).alias("decade"), F.coalesce("hit", F.lit(False)).alias("hit"))


@query(f"""WITH {ACTIONS_SQL}, {AGE_SQL} SELECT decade, count(*) AS sites, CAST(count(*) FILTER (hit.pops_id IS NOT NULL) AS BIGINT) AS hits,
CAST(round_even(100.0::DOUBLE * count(*) FILTER (hit.pops_id IS NOT NULL) / count(*), 1) AS DOUBLE) AS pct FROM aged LEFT JOIN hit USING (pops_id) GROUP BY decade""")
def age_bins(spark, d) -> DataFrame:
    df = _aged(spark, d).groupBy("decade").agg(F.count("*").alias("sites"), F.sum(F.col("hit").cast("int")).alias("hits"))
    return df.withColumn("pct", analytics.percent(F.col("hits"), F.col("sites")))


@query(f"""WITH {ACTIONS_SQL}, {AGE_SQL}, t AS (SELECT count(*) FILTER (y < 1980 AND h) AS a, count(*) FILTER (y < 1980 AND NOT h) AS b, count(*) FILTER (y >= 1980 AND h) AS c, count(*) FILTER (y >= 1980 AND NOT h) AS d
FROM (SELECT y, hit.pops_id IS NOT NULL AS h FROM aged LEFT JOIN hit USING (pops_id) WHERE decade <> 'unknown')), {FISHER_SQL}""")
def fisher_2x2(spark, d) -> DataFrame:
    """Sites completed before 1980 against later ones; sites of unknown age are left out."""
    df = _aged(spark, d).filter("decade <> 'unknown'")
    return analytics.fisher(df, F.col("decade").isin("1961-69", "1970s"), F.col("hit")).withColumn("p", F.bround("p", 6))


AUDIT_SQL = """g AS (SELECT CAST(c_custkey AS VARCHAR) AS pops_id, CASE c_custkey % 4 WHEN 0 THEN 'not_in_audit' WHEN 1 THEN 'yes' WHEN 2 THEN 'no' ELSE 'construction' END AS audit_group FROM customer),
s AS (SELECT pops_id, max(CASE WHEN tier = 'A' THEN 1 ELSE 0 END) AS a, max(CASE WHEN tier IN ('A','B') THEN 1 ELSE 0 END) AS ab FROM tiered WHERE tier IS NOT NULL GROUP BY pops_id)"""


def _audited(spark, d) -> DataFrame:
    """Customers as sites with their audit group and whether they have tier A, tier A or B, or any tiered actions."""
    k = F.col("c_custkey")
    group = F.when(k % 4 == 0, "not_in_audit").when(k % 4 == 1, "yes").when(k % 4 == 2, "no").otherwise("construction")
    sites = T(spark, d, "customer").select(k.cast("string").alias("pops_id"), group.alias("audit_group"))
    flags = actions(spark, d).filter("tier is not null").groupBy("pops_id").agg(
        F.max((F.col("tier") == "A").cast("int")).alias("a"), F.max(F.col("tier").isin("A", "B").cast("int")).alias("ab"), F.lit(1).alias("any"))
    return sites.join(flags, "pops_id", "left")


@query(f"""WITH {ACTIONS_SQL}, {AUDIT_SQL} SELECT audit_group, count(*) AS sites, CAST(coalesce(sum(a), 0) AS BIGINT) AS "tierA", CAST(coalesce(sum(ab), 0) AS BIGINT) AS "tierAB", count(s.pops_id) AS any_linked,
CAST(round_even(100.0::DOUBLE * coalesce(sum(a), 0) / count(*), 1) AS DOUBLE) AS "tierA_pct", CAST(round_even(100.0::DOUBLE * coalesce(sum(ab), 0) / count(*), 1) AS DOUBLE) AS "tierAB_pct",
CAST(round_even(100.0::DOUBLE * count(s.pops_id) / count(*), 1) AS DOUBLE) AS any_linked_pct FROM g LEFT JOIN s USING (pops_id) GROUP BY audit_group""")
def audit_followup(spark, d) -> DataFrame:
    names = {"a": "tierA", "ab": "tierAB", "any": "any_linked"}
    df = _audited(spark, d).groupBy("audit_group").agg(F.count("*").alias("sites"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in names.items()])
    return df.withColumns({f"{n}_pct": analytics.percent(F.col(n), F.col("sites")) for n in names.values()})


@query(f"""WITH {ACTIONS_SQL}, {AUDIT_SQL}, t AS (SELECT count(*) FILTER (audit_group = 'no' AND a = 1) AS a, count(*) FILTER (audit_group = 'no' AND coalesce(a, 0) = 0) AS b,
count(*) FILTER (audit_group = 'yes' AND a = 1) AS c, count(*) FILTER (audit_group = 'yes' AND coalesce(a, 0) = 0) AS d FROM g LEFT JOIN s USING (pops_id)), {FISHER_SQL}""")
def audit_fisher(spark, d) -> DataFrame:
    """Sites found not compliant against compliant ones."""
    df = _audited(spark, d).filter("audit_group in ('no', 'yes')")
    return analytics.fisher(df, F.col("audit_group") == "no", F.coalesce("a", F.lit(0)) == 1).withColumn("p", F.bround("p", 6))


@query(f"""WITH {ACTIONS_SQL}, base AS (SELECT *, review_status IN ('auto_confirmed', 'reviewed_confirmed') AND pops_relation = 'pops_text_and_property_match' AS sure FROM tiered WHERE review_status <> 'reviewed_rejected'),
per AS (SELECT pops_id, count(*) FILTER (sure) AS confirmed, count(*) FILTER (sure AND ym >= '1997-04') AS confirmed_recent, count(*) FILTER (pops_relation = 'property_match_only') AS property_only,
  count(*) FILTER (review_status = 'needs_review') AS needs_review, count(*) AS "any", CAST(sum(penalty) FILTER (sure) AS BIGINT) AS penalties, max(ym) FILTER (sure) AS last,
  string_agg(CAST(enforcement_id AS VARCHAR), ';' ORDER BY seq) FILTER (sure) AS enforcement_ids FROM base GROUP BY pops_id),
audit AS (SELECT CAST(s_nationkey AS VARCHAR) AS pops_id, arg_min(s_name, s_suppkey) AS audit_outcome, CAST(min(s_suppkey) AS VARCHAR) AS audit_row, arg_min('seen ' || s_suppkey, s_suppkey) AS audit_findings, CASE WHEN min(s_suppkey) % 2 = 0 THEN 'high' ELSE 'low' END AS audit_confidence FROM supplier GROUP BY s_nationkey)
SELECT CAST(c_custkey AS VARCHAR) AS pops_id, coalesce(confirmed, 0) AS confirmed, coalesce(confirmed_recent, 0) AS confirmed_recent, coalesce(property_only, 0) AS property_only, coalesce(needs_review, 0) AS needs_review,
coalesce("any", 0) AS "any", coalesce(penalties, 0) AS penalties, coalesce(last, '') AS last, coalesce(enforcement_ids, '') AS enforcement_ids, coalesce(audit_outcome, '') AS audit_outcome,
coalesce(audit_row, '') AS audit_row, coalesce(audit_findings, '') AS audit_findings, coalesce(audit_confidence, '') AS audit_confidence, CASE WHEN last IS NULL THEN '' ELSE 'bulletin_month' END AS last_precision, c_name AS building_name, '{analytics.EVIDENCE_NOTE}' AS evidence_note,
audit_outcome IS NOT NULL AS in_audit FROM customer LEFT JOIN per ON per.pops_id = CAST(c_custkey AS VARCHAR) LEFT JOIN audit ON audit.pops_id = CAST(c_custkey AS VARCHAR)""")
def accountability(spark, d) -> DataFrame:
    sites = T(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("pops_id"), F.col("c_name").alias("building_name"))
    acts = actions(spark, d).withColumn("enforcement_id", F.col("enforcement_id").cast("string"))
    k = F.col("s_suppkey")
    audit = T(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("pops_id"), k.alias("audit_row"), F.col("s_name").alias("outcome"), F.concat(F.lit("seen "), k.cast("string")).alias("findings"), F.when(k % 2 == 0, "high").otherwise("low").alias("confidence"))
    return analytics.accountability(sites, acts, audit, "1997-04")


@query("""SELECT site, date, kind, detail FROM (
SELECT CAST(o_custkey AS VARCHAR) AS site, strftime(o_orderdate, '%Y-%m-%d') AS date, 'order' AS kind, o_orderstatus AS detail FROM orders UNION ALL
SELECT CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d'), 'event', event_type FROM events)""")
def timeline_union(spark, d) -> DataFrame:
    o = T(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("site"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("order").alias("kind"), F.col("o_orderstatus").alias("detail"))
    e = T(spark, d, "events").select(F.col("user_id").cast("string").alias("site"), F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("event").alias("kind"), F.col("event_type").alias("detail"))
    return master.timeline(o, e)


@query("""SELECT p_partkey, requirement, trim(value) AS value FROM (SELECT p_partkey, unnest(['p_brand', 'p_type', 'p_size']) AS requirement,
unnest([CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' || p_brand END, p_type, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END]) AS value FROM part) WHERE value IS NOT NULL AND trim(value) <> ''""")
def requirements_unpivot(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    df = T(spark, d, "part").select(
        k, F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" "), "p_brand")).alias("p_brand"), "p_type", F.when(k % 5 != 0, F.col("p_size")).alias("p_size"))
    return master.requirements(df, "p_partkey", ["p_brand", "p_type", "p_size"])


@query("""SELECT p_partkey, concat_ws(';', CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice < 1000 THEN 'cheap' END, CASE WHEN p_type LIKE '%STEEL%' THEN 'steel' END, CASE WHEN p_brand LIKE '%1' THEN 'brand1' END) AS flags FROM part""")
def flags_array(spark, d) -> DataFrame:
    checks = {"large": "p_size > 40", "cheap": "p_retailprice < 1000", "steel": "p_type like '%STEEL%'", "brand1": "p_brand like '%1'"}
    return master.quality_flags(T(spark, d, "part"), checks).select("p_partkey", "flags")


@query("""SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name || ' ' || p_type), 'st') AND p_brand = (SELECT min(p_brand) FROM part) AND p_size > 10 ORDER BY p_name, p_partkey LIMIT 150""")
def explore_filter(spark, d) -> DataFrame:
    df = T(spark, d, "part")
    least = df.agg(F.min("p_brand")).first()[0]
    return master.explore(df, ["p_name", "p_type"], q="ST", equals={"p_brand": least}, where="p_size > 10", order=["p_name", "p_partkey"]).select("p_partkey", "p_name", "p_brand")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS site, count(o_orderkey) AS n, count(o_orderkey) FILTER (o_orderstatus = 'F') AS closed,
coalesce(string_agg(CAST(o_orderkey AS VARCHAR) || ':' || o_orderstatus, ';' ORDER BY o_orderkey), '') AS e FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def nested_site_doc(spark, d) -> DataFrame:
    kids = T(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("site"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"))
    df = master.nested(T(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("site")), kids, "site", "seq", ["seq", "status"])
    joined = F.array_join(F.transform("e", lambda x: F.concat_ws(":", x["seq"].cast("string"), x["status"])), ";")
    return df.select("site", F.size("e").cast("long").alias("n"), F.size(F.filter("e", lambda x: x["status"] == "F")).cast("long").alias("closed"), joined.alias("e"))


QC_SQL = """issues AS (
SELECT 'suspicious_penalty' AS issue_type, CASE WHEN o_orderkey % 7 = 0 THEN 'medium' ELSE 'high' END AS severity, CAST(o_orderkey AS VARCHAR) AS subject_id FROM orders WHERE o_totalprice > 400000 OR o_orderkey % 7 = 0
UNION ALL SELECT 'truncated_source_entry', 'low', CAST(doc_id AS VARCHAR) FROM documents WHERE length(text) < 40 OR (length(text) < 120 AND NOT regexp_matches(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', ''), '[.”\")]$'))
UNION ALL SELECT 'duplicate_action', 'medium', CAST(min(doc_id) AS VARCHAR) FROM documents GROUP BY md5(text) HAVING count(*) > 1)"""


def _issues(spark, d) -> DataFrame:
    o = T(spark, d, "orders").withColumn("none", F.col("o_orderkey") % 7 == 0)
    docs = T(spark, d, "documents").select("doc_id", "text")
    twice = docs.groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).filter("n > 1")
    found = review.union([
        review.issue(o, "suspicious_penalty", F.when(F.col("none"), "medium").otherwise("high"), (F.col("o_totalprice") > 400000) | F.col("none"), "o_orderkey", F.lit("")),
        review.issue(docs, "truncated_source_entry", "low", review.truncated(F.col("text")), "doc_id", F.lit("")),
        review.issue(twice, "duplicate_action", "medium", F.lit(True), "doc_id", F.lit("")),
    ])
    return found.withColumn("subject_id", F.col("bulletin_id"))


@query(f"WITH {QC_SQL} SELECT issue_type, severity, subject_id, 'R-' || left(sha1(issue_type || '|' || subject_id), 10) AS review_id FROM issues")
def qc_rules_union(spark, d) -> DataFrame:
    return _issues(spark, d).select("issue_type", "severity", "subject_id", "review_id")


@query(f"WITH {QC_SQL} SELECT issue_type, severity, count(*) AS issues FROM issues GROUP BY 1, 2")
def issue_summary(spark, d) -> DataFrame:
    return review.summary(_issues(spark, d))


@query(f"WITH {QC_SQL} SELECT issue_type, severity, subject_id FROM issues ORDER BY CASE severity WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, issue_type, subject_id LIMIT 400")
def severity_sort_topk(spark, d) -> DataFrame:
    return review.by_severity(_issues(spark, d)).limit(400).select("issue_type", "severity", "subject_id")


@query("""WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS bulletin_id, count(*) AS n_entries FROM orders GROUP BY 1),
w AS (SELECT *, list_sort(list(n_entries) OVER (ORDER BY bulletin_id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)) AS seen FROM m),
t AS (SELECT bulletin_id, n_entries, CASE WHEN len(seen) >= 3 THEN seen[len(seen) // 2 + 1] END AS typical FROM w)
SELECT bulletin_id, n_entries, typical, coalesce(typical <> 0 AND (n_entries < 0.4 * typical OR n_entries > 2.5 * typical), false) AS is_outlier FROM t""")
def rolling_upper_median(spark, d) -> DataFrame:
    months = T(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("bulletin_id")).agg(F.count("*").alias("n_entries"))
    return review.entry_count_outliers(months)


@query("""WITH m AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym FROM orders)
SELECT strftime(d, '%Y-%m') AS ym FROM (SELECT unnest(generate_series(min(CAST(ym || '-01' AS DATE)), max(CAST(ym || '-01' AS DATE)), INTERVAL 1 MONTH)) AS d FROM m) WHERE strftime(d, '%Y-%m') NOT IN (SELECT ym FROM m)""")
def missing_months_anti(spark, d) -> DataFrame:
    return review.missing_months(T(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym")))


@query(f"""WITH {ACTIONS_SQL} SELECT enforcement_id, ym, penalty FROM tiered WHERE ym >= '1996-04' AND ym < '1997-01' AND priority IN ('1-URGENT', '2-HIGH') AND NOT (penalty BETWEEN 1000 AND 200000)""")
def string_range_filter(spark, d) -> DataFrame:
    df = actions(spark, d).filter("ym >= '1996-04' and ym < '1997-01'").filter(F.col("priority").isin("1-URGENT", "2-HIGH"))
    return df.filter(~F.col("penalty").between(1000, 200000)).select("enforcement_id", "ym", "penalty")


@query(f"""WITH {ACTIONS_SQL} SELECT enforcement_id, CASE WHEN pops_relation = 'pops_text_and_property_match' AND review_status IN ('auto_confirmed', 'reviewed_confirmed') THEN 'confirmed'
WHEN review_status = 'reviewed_rejected' OR pops_relation IN ('none', 'weak_keyword_only', 'pops_text_only') THEN '' WHEN pops_relation = 'pops_text_and_property_match' THEN 'pending' ELSE 'property_only' END AS state FROM tiered""")
def tier_case_union(spark, d) -> DataFrame:
    c = F.col
    both, rejected = c("pops_relation") == "pops_text_and_property_match", c("review_status") == "reviewed_rejected"
    state = F.when(both & c("review_status").isin(*analytics.CONFIRMED), "confirmed").when(rejected, "").when(both, "pending").when(c("pops_relation") == "property_match_only", "property_only").otherwise("")
    return actions(spark, d).select("enforcement_id", state.alias("state"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS site, coalesce(n, 0) AS n, coalesce(total, 0) AS total, coalesce(last, '') AS last FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS BIGINT)) AS BIGINT) AS total, max(strftime(o_orderdate, '%Y-%m')) AS last
FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def zero_filled_profile(spark, d) -> DataFrame:
    per = T(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.sum(F.bround("o_totalprice").cast("long")).alias("total"), F.max(F.date_format("o_orderdate", "yyyy-MM")).alias("last"))
    df = T(spark, d, "customer").select("c_custkey").join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
    return df.select(F.col("c_custkey").cast("string").alias("site"), "n", "total", "last").fillna(0, ["n", "total"]).fillna("", ["last"])


@query("""SELECT string_agg(o_orderstatus || '=' || n, ';' ORDER BY o_orderstatus) AS counts, CAST(sum(n) AS BIGINT) AS total, CAST(max(n) AS BIGINT) AS most FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""")
def counts_map(spark, d) -> DataFrame:
    per = T(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("o_orderstatus", "n")))
    return per.agg(F.array_join(F.transform(pairs, lambda x: F.concat_ws("=", x["o_orderstatus"], x["n"].cast("string"))), ";").alias("counts"), F.sum("n").alias("total"), F.max("n").alias("most"))


@query("""SELECT CAST(year AS INTEGER) AS year, CAST(max(n) AS BIGINT) AS most, arg_max(ym, n * 1000000 - CAST(replace(ym, '-', '') AS BIGINT)) AS peak FROM (SELECT year(o_orderdate) AS year, strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY year""")
def peak_year(spark, d) -> DataFrame:
    per = T(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(F.count("*").alias("n"))
    rank = F.col("n") * 1000000 - F.replace("ym", F.lit("-"), F.lit("")).cast("long")
    return per.groupBy("year").agg(F.max("n").alias("most"), F.max_by("ym", rank).alias("peak"))


@query("""SELECT p_partkey, CAST(round_even(CAST(p_size AS DOUBLE) / 8, 1) AS DOUBLE) AS tenth, CAST(round_even(CAST(p_size AS DOUBLE) / 2, 0) AS DOUBLE) AS whole FROM part""")
def rounding_half_even(spark, d) -> DataFrame:
    size = F.col("p_size").cast("double")
    return T(spark, d, "part").select("p_partkey", F.bround(size / 8, 1).alias("tenth"), F.bround(size / 2, 0).alias("whole"))


@query("""SELECT 'both' AS part, CAST(k AS BIGINT) AS k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'first', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'either', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def set_ops(spark, d) -> DataFrame:
    keys = lambda s: T(spark, d, "orders").filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    a, b = keys("F"), keys("P")
    named = lambda name, df: df.select(F.lit(name).alias("part"), "k")
    return review.union([named("both", a.intersect(b)), named("first", a.subtract(b)), named("either", a.union(b).distinct())])


@query("""SELECT o_orderkey, coalesce(CAST(CASE WHEN first_value(ym) OVER w <> ym THEN first_value(o_orderkey) OVER w END AS VARCHAR), '') AS duplicate_of,
CASE WHEN first_value(ym) OVER w <> ym THEN 'same_address_penalty_respondent' ELSE '' END AS duplicate_basis FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS ym FROM orders)
WINDOW w AS (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def dup_signature(spark, d) -> DataFrame:
    """Orders as actions that all have their own text, and an address, penalty and respondent in common with others."""
    key = F.col("o_orderkey").cast("string")
    df = T(spark, d, "orders").select(
        F.struct("o_orderdate", "o_orderkey").alias("seq"), key.alias("enforcement_id"), F.date_format("o_orderdate", "yyyy-MM").alias("bulletin_id"), key.alias("norm"),
        F.when(F.col("o_orderkey") % 2 == 0, "E. 5th St.").otherwise("East Fifth Street").alias("address_street"), F.col("o_custkey").cast("string").alias("address_number"),
        F.ascii("o_orderstatus").alias("penalty_amount"), F.when(F.col("o_orderkey") % 3 == 0, F.upper("o_orderpriority")).otherwise(F.lower("o_orderpriority")).alias("respondent"),
    )
    return segment.duplicates(df).select(F.col("enforcement_id").cast("long").alias("o_orderkey"), "duplicate_of", "duplicate_basis")


@query(f"""WITH {ACTIONS_SQL}, x AS (SELECT *, CASE WHEN enforcement_id % 9 = 0 THEN 'd' ELSE '' END AS duplicate_of FROM tiered)
SELECT count(*) AS actions, {", ".join(f"""count(*) FILTER (tier = '{t}') AS "tier_{t}_actions", count(DISTINCT pops_id) FILTER (tier = '{t}') AS "tier_{t}_sites",
CAST(coalesce(sum(penalty) FILTER (tier = '{t}'), 0) AS BIGINT) AS "tier_{t}_penalty_total", count(penalty) FILTER (tier = '{t}') AS "tier_{t}_penalty_n" """ for t in "ABC")},
count(DISTINCT pops_id) FILTER (tier IN ('A', 'B')) AS "tier_AB_sites", count(DISTINCT pops_id) FILTER (tier IS NOT NULL) AS "tier_ABC_sites", CAST(median(penalty) FILTER (tier = 'A') AS DOUBLE) AS "tier_A_penalty_median",
max(penalty) FILTER (tier = 'A') AS "tier_A_penalty_max", count(*) FILTER (tier = 'A' AND duplicate_of <> '') AS "tier_A_duplicates", CAST(coalesce(sum(penalty), 0) AS BIGINT) AS penalty_total FROM x""")
def summary_figures(spark, d) -> DataFrame:
    return analytics.summary(actions(spark, d).withColumn("duplicate_of", F.when(F.col("enforcement_id") % 9 == 0, "d").otherwise("")))


@query("""WITH w AS (SELECT strftime(o_orderdate, '%Y-%m') AS ym, CASE WHEN o_orderdate >= DATE '1998-01-01' OR o_orderkey % 4 = 0 THEN 'weak' WHEN o_orderkey % 4 = 1 THEN 'strong' WHEN o_orderkey % 4 = 2 THEN 'moderate' ELSE '' END AS tier FROM orders),
l AS (SELECT max(ym) AS last_wording FROM w WHERE tier IN ('strong', 'moderate')) SELECT last_wording, (SELECT count(DISTINCT strftime(l_shipdate, '%Y-%m')) FROM lineitem WHERE strftime(l_shipdate, '%Y-%m') > last_wording) AS bulletins_after FROM l""")
def last_wording(spark, d) -> DataFrame:
    k = F.col("o_orderkey") % 4
    tier = F.when((F.col("o_orderdate") >= "1998-01-01") | (k == 0), "weak").when(k == 1, "strong").when(k == 2, "moderate").otherwise("")
    acts = T(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("ym"), tier.alias("pops_keyword_tier"))
    return analytics.last_wording(acts, T(spark, d, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM").alias("bulletin_id")).distinct())


@query("""SELECT ym, n FROM (SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders GROUP BY 1 ORDER BY ym DESC LIMIT 12) ORDER BY ym""")
def last_months(spark, d) -> DataFrame:
    """The last 12 months in order."""
    per = T(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(F.count("*").alias("n"))
    return per.orderBy(F.desc("ym")).limit(12).orderBy("ym")


@query(r"""WITH a AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey % 12 AS f FROM orders),
i AS (SELECT id, k, f, unnest(CASE f WHEN 0 THEN ['ambiguous_pops_match high'] WHEN 1 THEN ['low_confidence_match high'] WHEN 2 THEN ['low_confidence_match medium'] WHEN 3 THEN ['pops_keyword_without_db_match high'] WHEN 4 THEN ['weak_pops_keyword_no_match low']
  WHEN 5 THEN ['db_match_without_pops_terms medium'] WHEN 6 THEN ['possible_duplicate_action medium'] WHEN 7 THEN ['borough_conflict medium'] WHEN 8 THEN ['address_not_parsed low'] WHEN 9 THEN ['suspicious_penalty high'] WHEN 10 THEN ['suspicious_penalty medium']
  ELSE CASE WHEN k % 24 = 11 THEN ['truncated_source_entry low'] ELSE [] END END) AS i FROM a)
SELECT split_part(i, ' ', 1) AS issue_type, split_part(i, ' ', 2) AS severity, id AS enforcement_id, 'R-' || left(sha1(split_part(i, ' ', 1) || '|' || id), 10) AS review_id FROM i""")
def record_rules(spark, d) -> DataFrame:
    """Orders as actions of twelve kinds, each of which breaks one rule, or none."""
    f = F.col("o_orderkey") % 12
    when = lambda k, value, other="": F.when(f == k, value).otherwise(other)
    long = "An entry about a plaza whose gate was closed to everyone on that day, which the owner did not mend although it was told to"
    said = F.when(f == 10, f"$ {long}.").when(f == 11, F.when(F.col("o_orderkey") % 24 == 11, "Cut off in the middle of a line with some more words in it").otherwise("Quoted as it stood in the paper, with some more words “shut”")).when(f == 8, long)
    said = F.when(F.col("o_orderkey") % 60 == 8, F.lit(f"{long}!")).otherwise(said.otherwise(f"{long}."))
    df = T(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("enforcement_id"), said.alias("enforcement_text"), when(0, "ambiguous", "none").alias("a"),
        F.when(f == 0, "ambiguous").when(f.isin(1, 2), "matched").otherwise("no_match").alias("match_status"), F.when(f == 1, "low").when(f == 2, "medium").otherwise("high").alias("match_confidence"),
        F.when(f == 3, "pops_text_only").when(f == 4, "weak_keyword_only").when(f == 5, "property_match_only").otherwise("none").alias("pops_relation"), when(6, "e1").alias("duplicate_of"),
        (f == 7).alias("borough_conflict"), (f == 11).alias("professional_section"), F.when(f.isin(8, 11), "").otherwise("1 Main Street").alias("address_raw"),
        F.when(f == 9, F.when(F.col("o_orderkey") % 24 == 9, 99).otherwise(2_000_001)).when(f != 10, F.when(F.col("o_orderkey") % 2 == 0, 100).otherwise(2_000_000)).alias("penalty_amount"),
    )
    return review.record_issues(df).select("issue_type", "severity", "enforcement_id", "review_id")


_BULLETIN = "CASE WHEN k % 17 = 0 THEN 'unparsed:' || k ELSE lpad(CAST(1900 + k // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') END"


@query(f"""WITH r AS (SELECT k, {_BULLETIN} AS id FROM (SELECT DISTINCT CAST(p_partkey AS BIGINT) AS k FROM part)),
i AS (SELECT id, unnest(CASE WHEN k % 17 = 0 THEN ['bulletin_month_unparsed high'] ELSE list_filter([CASE WHEN k % 5 = 0 THEN 'download_failed high' END, CASE WHEN k % 7 = 0 THEN 'index_label_conflict low' END, CASE WHEN k % 11 = 0 THEN 'structure_change_filename high' END,
  CASE WHEN k % 13 = 0 THEN 'bulletin_removed_from_index medium' END, CASE WHEN k % 19 = 0 THEN 'bulletin_replaced_upstream medium' END], lambda x: x IS NOT NULL) END) AS i FROM r
UNION ALL SELECT id, unnest(CASE WHEN k % 23 = 0 THEN ['failed_extraction high'] ELSE list_filter([CASE WHEN k % 29 = 0 THEN 'failed_extraction high' END, CASE WHEN k % 31 = 0 THEN 'structure_change_marker high' END, CASE WHEN k % 37 = 0 THEN 'empty_bullets_dropped low' END,
  CASE WHEN k % 41 = 0 AND k % 29 <> 0 THEN 'structure_change_entry_count medium' END], lambda x: x IS NOT NULL) END) FROM r WHERE k > 3 AND k % 17 <> 0
UNION ALL SELECT lpad(CAST(1900 + k // 12 AS VARCHAR), 4, '0') || '-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0'), 'missing_bulletin_month medium' FROM r, (SELECT min(k) AS first, max(k) AS last FROM r WHERE k % 17 <> 0) WHERE k % 17 = 0 AND k > first AND k < last
UNION ALL SELECT string_agg(id, ',' ORDER BY id), 'duplicate_bulletin high' FROM r WHERE k % 43 = 0 OR k % 43 = 1 GROUP BY k // 43 HAVING count(*) > 1
UNION ALL SELECT string_agg(id, ',' ORDER BY id), 'duplicate_bulletin high' FROM r WHERE k % 47 = 0 OR k % 47 = 2 GROUP BY k // 47 HAVING count(*) > 1)
SELECT split_part(i, ' ', 1) AS issue_type, split_part(i, ' ', 2) AS severity, id AS bulletin_id, 'R-' || left(sha1(split_part(i, ' ', 1) || '|' || id), 10) AS review_id FROM i""")
def bulletin_rules(spark, d) -> DataFrame:
    """Part keys as monthly bulletins that break rules by their divisors; ids hold four digits of a year, so larger keys share them."""
    k = F.col("k")
    div = lambda n: k % n == 0
    named = lambda n: F.concat_ws("-", F.lpad(F.floor(n / 12).cast("string"), 4, "0"), F.lpad((n % 12 + 1).cast("string"), 2, "0"))
    month = (12 * 1900 + k).alias("month")
    base = T(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k")).distinct().withColumn("bulletin_id", F.when(div(17), F.concat(F.lit("unparsed:"), k.cast("string"))).otherwise(named(month)))
    one = lambda n, m: F.when(div(n) | (k % n == m), F.floor(k / n)).otherwise(-k)
    registry = base.select(
        "bulletin_id", month, F.concat(F.lit("u"), one(47, 2).cast("string")).alias("pdf_url"), F.concat(F.lit("h"), one(43, 1).cast("string")).alias("sha256"), F.when(div(5), "False").otherwise("True").alias("downloaded"),
        F.when(div(19), "pdf_replaced_upstream: x").otherwise("").alias("processing_errors"), F.lit("label").alias("index_label"), div(7).alias("label_conflict"), (~div(11)).alias("filename_pattern_ok"), (~div(13)).alias("still_on_index"),
    )
    diagnostics = base.filter((k > 3) & ~div(17)).select(
        "bulletin_id", month, div(23).alias("needs_ocr"), F.lit(True).alias("has_text"), F.when(div(29), 0).when(div(41), 1000).otherwise(10).alias("n_entries"), (~div(31)).alias("marker_found"), F.when(div(37), 2).otherwise(0).alias("empty_bullets"))
    return review.bulletin_issues(registry, diagnostics, named=named).select("issue_type", "severity", "bulletin_id", "review_id")


@query("""SELECT 'structure_change_index' AS issue_type, 'high' AS severity, 'R-' || left(sha1('index|' || n), 10) AS review_id FROM (SELECT count(*) FILTER (p_partkey % 10 < 7) AS n, count(*) AS known FROM part) WHERE n = 0 OR n < 0.8 * known""")
def index_guard(spark, d) -> DataFrame:
    """The index shows seven of ten known bulletins."""
    parts = T(spark, d, "part")
    return review.index_issues(parts.filter("p_partkey % 10 < 7").select(F.col("p_name").alias("href")), parts.select(F.lit(True).alias("still_on_index"))).select("issue_type", "severity", "review_id")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS pops_id, concat_ws(';', CASE WHEN c_custkey % 7 = 0 THEN 'missing_bbl' END, CASE WHEN c_custkey % 5 = 0 THEN 'missing_bin' END, CASE WHEN c_custkey % 5 = 1 THEN 'bin_placeholder_not_matchable' END,
CASE WHEN c_custkey % 9 = 0 THEN 'year_completed_is_0_in_source' WHEN c_custkey % 9 = 1 THEN 'missing_year' END, CASE WHEN c_custkey % 4 = 0 THEN 'under_construction' END, CASE WHEN c_custkey % 6 = 0 THEN 'address_not_normalizable' END,
CASE WHEN c_custkey % 2 = 0 THEN 'missing_required_hours' END, CASE WHEN c_custkey % 3 = 0 THEN 'missing_required_amenities' END) AS flags FROM customer""")
def master_flags(spark, d) -> DataFrame:
    """The nine quality flags of the site master."""
    k = F.col("c_custkey")
    blank = lambda n, value, r=0: F.when(k % n == r, "").otherwise(value)
    raw = T(spark, d, "customer").select(
        k.cast("string").alias("pops_id"), blank(7, (1000000000 + k).cast("string")).alias("bbl"), F.when(k % 5 == 0, "").when(k % 5 == 1, "3000000").otherwise((2000001 + k).cast("string")).alias("bin"),
        F.when(k % 9 == 0, "0").when(k % 9 == 1, " ").otherwise("1987").alias("year_completed"), F.lit("Queens").alias("borough"), F.when(k % 6 == 0, "rear").otherwise("12-34").alias("num"), F.lit("Main St").alias("street"),
        F.lit("x").alias("building_name"), F.when(k % 4 == 0, "Under Construction (2 of 3)").otherwise("Yes").alias("building_constructed"), blank(2, "24 hours").alias("required_hours"), blank(3, "benches").alias("required_amenities"),
    )
    return master.quality_flags(master.normalise(raw.withColumn("year", F.trim("year_completed"))), master.QUALITY_CHECKS).select("pops_id", "flags")


@query(f"""WITH {ACTIONS_SQL} SELECT seq, ['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August', 'September', 'October', 'November', 'December'][CAST(right(ym, 2) AS INTEGER)] || ' ' || year AS "when", pops_id AS site,
CASE WHEN penalty IS NULL THEN 'amount not stated' ELSE '$' || format('{{:,}}', penalty) END AS penalty, CASE WHEN seq % 2 = 0 THEN repeat('word ', 46) || '…' ELSE 'short' END AS text FROM tiered WHERE tier = 'A' ORDER BY year DESC, CAST(right(ym, 2) AS INTEGER) DESC, pops_id, seq LIMIT 8""")
def latest_feed(spark, d) -> DataFrame:
    """The eight latest confirmed actions as the site shows them."""
    said = F.when(F.col("seq") % 2 == 0, "word " * 50).otherwise("short")
    return display.feed(actions(spark, d).withColumns({"month": F.substring("ym", 6, 2).cast("int"), "text": said}))


@query(f"""WITH {ACTIONS_SQL}, {AUDIT_SQL} SELECT audit_group, count(*) AS sites, CASE audit_group WHEN 'no' THEN 'Audit: not fully compliant (No)' WHEN 'yes' THEN 'Audit: full compliance (Yes)' ELSE 'Audit: marked “Construction”' END AS label
FROM g WHERE audit_group <> 'not_in_audit' GROUP BY audit_group""")
def audit_labels(spark, d) -> DataFrame:
    """Audit groups with their labels; a group without one is not shown."""
    groups = _audited(spark, d).withColumn("audit_group", F.when(F.col("audit_group") == "not_in_audit", "other").otherwise(F.col("audit_group")))
    return display.audit_table(groups.groupBy("audit_group").agg(F.count("*").alias("sites")))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'East 5-B (Rear/Side)' WHEN 1 THEN '' ELSE 'Élan Of The Park' END AS title, replace(replace(c_name, '#', '&lt;&quot;&amp;&#39;&gt;'), ' ', '') AS escaped FROM customer""")
def shown_text(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    said = F.when(k % 3 == 0, "EAST 5-b (REAR/SIDE)").when(k % 3 == 2, "ÉLAN OF the PARK")
    marked = F.replace(F.replace("c_name", F.lit("#"), F.lit("<\"&'>")), F.lit(" "), F.lit(""))
    return T(spark, d, "customer").select("c_custkey", display.title(said).alias("title"), display.escaped(marked).alias("escaped"))


@query("""SELECT found, CASE WHEN found > 150 THEN 'Showing the first 150. Narrow the search to see the rest.' WHEN found = 0 THEN 'Nothing matches these filters.' ELSE '' END AS note FROM (SELECT count(*) AS found FROM part WHERE p_size > 10)""")
def list_note(spark, d) -> DataFrame:
    return display.list_note(T(spark, d, "part").filter("p_size > 10"))


@query("""SELECT 'now' AS retrieved_at, 'd' AS dataset_id, strftime(ts, '%Y-%m-%d') AS updated, sha256(event_type || event_id // 2) AS sha256, CAST(length(event_type || event_id // 2) AS INTEGER) AS bytes,
CASE WHEN event_id // 2 % 2 = 0 THEN 'f' || event_id // 2 ELSE 'd_' || strftime(ts, '%Y-%m-%d') || '_' || left(sha256(event_type || event_id // 2), 8) || '.csv' END AS csv_file, CASE WHEN event_id // 2 % 2 = 0 THEN 'unchanged' ELSE 'downloaded' END AS status FROM events""")
def content_snapshots(spark, d) -> DataFrame:
    """Events as retrieved files; the manifest knows the content of every second pair of ids."""
    half = F.floor(F.col("event_id") / 2)
    content = F.concat("event_type", half.cast("string"))
    e = T(spark, d, "events")
    manifest = e.filter(half % 2 == 0).select(F.sha2(content, 256).alias("sha256"), F.concat(F.lit("f"), half.cast("string")).alias("csv_file"))
    return registry_ops.snapshots(e.select(F.lit("d").alias("dataset_id"), F.date_format("ts", "yyyy-MM-dd").alias("updated"), content.alias("content")), manifest, "now")
