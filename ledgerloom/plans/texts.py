"""Queries of text: segmentation, parsing, detection, identifiers, dates, links, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address, rules, text
from ..operators import review, segment
from ..session import table as T
from ..sources import readers

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _notices(spark, d) -> DataFrame:
    """Generated notice text over orders, from typed columns that the oracles read directly."""
    k = "o_orderkey"
    amount = "o_orderkey % 30 * 1000 + 1500"
    spaced = f"case {k} % 3 when 0 then format_number({amount}, 0) when 1 then replace(format_number({amount}, 0), ',', ', ') else cast({amount} as string) end"
    basis = f"case when {k} % 4 = 0 then 'in total violations' else 'in total penalties' end"
    place = f"concat({k} % 800 + 1, case {k} % 3 when 0 then ' E. ' when 1 then ' West ' else ' East ' end, {k} % 89 + 4, case {k} % 2 when 0 then 'th St.' else ' th Street' end)"
    where = f"case {k} % 4 when 0 then ', Manhattan' when 1 then ' in the Bronx' when 2 then ', Queens' else '' end"
    said = f"concat('$', {spaced}, ' ', {basis}, ' issued to Holder ', {k}, ' LLC, the owner of ', {place}, {where}, ', for having tables. Seen on ', date_format(o_orderdate, 'MMMM d, yyyy'), '. BIN # ', 1000000 + {k} % 8999999, '.')"
    return T(spark, d, "orders").selectExpr(k, "o_orderdate", f"{said} as said")


AMOUNT_SQL = "CAST(o_orderkey % 30 * 1000 + 1500 AS BIGINT)"


@query(f"""SELECT o_orderkey, {AMOUNT_SQL} AS amount, CASE WHEN o_orderkey % 4 = 0 THEN 'leading_amount_violations_wording' ELSE 'leading_amount' END AS basis, CAST({AMOUNT_SQL} AS VARCHAR) AS amounts FROM orders""")
def money_regex(spark, d) -> DataFrame:
    lead = text.lead_penalty(F.col("said"))
    return _notices(spark, d).select("o_orderkey", lead["amount"].alias("amount"), lead["basis"].alias("basis"), F.array_join(F.transform(text.money(F.col("said")), lambda x: x.cast("string")), ";").alias("amounts"))


@query("""SELECT o_orderkey, CAST(o_orderkey % 800 + 1 AS VARCHAR) AS number, (CASE o_orderkey % 3 WHEN 0 THEN 'EAST ' WHEN 1 THEN 'WEST ' ELSE 'EAST ' END) || (o_orderkey % 89 + 4) || ' STREET' AS street,
CASE o_orderkey % 4 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Bronx' WHEN 2 THEN 'Queens' ELSE '' END AS borough, 'Holder ' || o_orderkey || ' LLC' AS respondent, true AS anchored FROM orders""")
def notice_parse(spark, d) -> DataFrame:
    df = _notices(spark, d).withColumns({"a": F.get(address.extract_addresses(F.col("said")), F.lit(0)), "who": segment.respondent(F.col("said"))})
    return df.select("o_orderkey", F.col("a.number").alias("number"), address.canonical_street(F.col("a.street")).alias("street"), F.coalesce("a.borough", F.lit("")).alias("borough"), F.col("who.respondent").alias("respondent"), F.col("a.anchored").alias("anchored"))


@query("""SELECT o_orderkey, CAST(1000000 + o_orderkey % 8999999 AS VARCHAR) AS bin FROM orders""")
def extract_identifiers(spark, d) -> DataFrame:
    return _notices(spark, d).select("o_orderkey", F.array_join(address.identifiers(F.col("said"))["bin"], ";").alias("bin"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders""")
def date_parse(spark, d) -> DataFrame:
    return _notices(spark, d).select("o_orderkey", text.written_date(F.col("said"))["date"].alias("day"))


@query("""WITH n AS (SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9$]+', ' ', 'g')) AS norm, CAST(doc_id // 10 AS VARCHAR) AS bulletin FROM documents), f AS (SELECT *, first_value(doc_id) OVER w AS first_id, first_value(bulletin) OVER w AS first_bulletin FROM n
WINDOW w AS (PARTITION BY md5(norm) ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) SELECT doc_id, CASE WHEN first_bulletin <> bulletin THEN CAST(first_id AS VARCHAR) ELSE '' END AS duplicate_of, CASE WHEN first_bulletin <> bulletin THEN 'identical_text' ELSE '' END AS duplicate_basis FROM f""")
def dup_first_occurrence(spark, d) -> DataFrame:
    """Documents as actions of bulletins of ten, without addresses."""
    blank = {c: F.lit("") for c in ("address_street", "address_number", "respondent")} | {"penalty_amount": F.lit(None).cast("int")}
    df = T(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("enforcement_id"), F.floor(F.col("doc_id") / 10).alias("bulletin_id"), text.normalised(F.col("text")).alias("norm"))
    return segment.duplicates(df.withColumns(blank)).select(F.col("enforcement_id").cast("long").alias("doc_id"), "duplicate_of", "duplicate_basis")


@query("""WITH n AS (SELECT doc_id, doc_id // 100 AS bulletin, left(sha1(trim(regexp_replace(lower(text), '[^a-z0-9$]+', ' ', 'g'))), 10) AS h FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY bulletin, h ORDER BY doc_id) AS n FROM n)
SELECT doc_id, 'EA-' || lpad(CAST(bulletin AS VARCHAR), 6, '0') || '-' || h || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS enforcement_id FROM r""")
def stable_ids(spark, d) -> DataFrame:
    df = T(spark, d, "documents").select(F.col("doc_id").alias("entry"), F.floor(F.col("doc_id") / 100).alias("bulletin_id"), text.normalised(F.col("text")).alias("norm"))
    out = segment.stable_ids(df, F.lpad(F.col("bulletin_id").cast("string"), 6, "0"))
    return out.select(F.col("entry").alias("doc_id"), "enforcement_id")


@query("""SELECT string_agg(CAST(doc_id AS VARCHAR), ';' ORDER BY doc_id) AS ids, count(*) AS n FROM documents GROUP BY md5(text) HAVING count(*) > 1""")
def duplicate_groups(spark, d) -> DataFrame:
    per = T(spark, d, "documents").groupBy(F.md5("text").alias("h")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"), F.count("*").alias("n")).filter("n > 1")
    return per.select(F.array_join(F.transform("ids", lambda x: x.cast("string")), ";").alias("ids"), "n")


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents), s AS (SELECT *, CASE WHEN length(line) < 20 THEN 1 ELSE 0 END AS head FROM l),
g AS (SELECT *, sum(head) OVER (PARTITION BY doc_id ORDER BY pos) AS entry FROM s) SELECT doc_id, CAST(entry AS BIGINT) AS entry, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM g GROUP BY 1, 2""")
def line_segmentation(spark, d) -> DataFrame:
    """Gaps and islands: a line of under 20 characters begins a new entry."""
    lines = T(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = lines.withColumn("entry", F.sum((F.length("line") < 20).cast("long")).over(w))
    return marked.groupBy("doc_id", "entry").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


@query("""WITH l AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\x0B\\f\\r]*\\n[ \\t\\n\\x0B\\f\\r]*', chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM documents)
SELECT doc_id, md5(regexp_replace(regexp_replace(t, '-\\n(\\p{Ll})', '-\\1', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS paragraph FROM l""")
def join_lines(spark, d) -> DataFrame:
    return T(spark, d, "documents").select("doc_id", F.md5(text.join_lines(F.split("text", "\n"))).alias("paragraph"))


# Wording that occurs in the driver's documents, by tier.
DOCUMENT_WORDING = (("strong", "license", r"(?i)license"), ("moderate", "public", r"(?i)public"), ("moderate", "token", r"(?i)token\s*="), ("weak", "the", r"(?i)\bthe\b"))


@query("""WITH h AS (SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '(?i)license') THEN 'license' END, CASE WHEN regexp_matches(text, '(?i)public') THEN 'public' END, CASE WHEN regexp_matches(text, '(?i)token\\s*=') THEN 'token' END,
CASE WHEN regexp_matches(replace(text, 'of the', ' '), '(?i)\\bthe\\b') THEN 'the' END], lambda x: x IS NOT NULL) AS hits FROM documents)
SELECT doc_id, CASE WHEN len(hits) = 0 THEN '' WHEN hits[1] = 'license' THEN 'strong' WHEN hits[1] IN ('public', 'token') THEN 'moderate' ELSE 'weak' END AS tier, array_to_string(hits, ';') AS hits FROM h""")
def detect_tiers(spark, d) -> DataFrame:
    said = F.col("text")
    found = text.detect(said, text.blank_out(said, F.array(F.lit("of the"))), DOCUMENT_WORDING)
    return T(spark, d, "documents").select("doc_id", found["tier"].alias("tier"), F.array_join(found["hits"], ";").alias("hits"))


@query("""SELECT page_id, count(*) AS links, count(DISTINCT href) AS targets FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"#]*)', 1)) AS href FROM pages) GROUP BY page_id""")
def link_extract(spark, d) -> DataFrame:
    return readers.links(T(spark, d, "pages")).groupBy("page_id").agg(F.count("*").alias("links"), F.countDistinct("href").alias("targets"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"n":' || (event_id % 7) || '}' AS again FROM events""")
def json_props(spark, d) -> DataFrame:
    k = F.from_json("props", "k bigint")["k"]
    return T(spark, d, "events").select("event_id", k.alias("k"), F.to_json(F.struct((F.col("event_id") % 7).alias("n"))).alias("again"))


@query(f"""SELECT doc_id, length(text) < 40 OR (length(text) < 120 AND NOT regexp_matches(regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+$', ''), '[.”")]$')) AS truncated, regexp_matches(text, '{rules.PROFESSIONAL}') AS professional,
len(list_distinct(regexp_extract_all(text, '\\b(of|and|the)\\b'))) = 1 AS single FROM documents""")
def text_flags(spark, d) -> DataFrame:
    t = F.col("text")
    one = F.size(F.array_distinct(F.regexp_extract_all(t, F.lit(r"\b(of|and|the)\b"), F.lit(1)))) == 1
    return T(spark, d, "documents").select("doc_id", review.truncated(t).alias("truncated"), t.rlike(rules.PROFESSIONAL).alias("professional"), one.alias("single"))


@query("""WITH l AS (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^[ \\t\\x0B\\f\\r]+|[ \\t\\x0B\\f\\r]+$', '', 'g') AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS bulletin_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS entry, 'Bronx' AS section, 1 AS page, true AS had_bullet, md5(regexp_replace(line, '[ \\t\\x0B\\f\\r]+', ' ', 'g')) AS text_md5 FROM l WHERE line <> ''""")
def entry_segmentation(spark, d) -> DataFrame:
    """Documents as bulletins of one page whose lines are bulleted entries, with their opening phrase and section."""
    out = segment.split_entries(_bulletins(spark, d))
    return out.select("bulletin_id", "entry", "section", "page", "had_bullet", F.md5(text.join_lines(F.col("lines"))).alias("text_md5"))


def _bulletins(spark, d) -> DataFrame:
    glyph = F.lit(rules.BULLETS[0])
    opening = F.when(F.col("doc_id") % 2 == 0, "Individual enforcement highlights\nfor May 2024:\nBronx\n").otherwise("BUILD SAFE | LIVE SAFE\nThese are the individual enforcement\nhighlights for\nMay 2024\n12\nBronx\n")
    pages = F.array(F.concat(opening, glyph, F.lit(" "), F.replace("text", F.lit("\n"), F.concat(F.lit("\n"), glyph, F.lit(" ")))))
    return T(spark, d, "documents").select(F.col("doc_id").cast("string").alias("bulletin_id"), pages.alias("pages"))


@query("""WITH l AS (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '[ \\t\\x0B\\f\\r]+', '', 'g') AS line FROM documents), n AS (SELECT doc_id, count(*) FILTER (line <> '') AS full, count(*) FILTER (line = '') AS empty FROM l GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS bulletin_id, true AS has_text, false AS needs_ocr, 1 AS n_pages, CAST(length(text) + 2 * (length(text) - length(replace(text, chr(10), ''))) + 2 + CASE WHEN doc_id % 2 = 0 THEN 54 ELSE 93 END AS INTEGER) AS n_chars, 'plain' AS extraction_method,
CAST(n.full AS INTEGER) AS n_entries, CAST(n.full AS INTEGER) AS n_bulleted, CAST(n.empty AS INTEGER) AS empty_bullets, true AS marker_found, 0 AS notes FROM documents JOIN n USING (doc_id)""")
def parse_diagnostics(spark, d) -> DataFrame:
    out = segment.diagnose(_bulletins(spark, d).withColumns({"method": F.lit("plain"), "has_text_layer": F.lit(True)}))
    return out.withColumn("notes", F.size("notes"))


# One wording of each tier rule, and one of each violation category, with what it must be read as.
TIER_CASES = (
    ("the privately-owned public space", "strong", "privately owned public space;public space"), ("a POPS there", "strong", "POPS"), ("the public plaza", "moderate", "public plaza;plaza"),
    ("a public  space", "moderate", "public space"), ("a publicly accessible lobby", "moderate", "publicly accessible"), ("its public access area", "moderate", "public access area"),
    ("discretionary zoning", "moderate", "discretionary zoning"), ("ZR 37-625", "moderate", "zoning resolution ch.37"), ("a public pedestrian/bike path", "moderate", "public pedestrian path"), ("Some Plaza", "weak", "plaza"),
    ("an open-air café", "weak", "open air cafe"), ("the arcade", "weak", "arcade"), ("a through-block lobby", "weak", "through-block / covered pedestrian space"), ("a pops quiz", "", ""), ("Named Plaza of the owner", "", ""),
)
CATEGORY_CASES = (
    ("the gate was padlocked", "access / closure"), ("two benches", "seating"), ("dead flowers", "landscaping"), ("three trees", "trees"), ("a plaque", "signage"), ("the reflecting pool", "fountain / water feature"),
    ("a bike rack", "bicycle parking"), ("deteriorated stone and graffiti", "maintenance"), ("a restaurant inside", "unauthorized private use"), ("an unapproved wall", "unauthorized design modification"),
    ("impeded walkways", "obstruction"), ("open 24 h", "hours"), ("no such word", "other"), ("chairs beside trees", "seating;trees"),
)


def _cases(column: str, cases: tuple, at: int) -> str:
    return f"CASE {column} % {len(cases)} " + " ".join(f"WHEN {k} THEN '{c[at]}'" for k, c in enumerate(cases)) + " END"


@query(f"""SELECT o_orderkey, {_cases("o_orderkey", TIER_CASES, 1)} AS tier, {_cases("o_orderkey", TIER_CASES, 2)} AS hits FROM orders""")
def wording_tiers(spark, d) -> DataFrame:
    """Orders as notices with one wording each; weak wording in the respondent's name does not count."""
    df = T(spark, d, "orders").selectExpr("o_orderkey", f"concat('Work at ', {_cases('o_orderkey', TIER_CASES, 0)}, ' was seen') as said")
    found = text.detect(F.col("said"), text.blank_out(F.col("said"), F.array(F.lit("Named Plaza"), F.lit(""))))
    return df.select("o_orderkey", found["tier"].alias("tier"), F.array_join(found["hits"], ";").alias("hits"))


@query(f"""SELECT o_orderkey, {_cases("o_orderkey", CATEGORY_CASES, 1)} AS categories FROM orders""")
def violation_categories(spark, d) -> DataFrame:
    df = T(spark, d, "orders").selectExpr("o_orderkey", f"concat('Seen: ', {_cases('o_orderkey', CATEGORY_CASES, 0)}, '.') as said")
    return df.select("o_orderkey", F.array_join(text.classify(F.col("said"))["categories"], ";").alias("categories"))


# Addresses on an index page and what they mean there.
INDEX_PAGE = "https://city.example/site/docs/index.page?x=1"
LINK_CASES = (
    ('href="/a/b.pdf#p2"', "https://city.example/a/b.pdf"), ("href='c.pdf'", "https://city.example/site/docs/c.pdf"), ("class=x href=../d.pdf", "https://city.example/site/d.pdf"), ('HREF = "//other.example/e.pdf"', "https://other.example/e.pdf"),
    ('href="http://other.example/f.pdf?a=1&amp;b=2"', "http://other.example/f.pdf?a=1&b=2"), ('title="a > b" href="./g/../h.pdf?y"', "https://city.example/site/docs/h.pdf?y"), ('href="../../../i.pdf"', "https://city.example/i.pdf"),
)


@query(f"""SELECT page_id, {_cases("page_id", tuple((0, w) for _, w in LINK_CASES), 1)} AS href, 'label ' || page_id AS label FROM pages""")
def resolve_links(spark, d) -> DataFrame:
    """One anchor a page in the ways that pages write them, resolved against the page's own address."""
    written = F.element_at(F.array(*[F.lit(w) for w, _ in LINK_CASES]), (F.col("page_id") % len(LINK_CASES) + 1).cast("int"))
    html = F.concat(F.lit("<p>x</p><a name=top></a><A "), written, F.lit("> <b>label</b>\n"), F.col("page_id").cast("string"), F.lit("</a>"))
    return readers.links(T(spark, d, "pages").select("page_id", html.alias("html")), INDEX_PAGE).select("page_id", "href", "label")
