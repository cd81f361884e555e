"""Overlapping ranges, alike streets, passages, mentions, match notes and the review queue, against brute force where there is one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_operators import SITES, bulletins

from ledgerloom.functions import address, text
from ledgerloom.operators import audit, joins, master, publish, resolve, review, segment


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a and b else 0


def test_ratio_in_a_band_is_the_ratio(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ABC ") for _ in range(n))
    rows = [("", ""), ("A", ""), ("ABC", "ABC"), ("PARK AVENUE", "PARK AVENUE SOUTH")]
    for _ in range(150):
        a = list(word(rng.randint(1, 25)))
        b = a[:]
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "A", "B"])
        rows.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for floor in (70.0, 88.0):
        got = df.select("a", "b", text.indel_at_least(F.col("a"), F.col("b"), floor).alias("r")).collect()
        assert all(r["r"] == (pytest.approx(ratio(r["a"], r["b"])) if ratio(r["a"], r["b"]) >= floor else None) for r in got)


def test_rare_letter_pairs_find_all_alike_streets(spark):
    """All pairs of ratio 88 are found, from under a tenth of all pairs."""
    rng = random.Random(4)
    names = {" ".join("".join(rng.choice("ABCDEFGHIKLMNOPRSTUVW") for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 2))) + rng.choice([" STREET", " AVENUE"]) for _ in range(220)}
    names = sorted(names)
    asked = set()
    for n in names[:150]:
        b = list(n)
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(b))
            b[k : k + rng.randint(0, 1)] = rng.choice(["", "X", "E"])
        asked.add("".join(b))
    left = spark.createDataFrame([("Bronx", a) for a in sorted(asked)], "borough string, street string")
    right = spark.createDataFrame([("Bronx", n) for n in names], "borough string, street_canonical string")
    pairs = {(r["street"], r["street_canonical"]) for r in resolve.gram_pairs(left, right, ["borough"], "street", "street_canonical").collect()}
    want = {(a, n) for a in asked for n in names if ratio(a, n) >= 88}
    assert want <= pairs and len(want) > 100
    assert len(pairs) < 0.1 * len(asked) * len(names)


def test_overlaps_of_any_width_come_once(spark):
    rng = random.Random(6)
    span = lambda: (lo := rng.choice([rng.randint(0, 300), rng.randint(0, 90_000_000)]), lo + rng.choice([0, 0, 3, 70, 5_000, 2_000_000, -1]))
    left = [(k, rng.choice("ab"), *span()) for k in range(250)] + [(250, "a", None, 5), (251, None, 1, 5)]
    right = [(k, rng.choice("ab"), *span()) for k in range(250)] + [(250, "a", 5, None)]
    a = spark.createDataFrame(left, "i int, key string, lo int, hi int")
    b = spark.createDataFrame(right, "j int, key string, low int, high int")
    got = sorted((r["i"], r["j"]) for r in joins.overlapping(a, b, ["key"], ("lo", "hi"), ("low", "high")).collect())
    whole = lambda x: None not in x and x[2] <= x[3]
    want = sorted((x[0], y[0]) for x in left for y in right if whole(x) and whole(y) and x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    assert got == want and len(want) > 300


def test_a_hot_street_is_spread(spark):
    """A third of the rows have one street and number; no task of the join has more than a share of them, and no pair leaves its bin."""
    n = 6000
    rows = spark.range(n).select(F.col("id").alias("i"), F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("street"), F.lit(100).alias("lo"), F.lit(100).alias("hi"))
    sites = spark.createDataFrame([("m", "HOT", 90, 110)] + [(f"x{k}", "HOT", 10_000 * k, 10_000 * k + 4) for k in range(1, 200)], "site string, street string, low int, high int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("-1", "32", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        found = joins.overlapping(rows, sites, ["street"], ("lo", "hi"), ("low", "high"))
        per = [r["count"] for r in found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(per) == n // 3 and len(per) >= 4 and max(per) <= n // 3 / 2


def test_passages_both_ways(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 3)))
    texts = [(k, " ".join(word() for _ in range(rng.randint(0, 60)))) for k in range(80)] + [(80, None), (81, "")]
    items = []
    for k in range(60):
        t = rng.choice(texts[:80])[1]
        at = rng.randrange(len(t)) if t else 0
        items.append((k, t[at : at + rng.choice([1, 5, 30, 60])]))
    items += [(60, "nowhere to be found at all"), (61, None), (62, items[0][1])]
    docs, passages = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, k, t.index(p) + 1) for i, p in items if p for k, t in texts if t and p in t)
    body = dict(texts)
    want = [(i, k, at, body[k][max(at - 7, 1) - 1 :][:9]) for i, k, at in want]
    assert sorted(map(tuple, resolve.passages_in_text(docs, passages, before=7, shown=9).collect())) == want
    assert sorted(map(tuple, resolve.passages_in_text(docs, passages, before=7, shown=9, most_heads=5).collect())) == want  # too many for an automaton
    plan = resolve.passages_in_text(docs, passages)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_mentions_near_each_other_are_told_apart(spark):
    pages = spark.createDataFrame([(2, "a 12 Oak Street b 12 Oak St. c 12  oak street"), (1, "x/12 Oak Street, 5-12 Oak Street. 12 Oaks"), (3, "Appendix 12 Oak Street")], "page int, text string")
    rows = spark.createDataFrame([(1, "12 Oak Street"), (2, "5-12 Oak Street"), (3, "9 Oak Street"), (4, "12")], "audit_row int, address string")
    got = {r["audit_row"]: r["findings"].split(" || ") for r in audit.findings(pages, rows, before=3, after=2, most=9).collect()}
    assert got == {1: ["[p.1] x/12 Oak Street,", "[p.1] 5-12 Oak Street.", "[p.2] a 12 Oak Street b", "[p.2] b 12 Oak St. c", "[p.2] c 12 oak street"], 2: ["[p.1] t, 5-12 Oak Street."]}
    assert {r["audit_row"]: r["findings"] for r in audit.findings(pages, rows, most=1).collect()}[1].startswith("[p.1] x/12 Oak Street, 5-12")


def test_notes_of_a_match(spark):
    raw = spark.createDataFrame([(p, b, n, bo, num, s, name, "1980") for p, b, n, bo, num, s, name in SITES], "pops_id string, bbl string, bin string, borough string, num string, street string, building_name string, year string")
    sites = master.normalise(raw.union(raw.filter("pops_id = 'M3'").withColumn("pops_id", F.lit("M9"))))
    cases = [
        ("bbl", "BBL 1007310042", [("412", "6th Avenue", "Manhattan")]), ("bin", "BIN 1034567", []), ("far", "x", [("100", "E 61 St", "Manhattan")]), ("odd", "x", [("5", "Main St", None)]),
        ("two", "x", [("40-60", "Broad St", "Manhattan")]), ("range", "x", [("45", "Broad St", "Manhattan")]), ("name", "by the heron-tower 9, shut", [("200", "Park Ave", "Manhattan")]),
        ("none", "x", []), ("lost", "x", [("7", "Elm Road", "Bronx")]), ("geo", "x", [("1", "Elm Road", "Bronx"), ("2", "Elm Road", "Bronx")]),
    ]
    acts = spark.createDataFrame([(k, "", said, [(f"{n} {s}", n, s, b, True, 0, 1) for n, s, b in ads]) for k, said, ads in cases], f"action_id string, borough string, enforcement_text string, candidates {address.ADDRESS_TYPE}")
    acts = acts.withColumn("identifiers", address.identifiers(F.col("enforcement_text")))
    geo = spark.createDataFrame([("Manhattan|100|EAST 61 STREET", "1000000099", "", "ok"), ("Bronx|1|ELM ROAD", "2000000005", "2000005", "ok"), ("Bronx|2|ELM ROAD", "2000000005", "", "mismatch")], "query_key string, bbl string, bin string, status string")
    got = {r["action_id"]: r for r in resolve.match(acts, resolve.evidence(acts, sites, geo), sites).collect()}
    notes = {k: r["match_notes"] for k, r in got.items()}
    assert notes == {
        "bbl": "bbl via text; address agrees too", "bin": "bin via text", "far": "the geocoded bbl is not the site's",
        "odd": "not confirmed by the geocoder (not_geocoded); borough inferred from the only site with this address",
        "two": "not confirmed by the geocoder (not_geocoded); 2 candidates at level address_exact", "range": "number ranges overlap; 2 candidates at level address_range",
        "name": "one compass word more or less ('Park Ave' ~ 'PARK AVENUE SOUTH'); building name 'Heron-Tower 9' in the text", "none": "no address to look up", "lost": "no site at this address",
        "geo": "bbl via geocode",
    }
    far, geocoded = got["far"], got["geo"]
    assert (far["pops_id"], far["match_confidence"], far["match_score"], far["matched_address_key"]) == ("M2", "medium", 0.6, "Manhattan|100|EAST 61 STREET")
    assert (geocoded["pops_id"], geocoded["geocoded_bbl"], geocoded["geocoded_bin"], geocoded["geocode_status"]) == ("B1", "2000000005", "2000005", "ok;mismatch")
    assert got["none"]["geocode_status"] == "no_address" and got["lost"]["geocode_status"] == "not_geocoded"


def test_the_review_queue_of_a_run(spark):
    raw = spark.createDataFrame([(p, b, n, bo, num, s, name, "1980") for p, b, n, bo, num, s, name in SITES], "pops_id string, bbl string, bin string, borough string, num string, street string, building_name string, year string")
    sites = master.normalise(raw).withColumn("seq", F.col("pops_id"))
    pages = ["These are the individual enforcement highlights for May 2024:\nManhattan\n• $900 in fines issued to Holder, the owner of 9 Nowhere Avenue, for a shut public plaza near the Lark Hall Nr. 7 lobby, as was seen twice.\n• Short"]
    made = spark.createDataFrame([("2024-05", pages, "u", "p")], "bulletin_id string, pages array<string>, pdf_url string, source_pdf string")
    read = segment.parse(made)
    geo = spark.createDataFrame([], "query_key string, bbl string, bin string, status string")
    decisions = spark.createDataFrame([], "enforcement_id string, seq int, decision string, pops_id string, note string")
    acts = publish.run(made, sites, geo, decisions, read)
    registry = spark.createDataFrame([("2024-05", "u", "s", True, "", False, True, True, "l"), ("2024-07", "v", "t", True, "", False, True, True, "l")],
        "bulletin_id string, pdf_url string, sha256 string, downloaded boolean, processing_errors string, label_conflict boolean, filename_pattern_ok boolean, still_on_index boolean, index_label string")
    audited = spark.createDataFrame([(7, "no_match", "none", "none", "", "")], "audit_row int, match_status string, method string, confidence string, pops_id string, candidates string")
    none = spark.createDataFrame([], "review_id string, detected_at string")
    out = review.build(acts, sites, registry, segment.diagnose(made, read), none, decisions, "now", audit=audited, links=spark.createDataFrame([], "href string")).collect()
    kinds = [r["issue_type"] for r in out]
    assert set(kinds) == {"pops_keyword_without_db_match", "structure_change_index", "missing_bulletin_month", "comptroller_audit_link", "truncated_source_entry", "address_not_parsed"}
    assert [r["severity"] for r in out] == sorted((r["severity"] for r in out), key=["high", "medium", "low"].index)
    worded = out[kinds.index("pops_keyword_without_db_match")]
    assert worded["suggested_candidates"].startswith("M1 (Lark Hall Nr. 7") and "geocode not_geocoded" in worded["detail"]
    again = review.build(acts, sites, registry, segment.diagnose(made, read), spark.createDataFrame([(worded["review_id"], "before")], none.schema), decisions, "now")
    assert again.filter(F.col("review_id") == worded["review_id"]).first()["detected_at"] == "before"
