from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerloom.functions import address
from ledgerloom.operators import analytics, audit, master, publish, registry_ops, resolve, review, segment
from ledgerloom.sources import readers
from ledgerloom.streaming import incremental

PAGES = [
    "Build safe | live safe\nThese are the individual enforcement\nhighlights for\nMay 2024:\nManhattan\n• $22, 500 in total penalties issued to Acme Co. LLC, the owner of 412 9th Avenue, for\nfailing to maintain the public plaza.\n3",
    "It was seen on May 3, 2024.\n•\n• $4,000 in violations issued to Master Plumber John Doe, for work at 12 Main Street, Bronx.\nConstruction and Design Professionals\nLoose prose.\n$1,000 in fines issued to Jane Roe, for a sign.",
]


def bulletins(spark):
    return spark.createDataFrame([("2024-05", PAGES), ("2024-06", [])], "bulletin_id string, pages array<string>")


def test_segmentation(spark):
    rows = segment.split_entries(bulletins(spark)).orderBy("entry").collect()
    assert [(r["section"], r["page"], r["page_end"], r["had_bullet"]) for r in rows] == [
        ("Manhattan", 1, 2, True), ("Manhattan", 2, 2, True), ("Construction and Design Professionals", 2, 2, False)]
    assert rows[0]["empty_bullets"] == 1 and rows[0]["marker_found"]
    got = {r["bulletin_id"]: r.asDict() for r in segment.diagnose(bulletins(spark)).collect()}
    full, empty = got["2024-05"], got["2024-06"]
    assert (full["has_text"], full["needs_ocr"], full["n_pages"], full["n_chars"], full["n_entries"], full["n_bulleted"], full["empty_bullets"], full["marker_found"]) == (True, False, 2, sum(map(len, PAGES)), 3, 2, 1, True)
    assert full["notes"] == ["orphan line p2: Loose prose."] and full["extraction_method"] == ""
    assert (empty["has_text"], empty["needs_ocr"], empty["n_entries"], empty["notes"], empty["extraction_method"]) == (False, True, 0, ["no text layer"], "needs_ocr")


def test_diagnostics_of_what_was_extracted(spark):
    rows = [("a", ["Some prose\n• $5,000 in fines issued to A, for x."], "m", True), ("b", ["words"], "m", False), ("c", None, None, None), ("d", ["", None], "m", True)]
    df = spark.createDataFrame(rows, "bulletin_id string, pages array<string>, method string, has_text_layer boolean")
    got = {r["bulletin_id"]: (r["needs_ocr"], r["extraction_method"], r["n_pages"], r["n_entries"], r["notes"]) for r in segment.diagnose(df).collect()}
    none = ["no text layer"]
    assert got == {"a": (False, "m", 1, 1, [segment.NO_MARKER]), "b": (True, "needs_ocr", 1, 0, none), "c": (True, "needs_ocr", 0, 0, none), "d": (True, "needs_ocr", 2, 0, none)}
    counts = segment.entry_counts(segment.parse_entries(segment.split_entries(df))).collect()
    assert [tuple(r) for r in counts] == [("a", 1, 0)]


def test_parsed_fields(spark):
    rows = segment.parse_entries(segment.split_entries(bulletins(spark))).orderBy("entry").collect()
    a, b, c = rows
    assert (a["penalty_amount"], a["respondent"], a["borough"], a["primary"]["number"], a["primary"]["street"]) == (22500, "Acme Co. LLC", "Manhattan", "412", "9th Avenue")
    assert str(a["enforcement_date"]["date"]) == "2024-05-03"
    assert (b["respondent"], b["respondent_role"], b["borough"], b["borough_conflict"]) == ("John Doe", "Master Plumber", "Bronx", True)
    assert c["professional_section"] and c["borough"] == ""


def test_ids_are_stable_and_repeats_numbered(spark):
    df = spark.createDataFrame([("b", 0, "x"), ("b", 1, "x"), ("b", 2, "y")], "bulletin_id string, entry int, norm string")
    ids = [r[0] for r in segment.stable_ids(df, F.lit("202405")).orderBy("entry").select("enforcement_id").collect()]
    assert ids[1] == f"{ids[0]}-2" and ids[2] != ids[0] and ids == [r[0] for r in segment.stable_ids(df, F.lit("202405")).orderBy("entry").select("enforcement_id").collect()]


def test_duplicates_point_at_the_first_in_another_bulletin(spark):
    rows = [(1, "e1", "b1", "same", "", "", None, ""), (2, "e2", "b2", "same", "", "", None, ""), (3, "e3", "b1", "z", "Main St", "5", 9, "Acme"), (4, "e4", "b3", "w", "Main Street", "5", 9, "ACME"), (5, "e5", "b1", "same", "", "", None, "")]
    df = spark.createDataFrame(rows, "seq int, enforcement_id string, bulletin_id string, norm string, address_street string, address_number string, penalty_amount int, respondent string")
    got = segment.flag_duplicates(df).orderBy("seq").select("duplicate_of", "duplicate_basis").collect()
    assert [tuple(r) for r in got] == [("", ""), ("e1", "identical_text"), ("", ""), ("e3", "same_address_penalty_respondent"), ("", "")]
    assert "Window" not in segment.duplicates(df)._jdf.queryExecution().executedPlan().toString()


SITES = [
    ("M1", "1007310042", "1034567", "Manhattan", "412", "6 AVENUE", "Lark Hall Nr. 7"), ("M2", "1000000002", "1000000", "Manhattan", "100", "EAST 61 STREET", ""),
    ("M3", "1000000003", "1000003", "Manhattan", "40-60", "BROAD STREET", ""), ("M4", "1000000004", "1000004", "Manhattan", "200", "PARK AVENUE SOUTH", "Heron-Tower 9"),
    ("B1", "2000000005", "2000005", "Bronx", "5", "MAIN STREET", ""),
]


def link(spark, number, street, borough, said="text", geocodes=()):
    raw = spark.createDataFrame([(p, b, n, bo, num, s, name, "1980") for p, b, n, bo, num, s, name in SITES], "pops_id string, bbl string, bin string, borough string, num string, street string, building_name string, year string")
    one = [(f"{number} {street}", number, street, borough, True, 0, 1)] if number else []
    acts = spark.createDataFrame([("a", borough or "", said, one)], f"action_id string, borough string, enforcement_text string, candidates {address.ADDRESS_TYPE}").withColumn("identifiers", address.identifiers(F.col("enforcement_text")))
    geo = spark.createDataFrame(list(geocodes), "query_key string, bbl string, bin string, status string")
    sites = master.normalise(raw)
    return resolve.match(acts, resolve.evidence(acts, sites, geo), sites).first()


def test_match_levels(spark):
    r = link(spark, "412", "Sixth Avenue", "Manhattan", "BBL 1007310042")
    assert (r["pops_id"], r["match_method"], r["match_score"]) == ("M1", "bbl", 1.0)
    r = link(spark, None, None, "Manhattan", "BIN 1000000")
    assert r["match_status"] == "no_match"  # a placeholder building number links nothing
    r = link(spark, "412", "Avenue of the Americas", "Manhattan")
    assert (r["pops_id"], r["match_method"], r["match_confidence"]) == ("M1", "address_exact", "high")
    r = link(spark, "5", "Main St", None)
    assert (r["pops_id"], r["match_confidence"], r["match_score"]) == ("B1", "medium", 0.7)  # the borough was inferred
    r = link(spark, "45", "Broad St", "Manhattan")
    assert (r["pops_id"], r["match_method"]) == ("M3", "address_range")
    r = link(spark, "100", "West 61st St", "Manhattan")
    assert r["match_status"] == "no_match"  # east is not west
    r = link(spark, "200", "Park Avenue", "Manhattan")
    assert (r["pops_id"], r["match_method"], r["match_confidence"], r["match_score"]) == ("M4", "address_fuzzy", "low", 0.704)
    r = link(spark, "200", "Park Avenue", "Manhattan", "the HERON-Tower 9 lobby")
    assert r["match_confidence"] == "medium"


def test_review_and_overlay(spark):
    acts = spark.createDataFrame([("e", "pops_text_only", "none", "no_match", "", "none")], "enforcement_id string, pops_relation string, match_confidence string, match_status string, pops_id string, match_method string")
    dec = spark.createDataFrame([("e", 1, "reject", "", "n1"), ("e", 2, " Confirm", "M1", "n2")], "enforcement_id string, seq int, decision string, pops_id string, note string")
    r = resolve.overlay(acts, dec).first()
    assert (r["review_status"], r["pops_id"], r["match_method"], r["pops_relation"], r["review_note"]) == ("reviewed_confirmed", "M1", "manual", "pops_text_only", "n2")


def test_record_and_bulletin_issues(spark):
    acts = segment.parse_entries(segment.split_entries(bulletins(spark))).select("entry", "enforcement_text", "penalty_amount", "borough_conflict", "professional_section", F.coalesce("primary.raw", F.lit("")).alias("address_raw"))
    extra = {"enforcement_id": F.col("entry").cast("string"), "match_status": F.lit("ambiguous"), "match_confidence": F.lit("none"), "pops_relation": F.lit("pops_text_only"), "match_candidates": F.lit("a;b"), "pops_id": F.lit(""), "duplicate_of": F.lit("")}
    kinds = [r["issue_type"] for r in review.record_issues(acts.withColumns(extra)).collect()]
    assert kinds.count("ambiguous_pops_match") == 3 and kinds.count("borough_conflict") == 1 and "suspicious_penalty" not in kinds
    reg = spark.createDataFrame([("2024-05", "u", "s", False, "download_failed: y", False, True, True, "l"), ("unparsed:v", "v", "s", False, "x", True, False, False, "l"), ("2024-08", "u", "t", True, "", True, False, False, "l")],
        "bulletin_id string, pdf_url string, sha256 string, downloaded boolean, processing_errors string, label_conflict boolean, filename_pattern_ok boolean, still_on_index boolean, index_label string")
    read = segment.diagnose(bulletins(spark))
    got = {(r["issue_type"], r["bulletin_id"]) for r in review.bulletin_issues(reg, read).collect()}
    assert got == {
        ("bulletin_month_unparsed", "unparsed:v"), ("download_failed", "2024-05"), ("index_label_conflict", "2024-08"), ("structure_change_filename", "2024-08"), ("bulletin_removed_from_index", "2024-08"),
        ("missing_bulletin_month", "2024-06"), ("missing_bulletin_month", "2024-07"), ("duplicate_bulletin", "2024-05,unparsed:v"), ("duplicate_bulletin", "2024-05,2024-08"),
        ("empty_bullets_dropped", "2024-05"), ("failed_extraction", "2024-06"),
    }


def test_an_issue_keeps_its_id_when_its_wording_changes(spark):
    df = spark.createDataFrame([("e", "one"), ("e", "two")], "id string, said string")
    ids = {r["review_id"] for r in review.issue(df, "k", "low", F.lit(True), "id", F.col("said")).collect()}
    assert len(ids) == 1


def test_entry_counts_without_entries_are_no_outliers(spark):
    rows = [(f"b{k}", n) for k, n in enumerate([10, 10, 10, 0, 3, 30])]
    got = [r["is_outlier"] for r in review.entry_count_outliers(spark.createDataFrame(rows, "bulletin_id string, n_entries int")).orderBy("bulletin_id").collect()]
    assert got == [False, False, False, False, True, True]


def test_index_guard(spark):
    known = spark.createDataFrame([(True,)] * 10 + [(False,)], "still_on_index boolean")
    links = lambda n: spark.createDataFrame([("u",)] * n, "href string")
    assert [review.index_issues(links(n), known).count() for n in (0, 7, 8)] == [1, 1, 0]


def test_names_in_text(spark):
    texts = spark.createDataFrame([(1, "the LARK Hall no. 7"), (2, "larks hall no. 7"), (3, "by 12345x"), (4, "by 12345, shut"), (5, None)], "id int, said string")
    names = spark.createDataFrame([("L", " Lark Hall No. 7"), ("N", "12345"), ("G", "plaza"), ("S", "abc"), ("E", None)], "pops_id string, name string")
    assert {tuple(r) for r in resolve.names_in_text(texts, names, "id").collect()} == {(1, "L"), (4, "N")}


def test_passages_of_any_length(spark):
    docs = spark.createDataFrame([(1, "one two  three four five six"), (2, "xone twox"), (3, "one two  threes"), (4, None), (5, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "ne two  three fo"), (2, "one tw"), (3, "x"), (4, "two  three"), (5, "none such here")], "item_id long, text string")
    got = {(r["item_id"], r["doc_id"], r["place"]) for r in resolve.passages_in_text(docs, items).collect()}
    assert got == {(1, 1, 2), (2, 1, 1), (2, 2, 2), (2, 3, 1), (3, 1, 28), (3, 2, 1), (4, 1, 5), (4, 3, 5)}


def test_a_run_from_bulletins_to_the_export(spark):
    raw = spark.createDataFrame([(p, b, n, bo, num, s, name, "1980") for p, b, n, bo, num, s, name in SITES], "pops_id string, bbl string, bin string, borough string, num string, street string, building_name string, year string")
    sites = master.normalise(raw.union(raw.limit(1).select(F.lit("M9"), F.lit("9"), F.lit("9"), "borough", F.lit("412"), F.lit("9th Ave"), "building_name", "year")))
    made = bulletins(spark).withColumns({"pdf_url": F.lit("u"), "source_pdf": F.lit("p")})
    geo = spark.createDataFrame([], "query_key string, bbl string, bin string, status string")
    none = spark.createDataFrame([], "enforcement_id string, seq int, decision string, pops_id string, note string")
    acts = publish.run(made, sites, geo, none)
    rows = {r["respondent"]: r for r in acts.collect()}
    lead = rows["Acme Co. LLC"]
    assert len(rows) == 3 and (lead["pops_id"], lead["pops_relation"], lead["manual_review_status"], lead["pops_bbl"]) == ("M9", "pops_text_and_property_match", "auto_confirmed", "0000000009")
    assert "maintenance" in lead["violation_category"] and rows["Jane Roe"]["pops_relation"] == "none"
    out = publish.export(acts)
    assert out.columns[:4] == ["enforcement_id", "pops_id", "bbl", "bin"] and len(out.columns) == 42 and out.first()["owner"] == "Acme Co. LLC" and out.count() == 1
    decided = spark.createDataFrame([(lead["enforcement_id"], 1, "rejected", "", "n")], none.schema)
    assert publish.export(publish.run(made, sites, geo, decided)).count() == 0
    assert review.record_issues(acts).filter("issue_type = 'address_not_parsed'").count() == 0


def test_upsert_is_idempotent(spark):
    reg = spark.createDataFrame([], "bulletin_id string, pdf_url string, date_discovered string, last_seen string, still_on_index boolean, note string")
    found = spark.createDataFrame([("b1", "u1"), ("b2", "u2")], "bulletin_id string, pdf_url string")
    once = registry_ops.upsert(reg, found, "d1")
    assert once.exceptAll(registry_ops.upsert(once, found, "d1")).count() == 0
    later = {r["bulletin_id"]: r for r in registry_ops.upsert(once, found.filter("bulletin_id = 'b1'").withColumn("pdf_url", F.lit("u9")), "d2").collect()}
    assert later["b1"]["note"] == "url_changed_from=u1" and later["b1"]["date_discovered"] == "d1" and not later["b2"]["still_on_index"]


def test_geocodes_and_cache(spark):
    wanted = spark.createDataFrame([("k1",), ("k2",), ("k2",), ("k3",)], "query_key string")
    cache = spark.createDataFrame([("k1", "ok"), ("k2", "error:timeout"), ("old", "ok")], "query_key string, status string")
    assert {r[0] for r in registry_ops.to_geocode(wanted, cache).collect()} == {"k2", "k3"}
    fresh = spark.createDataFrame([("k2", "ok"), ("k3", "no_match")], "query_key string, status string")
    assert [tuple(r) for r in registry_ops.pruned_cache(cache, fresh, wanted).collect()] == [("k1", "ok"), ("k2", "ok"), ("k3", "no_match")]


def test_audit_rows_and_links(spark):
    pages = spark.createDataFrame([(1, "Appendix\n 1 412 Sixth Avenue - Lark Hall Yes\n 2 One Main Street - 5 Main Street No\n 3 12A Nowhere Road Yes\n 4 Broad Street No\n999 far Yes"), (2, "3 ignored Yes")], "page int, text string")
    rows = audit.appendix_rows(pages)
    assert {(r["audit_row"], r["address"], r["outcome"]) for r in rows.collect()} == {(1, "412 Sixth Avenue - Lark Hall", "Yes"), (2, "One Main Street - 5 Main Street", "No"), (3, "12A Nowhere Road", "Yes"), (4, "Broad Street", "No")}
    raw = spark.createDataFrame([(p, b, n, bo, num, s, name, "1980") for p, b, n, bo, num, s, name in SITES], "pops_id string, bbl string, bin string, borough string, num string, street string, building_name string, year string")
    got = {r["audit_row"]: (r["pops_id"], r["match_status"], r["confidence"]) for r in audit.link(rows, master.normalise(raw)).collect()}
    assert got == {1: ("M1", "matched", "high"), 2: ("B1", "matched", "medium"), 3: ("", "no_match", "none"), 4: ("M3", "matched", "low")}


def test_tiers_are_disjoint_and_complete(spark):
    kinds = ["pops_text_and_property_match", "pops_text_only", "property_match_only", "weak_keyword_only", "none"]
    status = ["auto_confirmed", "reviewed_confirmed", "needs_review", "reviewed_rejected", ""]
    df = spark.createDataFrame([(k, s) for k in kinds for s in status], "pops_relation string, review_status string").withColumn("tier", analytics.tier())
    got = {(r[0], r[1]): r[2] for r in df.collect()}
    assert got["pops_text_and_property_match", "auto_confirmed"] == "A" and got["pops_text_only", "reviewed_confirmed"] == "B" and got["pops_text_and_property_match", "reviewed_rejected"] is None
    assert got["property_match_only", ""] == "C" and all(got[k, s] is None for k in kinds[3:] for s in status)


def test_links_and_index(spark):
    html = (
        '<a href="http://x/assets/0524_enforcement_action_bulletin.pdf#p"></a><a href="http://x/assets/0524_enforcement_action_bulletin.pdf">May 2024 bulletin</a>'
        '<a href="http://x/0121_enforcement_action_bulletin.pdf">January 2020</a><a href="http://x/new_enforcement.pdf">March 2023 bulletin</a><a href="http://x/other.pdf">Other</a>'
    )
    found = readers.links(spark.createDataFrame([(1, html)], "page_id int, html string"))
    got = {r["pdf_url"].rsplit("/", 1)[1]: r for r in readers.bulletin_index(found).collect()}
    assert set(got) == {"0524_enforcement_action_bulletin.pdf", "0121_enforcement_action_bulletin.pdf", "new_enforcement.pdf"}
    assert got["0524_enforcement_action_bulletin.pdf"]["index_label"] == "May 2024 bulletin"
    assert got["0121_enforcement_action_bulletin.pdf"]["label_conflict"] and not got["new_enforcement.pdf"]["filename_pattern_ok"]
    assert (got["new_enforcement.pdf"]["bulletin_month"], got["new_enforcement.pdf"]["bulletin_year"]) == (3, 2023)


def test_files_round_trip_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([("a", 'x "y", z'), ("b", "")], "id string, said string")
    readers.write_csv(rows, str(tmp_path / "csv"))
    assert {tuple(r) for r in readers.read_csv_text(spark, str(tmp_path / "csv"), ["id", "said"]).collect()} == {("a", 'x "y", z'), ("b", "")}
    assert readers.read_or_empty(spark, str(tmp_path / "none"), ["id"]).count() == 0
    readers.append_manifest(rows, str(tmp_path / "csv"))
    assert readers.read_csv_text(spark, str(tmp_path / "csv"), ["id", "said"]).count() == 4
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "2024-05.json").write_text(json.dumps({"method": "m", "pages": PAGES, "n_pages": 2, "n_chars": 9, "errors": [], "has_text_layer": True}, indent=1))
    assert readers.read_bulletins(spark, str(folder)).first()["bulletin_id"] == "2024-05"
    for _ in range(2):  # the second run finds nothing new
        incremental.parse_new(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_snapshots(spark):
    m = spark.createDataFrame([(1, "f1", "t1"), (2, "f2", "t2"), (3, "f1", "t3")], "seq int, csv_file string, retrieved_at string")
    assert tuple(registry_ops.latest_snapshot(m).first()) == ("f1", "t1")
    files = spark.createDataFrame([("p", bytearray(b"x"))], "path string, content binary")
    seen = spark.createDataFrame([("2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881",)], "sha256 string")
    assert registry_ops.new_content(files, seen).count() == 0 and registry_ops.new_content(files, seen.filter("false")).count() == 1
