"""Stored history, content under its hash, documents in parts, accounts and the analysis set."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import analytics, master, publish
from ledgerloom.session import numbered
from ledgerloom.sources import snapshots, versions


def site_rows(spark):
    df = spark.createDataFrame([("M1", "Bronx", "1975", "40.5", "24 h"), ("M2", "Queens", "", "x", " "), ("M3", "Queens", "1990", None, "")], "pops_id string, borough string, year_established string, latitude string, required_hours string")
    return df.withColumns({"building_name": F.lit("b"), "address_normalized": F.lit("1 A STREET")})


def export_rows(spark):
    rows = [("e1", "M1", "2024", "5", "900", "reviewed_confirmed", "2024-05", "3"), ("e2", "M1", "2024", "6", "", "needs_review", "2024-06", "1"), ("e3", "", "2024", "6", "5", "", "2024-06", "x")]
    df = spark.createDataFrame(rows, "enforcement_id string, pops_id string, bulletin_year string, bulletin_month string, penalty_amount string, manual_review_status string, bulletin_id string, source_page string")
    return df.withColumns({c: F.lit(c) for c in ("pops_relation", "violation_category", "enforcement_text", "pdf_url", "source_pdf", "owner")})


def tables(spark):
    rows = spark.createDataFrame([(1, "1 A Street", "No", "M1", "address_exact", "high"), (2, "2 B Street", "Yes", "", "none", "none")], "audit_row int, address string, outcome string, pops_id string, method string, confidence string")
    return publish.history(site_rows(spark), export_rows(spark), rows, audit_id="A1", inspected="2016", about={"url": "u0"})


def test_history_tables_have_their_schema(spark):
    made = tables(spark)
    assert {k: ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) for k, df in made.items()} == publish.HISTORY
    rows = {k: df.collect() for k, df in made.items()}
    assert {r["source_id"] for r in rows["source_document"]} == {"master", "A1", "bulletin_2024-05", "bulletin_2024-06"}
    assert {r["source_id"] for r in rows["pops_event"]} <= {r["source_id"] for r in rows["source_document"]}
    assert {r["pops_id"]: (r["latitude"], r["year_established"]) for r in rows["pops_site"]} == {"M1": (40.5, 1975), "M2": (None, None), "M3": (None, 1990)}
    assert {(r["enforcement_id"], r["penalty_amount"], r["source_page"], r["respondent"]) for r in rows["enforcement_action"]} == {("e1", 900, 3, "owner"), ("e2", None, 1, "owner")}
    assert [(r["audit_row"], r["pops_id"], r["full_compliance_as_printed"], r["audit_date"]) for r in rows["comptroller_audit"]] == [(1, "M1", "No", "2016"), (2, None, "Yes", "2016")]
    assert [(r["pops_id"], r["value_text"]) for r in rows["pops_requirement"]] == [("M1", "24 h")]
    assert all(not rows[k] for k in ("dob_inspection", "complaint_311", "pops_modification", "building_record"))


def test_history_is_rebuilt_in_place_and_read_by_bucket(spark, tmp_path):
    home = str(tmp_path / "history")
    shown = lambda name: sorted(map(tuple, spark.table(f"h1.{name}").collect()), key=str)
    publish.store(tables(spark), home, "h1", buckets=4)
    before = {name: shown(name) for name in [*publish.HISTORY, "pops_timeline"]}
    publish.store(tables(spark), home, "h1", buckets=4)
    assert {name: shown(name) for name in before} == before and len(before["pops_timeline"]) == 5
    assert versions.numbers(spark, f"{home}/pops_event") == [2] and not spark.catalog.tableExists("h1.pops_event_v1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per = spark.table("h1.pops_event").groupBy("pops_id").count()
        both = spark.table("h1.pops_event").join(spark.table("h1.pops_site"), "pops_id")
        assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df in (per, both)) and both.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_build_that_dies_leaves_the_views(spark, tmp_path):
    home = str(tmp_path / "history")
    publish.store(tables(spark), home, "h2")
    broken = tables(spark)
    broken["pops_event"] = broken["pops_event"].withColumn("summary", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception, match="stop"):
        publish.store(broken, home, "h2")
    assert spark.table("h2.pops_event").count() == 5 and spark.table("h2.pops_site").count() == 3
    publish.store(tables(spark), home, "h2")
    assert spark.table("h2.pops_timeline").count() == 5


def test_equal_contents_leave_one_copy(spark, tmp_path, monkeypatch):
    home, schema = str(tmp_path / "c"), "dataset_id string, updated string, content string"
    first = spark.createDataFrame([("a", "d1", "x"), ("b", "d1", "x"), ("c", "d1", "y")], schema)
    got = {r["dataset_id"]: (r["csv_file"], r["status"]) for r in snapshots.commit(first, home, "t1").collect()}
    assert got["a"][0] == got["b"][0] and got["a"][0].startswith("a_d1_") and [got[k][1] for k in "abc"] == ["downloaded", "unchanged", "downloaded"]
    again = {r["dataset_id"]: r["status"] for r in snapshots.commit(spark.createDataFrame([("a", "d2", "x"), ("d", "d2", "z")], schema), home, "t2").collect()}
    assert again == {"a": "unchanged", "d": "downloaded"}
    assert sorted(bytes(r["content"]) for r in snapshots.contents(spark, home).collect()) == [b"x", b"y", b"z"] and snapshots.manifest(spark, home).count() == 5
    real = versions.write

    def dying(df, where, version, **more):
        if where.endswith("/manifest"):
            raise RuntimeError("killed")
        real(df, where, version, **more)

    last = spark.createDataFrame([("e", "d3", "w")], schema)
    monkeypatch.setattr(versions, "write", dying)
    with pytest.raises(RuntimeError):
        snapshots.commit(last, home, "t3")
    assert snapshots.contents(spark, home).count() == 3
    monkeypatch.setattr(versions, "write", real)
    snapshots.commit(last, home, "t4")
    assert snapshots.contents(spark, home).count() == 4 and snapshots.manifest(spark, home).filter("sha256 is not null").count() == 6


def test_a_hot_site_has_bounded_documents(spark):
    kids = spark.range(5000).select(F.when(F.col("id") % 3 == 0, f"s{1}").otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string"))).alias("site"), (F.col("id") * 7919 % 5000).alias("seq"), F.lit("x").alias("status"))
    sites = kids.select("site").distinct().unionByName(spark.createDataFrame([("empty",)], "site string"))
    rows = master.nested_parts(sites, kids, "site", "seq", ["status"], size=100).collect()
    hot = sorted((r for r in rows if r["site"] == "s1"), key=lambda r: r["part"])
    assert [len(r["e"]) for r in hot] == [100] * 16 + [67] and {r["parts"] for r in hot} == {17} and [r["part"] for r in hot] == list(range(17))
    assert [x["seq"] for r in hot for x in r["e"]] == sorted(k * 7919 % 5000 for k in range(0, 5000, 3))
    assert [(r["part"], r["parts"], r["e"]) for r in rows if r["site"] == "empty"] == [(0, 1, [])] and sum(len(r["e"]) for r in rows) == 5000


def test_numbers_of_nulls_and_ties(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", None), ("a", 5), ("a", 5), ("", 1)], "key string, at int").repartition(3)
    got = sorted(((r["key"] is None, r["key"] or "", r["at"] or 0, r["number"]) for r in numbered(df, "key", "at").collect()))
    assert got == [(False, "", 1, 0), (False, "a", 0, 0), (False, "a", 5, 1), (False, "a", 5, 2), (True, "", 1, 0), (True, "", 2, 1)]


def test_accounts_have_their_audit_row(spark):
    acts = spark.createDataFrame([("e1", 1, "M1", "2024-05", 900, "pops_text_and_property_match", "auto_confirmed")], "enforcement_id string, seq int, pops_id string, ym string, penalty int, pops_relation string, review_status string")
    rows = spark.createDataFrame([(9, "M1", "Yes", "later", "low"), (4, "M1", "No", "seen", "high"), (5, "", "No", "", "none")], "audit_row int, pops_id string, outcome string, findings string, confidence string")
    got = {r["pops_id"]: r for r in analytics.accountability(site_rows(spark), acts, rows).collect()}
    a, b = got["M1"], got["M2"]
    assert (a["audit_row"], a["audit_outcome"], a["audit_findings"], a["audit_confidence"], a["in_audit"], a["last_precision"], a["borough"]) == ("4", "No", "seen", "high", True, "bulletin_month", "Bronx")
    assert (b["audit_row"], b["audit_outcome"], b["audit_findings"], b["in_audit"], b["last"], b["last_precision"], b["evidence_note"]) == ("", "", "", False, "", "", analytics.EVIDENCE_NOTE)


def test_the_analysis_set_is_complete(spark, tmp_path):
    from ledgerloom.sources import readers

    schema = "enforcement_id string, seq int, pops_id string, ym string, year int, penalty int, pops_relation string, review_status string, respondent string, tier string, duplicate_of string, pops_keyword_tier string"
    rows = [("e1", 1, "M1", "2020-05", 2020, 900, "pops_text_and_property_match", "auto_confirmed", "Acme Inc", "A", "", "strong"), ("e2", 2, "M1", "2021-06", 2021, 10, "pops_text_and_property_match", "auto_confirmed", "ACME", "A", "", "weak"), ("e3", 3, "M2", "2021-06", 2021, None, "property_match_only", "", "Solo", "C", "", "")]
    acts = spark.createDataFrame(rows, schema).withColumn("categories", F.array(F.lit("seating")))
    audit = spark.createDataFrame([(1, "M1", "No"), (2, "M2", "Yes"), (3, "", "Yes")], "audit_row int, pops_id string, outcome string")
    months = spark.createDataFrame([("2020-05",), ("2021-06",), ("2021-07",)], "bulletin_id string")
    accounts = analytics.accountability(site_rows(spark), acts, audit)
    made = analytics.tables(acts, site_rows(spark), accounts, months)
    readers.write_tables(made, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted(made) and len(made) == 8
    assert [tuple(r)[:2] for r in made["q5_entities"].collect()] == [("acme", 2)]
    assert [(r["year"], r["bulletins"], r["tierA_actions"], r["tierA_per_100_entries"]) for r in made["q7_by_year"].collect()] == [(2020, 1, 1, 100.0), (2021, 2, 1, 50.0)]
    assert {r["audit_group"]: (r["sites"], r["tierA"], r["any_linked_pct"]) for r in made["q10_audit_followup"].collect()} == {"no": (1, 1, 100.0), "yes": (1, 0, 100.0), "not_in_audit": (1, 0, 0.0)}
    one = analytics.full_summary(acts, accounts, months, audit, spark.createDataFrame([("open",), ("resolved",)], "status string")).first()
    assert (one["span"], one["bulletins"], one["repeat_sites"], one["repeat_entities"], one["last_wording"], one["bulletins_after"], one["audit_unlinked_rows"], one["review_open"]) == ("2020-05 to 2021-07", 3, 1, 1, "2020-05", 2, 1, 1)
    assert (one["q10_no"], one["q10_no_a"], one["q10_yes_a"], one["q9_old_with_a"], one["q9_new"]) == (1, 1, 0, 1, 1) and one["audit_status_counts"] == {"No": 1, "Yes": 2}
