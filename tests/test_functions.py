from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import address, stats, text


def column(spark, values, f, *more):
    """f over one column of values."""
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("v"), *more)).collect()]


STREETS = [
    ("W. 63rd St.", "WEST 63 STREET"), ("West Sixty-Third Street", "WEST 63 STREET"), ("Eighth Avenue", "8 AVENUE"), ("8th Ave", "8 AVENUE"), ("Sixth Avenue", "6 AVENUE"),
    ("Avenue of Americas", "6 AVENUE"), ("West 112 th St.", "WEST 112 STREET"), ("Eleventh Avenue", "11 AVENUE"), ("North 31 St", "NORTH 31 STREET"), ("1 st Place", "1 PLACE"),
    ("East 81st St.", "EAST 81 STREET"), ("Thirty Second St", "32 STREET"), ("Park Ave S", "PARK AVENUE SOUTH"), ("St. Ann Ave", "ST ANN AVENUE"), ("Oak St (aka Main)", "OAK STREET"),
]


def test_canonical_street(spark):
    assert column(spark, [a for a, _ in STREETS], address.canonical_street) == [b for _, b in STREETS]


@pytest.mark.parametrize(
    ("raw", "borough", "want"),
    [
        ("514-8", "Manhattan", ("range", 514, 518)), ("640-62", "Manhattan", ("range", 640, 662)), ("31-07", "Queens", ("queens", 31007, 31007)),
        ("84- 06", "Bronx", ("single", 84, 84)), ("12a", None, ("single", 12, 12)), ("x", None, None), ("", None, None), (None, None, None),
    ],
)
def test_house_number(spark, raw, borough, want):
    df = spark.createDataFrame([(raw, borough)], "raw string, borough string")
    got = df.select(address.house_number(F.col("raw"), F.col("borough"))).first()[0]
    assert (got and (got["kind"], got["low"], got["high"])) == want


def test_address_key(spark):
    df = spark.createDataFrame([("MN", "412", "Sixth Ave"), ("Bronx", "", "Main St"), (None, "1", "Main St")], "b string, n string, s string")
    assert [r[0] for r in df.select(address.address_key(F.col("b"), F.col("n"), F.col("s"))).collect()] == ["Manhattan|412|6 AVENUE", None, None]


ADDRESSES = [
    ("owner of 8 Lake Avenue, Manhattan, for", "8", "Lake Avenue"), ("at 2 Harborview Center, Queens", "2", "Harborview Center"), ("at 931 Avenue of Americas. Seen", "931", "Avenue of Americas"),
    ("at 1714 Avenue R, Brooklyn", "1714", "Avenue R"), ("at 61 St. Ann Place, Brooklyn", "61", "St. Ann Place"), ("at 4120 second Ave", "4120", "second Ave"), ("at 733 5 th Avenue. Seen", "733", "5th Avenue"),
]


def test_extract_addresses(spark):
    got = column(spark, [t for t, _, _ in ADDRESSES], address.extract_addresses)
    assert [(a[0]["number"], a[0]["street"]) for a in got] == [(n, s) for _, n, s in ADDRESSES]
    assert got[0][0]["borough"] == "Manhattan" and got[0][0]["anchored"]
    many = "lots in Queens, among them 1402 3rd Avenue, 268 East 92nd Street, and 41 North End Avenue, about"
    none, several, null = column(spark, ["with 12 tables and 60 stools on the Plaza", many, None], address.extract_addresses)
    assert none == [] and [a["number"] for a in several] == ["1402", "268", "41"] and null == []


def test_identifiers(spark):
    got = column(spark, ["BIN # 1034567, Block 731, Lot 42, BBL: 1007310042, Job No. 123456789, ECB violation 35123456K"], address.identifiers)[0]
    assert (got["bin"], got["block_lot"], got["bbl"], got["job_number"], got["ecb_violation"]) == (["1034567"], ["731/42"], ["1007310042"], ["123456789"], ["35123456K"])


def test_money_and_lead(spark):
    said = ["$22, 500 in total penalties issued to", "$4,000 in violations", "a $ sign, $5.50 and $1,234", ""]
    assert column(spark, said, text.money) == [[22500], [4000], [5, 1234], []]
    assert [r["amount"] for r in column(spark, said, text.lead_penalty)] == [22500, 4000, None, None]
    assert column(spark, said, text.lead_penalty)[1]["basis"] == "leading_amount_violations_wording"


@pytest.mark.parametrize(
    ("said", "tier"),
    [("a privately owned public space", "strong"), ("the public plaza", "moderate"), ("in the Plaza", "weak"), ("pops up", ""), ("POPS rules", "strong"), ("nothing", "")],
)
def test_detect(spark, said, tier):
    df = spark.createDataFrame([(said,)], "s string")
    assert df.select(text.detect(F.col("s"), F.col("s"))).first()[0]["tier"] == tier


def test_weak_wording_is_sought_without_addresses(spark):
    df = spark.createDataFrame([("at 5 Bedford Plaza, for",)], "s string")
    assert df.select(text.detect(F.col("s"), text.blank_out(F.col("s"), F.array(F.lit("5 Bedford Plaza"))))).first()[0]["tier"] == ""


def test_classify(spark):
    a, b = column(spark, ["Padlocked gate; broken benches and trees", "nothing of note"], text.classify)
    assert set(a["categories"]) == {"access / closure", "seating", "maintenance", "trees"} and b["categories"] == ["other"]
    assert a["terms"]["seating"] == ["benches"]


def test_join_lines_and_dates(spark):
    df = spark.createDataFrame([(["site-", "safety rules", "", " Next", "part-", "Two"],)], "x array<string>")
    assert df.select(text.join_lines(F.col("x"))).first()[0] == "site-safety rules Next part- Two"
    got = column(spark, ["on March 3rd, 2021 it", "February 30, 2020", "no date"], text.written_date)
    assert [g["date"] for g in got] == [dt.date(2021, 3, 3), None, None] and got[1]["text"] == "February 30, 2020"


def test_indel_ratio(spark):
    df = spark.createDataFrame([("PARK AVENUE", "PARK AVENUE SOUTH"), ("ABC", "ABC"), ("", "A"), ("EAST 57 STREET", "EAST 57 STRET")], "a string, b string")
    got = [round(r[0], 3) for r in df.select(text.indel_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [78.571, 100.0, 0.0, round(200 * 13 / 27, 3)]


def test_fisher_exact(spark):
    df = spark.createDataFrame([(15, 166, 24, 147), (30, 151, 4, 106)], "a long, b long, c long, d long")
    got = [r[0] for r in df.select(stats.fisher_exact(*[F.col(c) for c in "abcd"])).collect()]
    assert math.isclose(got[0], 0.0920340, abs_tol=1e-7) and math.isclose(got[1], 0.00058576, abs_tol=1e-8)
