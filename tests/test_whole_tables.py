"""Queries over whole tables on small fixtures."""

from __future__ import annotations

import datetime
import hashlib

from ledgerloom.plans import registry


def test_months_of_customers_with_large_keys(spark, tmp_path):
    rows = [(k, 5_000 + k, datetime.date(2024, m, 1)) for k, m in enumerate([1] * 4 + [2] * 4 + [3] * 4 + [5] * 20)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    assert [tuple(r) for r in registry.QUERIES["missing_months_anti"](spark, str(tmp_path)).collect()] == [("2024-04",)]
    got = {r["bulletin_id"]: (r["n_entries"], r["is_outlier"]) for r in registry.QUERIES["rolling_upper_median"](spark, str(tmp_path)).collect()}
    assert got == {"2024-01": (4, False), "2024-02": (4, False), "2024-03": (4, False), "2024-05": (20, True)}


def test_join_lines_repairs_hyphens_of_documents(spark, tmp_path):
    rows = [(1, "site-\nsafety rules\n\n Next\npart-\nTwo"), (2, "plain\nlines"), (3, "end-\n"), (4, "pre- \n war-\n\ntime"), (5, ""), (6, "0 at\n1 digits 1\n21 2")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {1: "site-safety rules Next part- Two", 2: "plain lines", 3: "end-", 4: "pre-war-time", 5: "", 6: "0 at 1 digits 1 21 2"}
    got = {r["doc_id"]: r["paragraph"] for r in registry.QUERIES["join_lines"](spark, str(tmp_path)).collect()}
    assert got == {k: hashlib.md5(v.encode()).hexdigest() for k, v in want.items()}
