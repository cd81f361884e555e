"""Changed files, broken files, versioned tables and the streamed registry."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import review
from ledgerloom.sources import changes, readers, versions
from ledgerloom.streaming import incremental

OPENING = "These are the individual enforcement highlights for May 2024:\nManhattan\n"


def put(folder, name, entries=1, **more):
    said = OPENING + "\n".join(f"• $1,000 in penalties issued to Owner {k}, for {name}." for k in range(entries))
    doc = {"method": "m", "pages": [said], "n_pages": 1, "n_chars": len(said), "errors": [], "has_text_layer": True} | more
    (folder / f"{name}.json").write_text(json.dumps(doc))


def statuses(df):
    return {os.path.basename(r["path"]): r["status"] for r in df.collect()}


def test_versions_hide_half_written_ones_and_keep_the_last(spark, tmp_path):
    home, df = str(tmp_path / "t"), lambda k: spark.range(k).select("id")
    assert versions.read(spark, home, "id long").count() == 0 and versions.committed(spark, home) == []
    for k in (1, 2, 3):
        versions.write(df(k), home, k)
    assert versions.committed(spark, home) == [2, 3] and versions.read(spark, home, "id long").count() == 3 and versions.read(spark, home, "id long", 2).count() == 2
    df(9).write.parquet(versions.path_of(home, 4))
    (tmp_path / "t" / "v=0000000004" / "_SUCCESS").unlink()  # as if the writer had died
    assert versions.read(spark, home, "id long").count() == 3
    versions.write(df(4), home, 4)
    assert versions.read(spark, home, "id long").count() == 4 and versions.read_all(spark, home, "id long").count() == 7


def test_only_new_and_changed_files_are_read_again(spark, tmp_path):
    folder, home = tmp_path / "text", str(tmp_path / "home")
    folder.mkdir()
    for name in ("2024-01", "2024-02", "2024-03", "[odd] {name}*"):
        put(folder, name, 2)
    assert set(statuses(incremental.refresh(spark, str(folder), home, "t1")).values()) == {"new"}
    assert incremental.entries(spark, home).count() == 8
    assert set(statuses(incremental.refresh(spark, str(folder), home, "t2")).values()) == {"unchanged"} and versions.committed(spark, f"{home}/files") == [1]
    put(folder, "2024-02", 3)
    put(folder, "2024-04")
    (folder / "2024-03.json").unlink()
    os.utime(folder / "2024-01.json", (1, 1))
    got = statuses(incremental.refresh(spark, str(folder), home, "t3"))
    assert got == {"2024-01.json": "touched", "2024-02.json": "changed", "2024-03.json": "removed", "2024-04.json": "new", "[odd] {name}*.json": "unchanged"}
    rows = {r["bulletin_id"]: r for r in incremental.bulletins(spark, home).collect()}
    assert {k: (r["status"], r["version"], r["first_seen"], r["last_read"]) for k, r in rows.items()} == {
        "2024-01": ("ok", 1, "t1", "t1"), "2024-02": ("ok", 2, "t1", "t3"), "2024-03": ("removed", 1, "t1", "t3"), "2024-04": ("ok", 2, "t3", "t3"), "[odd] {name}*": ("ok", 1, "t1", "t1")}
    counts = {r[0]: r[1] for r in incremental.entries(spark, home).groupBy("bulletin_id").count().collect()}
    assert counts == {"2024-01": 2, "2024-02": 3, "2024-04": 1, "[odd] {name}*": 2}
    assert "touched" not in statuses(incremental.refresh(spark, str(folder), home, "t4")).values()
    put(folder, "2024-03")
    assert statuses(incremental.refresh(spark, str(folder), home, "t5"))["2024-03.json"] == "new"
    assert {r[0]: r[1] for r in incremental.bulletins(spark, home).select("bulletin_id", "first_seen").collect()}["2024-03"] == "t1"


def test_a_run_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    folder, home = tmp_path / "text", str(tmp_path / "home")
    folder.mkdir()
    put(folder, "2024-01", 2)
    real, seen = versions.write, []

    def dying(df, where, version, **more):
        if where.endswith("/files") and not seen:
            seen.append(where)
            raise RuntimeError("killed")
        real(df, where, version, **more)

    monkeypatch.setattr(versions, "write", dying)
    with pytest.raises(RuntimeError):
        incremental.refresh(spark, str(folder), home, "t1")
    assert incremental.entries(spark, home).count() == 0 and incremental.bulletins(spark, home).count() == 0
    incremental.refresh(spark, str(folder), home, "t2")
    assert incremental.entries(spark, home).count() == 2 and incremental.bulletins(spark, home).first()["first_seen"] == "t2"


def test_one_broken_file_among_ten_loses_no_row(spark, tmp_path):
    folder, home = tmp_path / "text", str(tmp_path / "home")
    folder.mkdir()
    for k in range(1, 10):
        put(folder, f"2024-{k:02}")
    whole = (folder / "2024-09.json").read_text()
    (folder / "2024-10.json").write_text(whole[: len(whole) // 2])
    incremental.refresh(spark, str(folder), home, "t1")
    rows = {r["bulletin_id"]: r["status"] for r in incremental.bulletins(spark, home).collect()}
    assert sorted(rows.values()) == ["corrupt"] + ["ok"] * 9 and rows["2024-10"] == "corrupt"
    assert incremental.entries(spark, home).count() == 9
    none = spark.createDataFrame([], "bulletin_id string, pdf_url string, sha256 string, downloaded boolean, processing_errors string, label_conflict boolean, filename_pattern_ok boolean, still_on_index boolean, index_label string")
    issues = review.bulletin_issues(none, incremental.bulletins(spark, home)).filter("issue_type = 'failed_extraction'").collect()
    assert [r["bulletin_id"] for r in issues] == ["2024-10"]
    (folder / "2024-09.json").write_text("{")  # a good file that breaks keeps what was read of it
    incremental.refresh(spark, str(folder), home, "t2")
    row = incremental.bulletins(spark, home).filter("bulletin_id = '2024-09'").first()
    assert (row["status"], row["n_entries"], row["version"], row["needs_ocr"]) == ("corrupt", 1, 1, True) and incremental.entries(spark, home).count() == 9
    put(folder, "2024-10", 4)
    incremental.refresh(spark, str(folder), home, "t3")
    assert incremental.entries(spark, home).count() == 13


def test_checked_reading_of_any_content(spark):
    good = json.dumps({"method": "m", "pages": ["x"], "n_pages": 1, "n_chars": 1, "errors": [], "has_text_layer": True})
    thin = json.dumps({"method": "needs_ocr", "pages": [], "n_pages": 0, "n_chars": 0, "errors": ["a: thin", "b: thin"], "has_text_layer": False})
    rows = [("/a/1.json", good.encode()), ("/a/2.json", thin.encode()), ("/a/3.json", b"{"), ("/a/4.json", b""), ("/a/5.json", b"\xff\xfe{}"), ("/a/6.json", None), ("/a/7.json", b"[1, 2]"), ("/a/8", good.replace('["x"]', '"x"').encode())]
    got = {r["bulletin_id"]: (r["status"], r["why"]) for r in readers.checked(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": "ok", "2": "no_text", "3": "corrupt", "4": "corrupt", "5": "corrupt", "6": "unreadable", "7": "corrupt", "8": "corrupt"}
    assert got["2"][1] == "a: thin; b: thin" and got["5"][1] == "not UTF-8" and got["6"][1] == "no content"


def test_comparing_a_listing_with_its_state(spark):
    found = spark.createDataFrame([("a", 1, "t"), ("b", 2, "t"), ("c", 3, "u"), ("d", 4, "t"), ("e", 5, "u")], "path string, size long, modified string")
    state = spark.createDataFrame([("a", 1, "t", "h"), ("b", 1, "t", "h"), ("c", 3, "t", "h"), ("e", 5, "t", "h"), ("f", 6, "t", "h")], "path string, size long, modified string, sha256 string")
    seen = changes.compare(found, state)
    assert {r["path"]: r["kind"] for r in seen.collect()} == {"a": "same", "b": "suspect", "c": "suspect", "d": "new", "e": "suspect", "f": "removed"}
    hashed = spark.createDataFrame([("b", "g"), ("c", "h"), ("d", "i")], "path string, sha256 string")
    out = changes.settle(seen, hashed)
    assert {r["path"]: (r["status"], r["sha256"]) for r in out.collect()} == {"a": ("unchanged", "h"), "b": ("changed", "g"), "c": ("touched", "h"), "d": ("new", "i"), "e": ("unreadable", "h"), "f": ("removed", "h")}
    assert {r["path"] for r in changes.state_after(out).collect()} == {"a", "b", "c", "d"}


def test_a_repeated_batch_leaves_the_same_registry(spark, tmp_path):
    home, schema = str(tmp_path / "registry"), "bulletin_id string, pdf_url string, seen string, seq long"
    first = spark.createDataFrame([("b1", "u0", "d0", 0), ("b1", "u1", "d1", 1), ("b2", "u2", "d1", 2)], schema)
    second = spark.createDataFrame([("b1", "u9", "d2", 3), ("b3", "u3", "d2", 4)], schema)
    rows = lambda: {tuple(r) for r in incremental.registry(spark, home).collect()}
    incremental.merge_batch(first, 0, home)
    incremental.merge_batch(second, 1, home)
    want = {("b1", "u9", "d1", "d2", True, "url_changed_from=u1"), ("b2", "u2", "d1", "d1", True, ""), ("b3", "u3", "d2", "d2", True, "")}
    assert rows() == want
    incremental.merge_batch(second, 1, home)  # killed after its write, and started again
    assert rows() == want
    (tmp_path / "registry" / "v=0000000002" / "_SUCCESS").unlink()  # killed within its write
    incremental.merge_batch(second, 1, home)
    assert rows() == want


def test_the_registry_as_a_stream(spark, tmp_path):
    schema = "bulletin_id string, pdf_url string, seen string, seq long"
    folder, home, state = (str(tmp_path / k) for k in ("in", "registry", "state"))
    for k in range(3):
        spark.createDataFrame([("b", f"u{k // 2}", f"d{k}", k), (f"own{k}", "v", f"d{k}", k)], schema).coalesce(1).write.mode("append").parquet(folder)
        incremental.upsert_registry(spark.readStream.schema(schema).parquet(folder), home, state)
    rows = {r["bulletin_id"]: (r["pdf_url"], r["date_discovered"], r["last_seen"], r["note"]) for r in incremental.registry(spark, home).collect()}
    assert rows["b"] == ("u1", "d0", "d2", "url_changed_from=u0") and rows["own1"] == ("v", "d1", "d1", "") and len(rows) == 4
    incremental.upsert_registry(spark.readStream.schema(schema).parquet(folder), home, state)
    assert incremental.registry(spark, home).count() == 4 and versions.committed(spark, home)[-1] == 3


def test_records_are_arrays(spark, tmp_path):
    df = spark.createDataFrame([("é", None), ("b", 2)], "name string, n int").coalesce(1)
    readers.write_records(df, str(tmp_path / "out"))
    (part,) = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    assert json.loads(part.read_text()) == [{"name": "é", "n": None}, {"name": "b", "n": 2}]
    readers.write_records(df.filter(F.lit(False)), str(tmp_path / "none"))
    assert spark.read.option("multiLine", True).schema("name string").json(str(tmp_path / "none")).count() == 0
