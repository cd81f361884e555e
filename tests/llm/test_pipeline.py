"""Each stage of the corpus pipeline, on what the stage before it kept."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F
from test_documents import WORD, shingles

import corpus_pipeline
from ledgerloom.llm import mixing, packing


def test_stages(spark, docs, tmp_path):
    folder = str(tmp_path)
    docs = docs.drop("taken").filter("doc_id is not null").dropDuplicates(["doc_id"])
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3 * k, 1, 0) for k in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    now, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        seen.append(now.collect())
        assert name == "packing" or tuple(now.columns) == corpus_pipeline.COLUMNS
    good, single, shorter, mixed, packed = seen
    assert len(good) == docs.count()  # all labels are good, so nothing is rejected

    sets = {r["doc_id"]: shingles(r["text"], 5) for r in good}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                i, j = sorted((find(a), find(b)))
                root[j] = i
    assert {r["doc_id"] for r in single} == {k for k in sets if find(k) == k}

    first: dict[bytes, int] = {}
    for r in sorted(single, key=lambda r: r["doc_id"]):
        data = (r["text"] or "").encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k : k + 50], r["doc_id"])
    want = {}
    for r in single:
        data = (r["text"] or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < r["doc_id"]:
                gone[k : k + 50] = True
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g).decode("utf-8", "ignore")
        if left or not gone.any():
            want[r["doc_id"]] = None if r["text"] is None else left
    assert {r["doc_id"]: r["text"] for r in shorter} == want

    amounts = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.read.parquet(f"{folder}/suffix_dedup"))[0].collect()}
    words = Counter()
    for r in mixed:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert words == Counter({k: v for k, v in amounts.items() if v})

    total, copies = defaultdict(int), Counter(r["doc_id"] for r in mixed)
    for r in packed:
        total[r["doc_id"]] += r["length"]
    encode = packing.Encoder(packing.vocabulary_path())
    expected = Counter()
    for r in mixed:
        expected[r["doc_id"]] += len(encode(r["text"])) // 4 + 1
    assert dict(total) == dict(expected) and set(copies) == set(total)
    assert len({(r["row_key"], r["piece"]) for r in packed}) == len(packed) and all(len(r["ids"]) == r["length"] for r in packed)
    whole = defaultdict(list)
    for r in sorted(packed, key=lambda r: (r["row_key"], r["piece"])):
        whole[r["row_key"]] += r["ids"]
    assert Counter(map(tuple, whole.values())) == Counter((*np.frombuffer(encode(r["text"]), "<u4").tolist(), 2) for r in mixed)


def test_stages_with_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    row = lambda i, t: (i, t, "en", "s", len(t or ""))
    text = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [row(None, text("a", 40)), row(None, text("a", 40)), row(7, text("b", 40)), row(7, text("b", 40)), row(7, text("c", 40)), row(None, text("d", 40)), row(3, text("d", 40)), row(None, None), row(None, None), row(7, "")]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, schema).repartition(3), "").collect()
    assert Counter(map(tuple, got)) == Counter([rows[0], rows[2], rows[4], rows[6], *rows[7:]])

    rows = [row(i, text(name, n)) for i, name, n in ((None, "short", 10), (None, "long", 1000), (5, "e", 30), (5, "f", 600))]
    mixed = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, schema).repartition(3), "").collect()
    words, most = Counter(), Counter()
    for r in mixed:
        assert (r["doc_id"] is None) == r["text"].startswith(("short", "long"))
        words[r["text"].split("0")[0]] += len(r["text"].split())
        most[r["text"].split("0")[0]] += 1
    assert sum(words.values()) == 1.5 * 1640
    assert all(words[name] <= 2 * n and most[name] <= 2 for name, n in (("short", 10), ("long", 1000), ("e", 30), ("f", 600)))


def test_stages_on_hard_tables(spark, docs, no_docs, tmp_path):
    """Empty tables, clashing names, and documents that the classifier rejects."""
    folder = str(tmp_path)
    bad = "buy cheap spam now click here win money fast loser "
    rows = [(k, (bad * 3 if k % 2 else f"a calm account of the river number {k} and its towns"), "en", "s", 1, "x") for k in range(200)]
    made = spark.createDataFrame(rows, docs.schema)
    spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.select_quality(spark, made, folder).collect()}
    assert kept == {k for k in range(200) if k % 2 == 0}
    empty = no_docs.withColumnRenamed("taken", "size")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and (name == "packing" or tuple(out.columns) == corpus_pipeline.COLUMNS)
    clashing = made.withColumnsRenamed({"taken": "key"}).withColumns({"id": F.lit(1), "size": F.lit(2), "slot": F.lit(3), "component_id": F.lit(4), "length": F.lit(5)})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, clashing, folder).count() > 0
