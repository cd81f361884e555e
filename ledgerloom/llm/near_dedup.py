"""Near-duplicate documents by min-max hashing.

Every permutation of a document's shingles gives two signature values, its minimum and its maximum, so half the hash
evaluations of plain min-hashing fill the same bands. Documents that share a band are candidates, and each link is confirmed
by the Jaccard similarity of the full sets.

1. One Arrow pass gives the size of the set, two digests of it and the band keys; equal sets become one class.
2. The centre of a band is its class with the most partners over all bands: among edited copies of one text that is the text
   they come from. Round one confirms one edge a class (to the best centre of its bands), round two the edges to the centres
   of all its bands between different components, round three all pairs of a band between different components. A large group
   of near copies is one component after the first rounds and makes no pairs; links inside a component need no check. Pairs
   that a parity sketch of the sets proves to be below the threshold are not made.
3. Sets are built anew from the text for classes with candidates only; components come from star rounds.

With 160 values in 32 bands of 5, a pair at similarity 0.8 shares no band with probability 3e-6.

Edge cases: a text without words (or null) has an empty set, links with nothing and is kept; fewer words than a shingle are one
shingle; rows of one doc_id are one document for linking (any of their sets may link); a null doc_id links with nothing and is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Prefixes, cut, give_back, mixed, table, utf8, whole_documents, words
from .graph import components

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WIDTH = 48  # bits of a shingle's hash
CELLS = 512  # bits of the parity sketch


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(i, j, first, hashes): for documents i to j, sorted distinct shingle hashes; those of document d begin at first[d - i]."""
    raw, off = utf8(texts)
    raw = _LOWER[raw]
    for i, j in whole_documents(off):
        a, own = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        starts, ends, first = words(a, own)
        h = Prefixes(a)(starts, ends)
        n = np.diff(first)
        joined = np.zeros(len(h), np.uint64)
        for k in range(width):
            joined[: len(h) - k] = joined[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
        doc = np.repeat(np.arange(j - i), n)
        rank = np.arange(len(h)) - np.repeat(first[:-1], n)
        keep = rank <= np.repeat(np.maximum(n - width, 0), n)
        for d in np.flatnonzero((n > 0) & (n < width)):  # the whole sequence is the shingle
            total = 0
            for k in range(first[d], first[d + 1]):
                total = (total * 0x9E3779B97F4A7C15 + int(h[k]) + 1) & 0xFFFFFFFFFFFFFFFF
            joined[first[d]] = total
            keep[first[d] + 1 : first[d + 1]] = False
        values, doc = mixed(joined[keep]) >> np.uint64(64 - WIDTH), doc[keep]
        if j - i < 1 << (64 - WIDTH):
            both = np.unique(values | doc.astype(np.uint64) << np.uint64(WIDTH))
            doc, values = (both >> np.uint64(WIDTH)).astype(np.int64), both & np.uint64((1 << WIDTH) - 1)
        else:
            order = np.lexsort((values, doc))
            values, doc = values[order], doc[order]
            new = np.r_[True, (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])]
            values, doc = values[new], doc[new]
        yield i, j, np.searchsorted(doc, np.arange(j - i + 1)), values


def signatures(first: np.ndarray, values: np.ndarray, permutations: int) -> np.ndarray:
    """Minima and maxima of each non-empty set under the permutations: one row per set, 2 * permutations columns."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
    at = first[:-1][np.diff(first) > 0]
    out = np.zeros((len(at), 2 * permutations), np.uint64)
    if len(at):
        spread = mixed(values)
        for p in range(permutations):
            x = (spread ^ shifts[p]) * factors[p]
            out[:, p] = np.minimum.reduceat(x, at)
            out[:, permutations + p] = np.maximum.reduceat(x, at)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signature), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + (signature[:, k] >> np.uint64(20)))
        keys[:, b] = h
    return keys.view(np.int64)


def parity_sketches(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each set, CELLS bits as longs: whether an odd number of its items falls into the cell.

    Cells that differ between two sets number no more than the items that are in one set only, so they bound the similarity
    from above without error.
    """
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    odd = np.bincount(doc * CELLS + (values % np.uint64(CELLS)).astype(np.int64), minlength=n * CELLS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, CELLS), axis=1).view(np.int64)


def may_link(n, m, sketch, other, percent: int):
    """Condition that every pair at or above the similarity meets: D items in one set only need D * (100 + p) <= (n + m) * (100 - p)."""
    differing = sum((F.bit_count(sketch[k].bitwiseXOR(other[k])) for k in range(CELLS // 64)), F.lit(0))
    return differing * (100 + percent) <= (n + m) * (100 - percent)


def described(docs: DataFrame, width: int, permutations: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, d1, d2, bands, sketch of every document (bands is empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, first, values in shingle_sets(batch.column(1), width):
                n = np.diff(first)
                some = n > 0
                keys = band_keys(signatures(first, values, permutations), rows)
                digests = []
                for seed in (0x1234567, 0x89ABCDEF):
                    sums = np.r_[np.uint64(0), np.cumsum(mixed(values + np.uint64(seed << 16)))]
                    digests.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
                offsets = np.r_[0, np.cumsum(some) * keys.shape[1]].astype(np.int32)
                bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                cells = parity_sketches(first, values)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * cells.shape[1]), pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n), *map(pa.array, digests), bands, sketch], ["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"]
                )
        give_back()

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, items: the sorted hashes of the set as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, first, values in shingle_sets(batch.column(1), width):
                items = [values[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WIDTH // 8].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(items, pa.binary())], ["doc_id", "items"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, items binary")


def _items(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // WIDTH, 8), np.uint8)
    wide[:, : WIDTH // 8] = np.frombuffer(data, np.uint8).reshape(-1, WIDTH // 8)
    return wide.reshape(-1).view("<u8")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |A and B| >= percent * |A or B|, on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _items(x.as_py()), _items(y.as_py())
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    left, right = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, width: int = 2, percent: int = 80, permutations: int = 80, rows: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    seen = cut(described(docs, width, permutations, rows))
    classes = seen.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
    classes = classes.agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = cut(classes)
    members = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = members.join(shared, "band")
    fame = members.groupBy("rep").agg(F.sum("size").alias("fame"))
    members = cut(members.join(fame, "rep").select("band", "rep", "n", "fame"))
    lead = members.groupBy("band").agg(F.max(F.struct("fame", (-F.col("rep")).alias("minus"))).alias("lead"))
    members = cut(members.join(lead, "band").select("band", "rep", "n", "lead"))
    centre = -F.col("lead.minus")
    one = members.filter(F.col("rep") != centre).groupBy("rep").agg(F.max("lead").alias("lead")).select(centre.alias("a"), F.col("rep").alias("b"))
    one = one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = full_sets(docs.join(wanted, "doc_id", "left_semi"), width).dropDuplicates(["doc_id", "items"])
    sets = cut(sets)
    edges = cut(confirmed(one, sets, percent))
    sketches = classes.select("rep", "n", "sketch")
    done = one
    for last in (False, True):
        parts = components(edges)
        inside = members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep"))
        spread = inside.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("band")
        inside = inside.join(spread, "band").select("band", "rep", "n", "part", "lead").join(sketches, ["rep", "n"])
        centres = inside if last else inside.filter(F.col("rep") == -F.col("lead.minus"))
        left = centres.select("band", F.col("rep").alias("a"), F.col("n").alias("m"), F.col("part").alias("q"), F.col("sketch").alias("other"))
        alike = (F.col("q") != F.col("part")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        alike &= may_link(F.col("n"), F.col("m"), F.col("sketch"), F.col("other"), percent)
        pairs = left.join(inside, "band").filter(alike & (F.col("a") < F.col("rep")) if last else alike)
        pairs = pairs.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        edges = cut(edges.unionByName(confirmed(pairs, sets, percent)))
        done = done.unionByName(pairs)
    parts = components(edges)
    known = classes.select("d1", "d2", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    usable = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("d1"))
    out = seen.select("doc_id", "n_shingles", usable.alias("e1"), F.col("d2").alias("e2")).join(known, (F.col("e1") == F.col("d1")) & (F.col("e2") == F.col("d2")), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op5(spark, sf_dir: str) -> DataFrame:
    """Components of all documents whose sets of two-word shingles have a Jaccard similarity of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_distinct(list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])) END AS s FROM w
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS rep, len(any_value(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), item AS (
  SELECT rep, n, unnest(s) AS x FROM classes
), shared AS (
  SELECT a.rep AS a, b.rep AS b, count(*) AS common, any_value(a.n) AS n, any_value(b.n) AS m FROM item a JOIN item b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
), pairs AS (
  SELECT a, b FROM shared WHERE 100 * common >= 80 * (n + m - common)
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT a AS id, b AS other FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
), part AS (
  SELECT rep, s, least(rep, coalesce(min(other), rep)) AS component FROM classes LEFT JOIN reach ON reach.id = rep GROUP BY rep, s
)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept FROM sets LEFT JOIN part ON part.s = list_sort(sets.s)
"""
