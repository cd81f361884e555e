"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors of a label lexicographically by concatenated random-hyperplane bits and compares every vector
with the next `window` ones; all passes are laid out by one range exchange and cut into blocks of neighbouring rows that carry
a halo of `window` rows, so no pair of neighbours is lost between tasks. Pairs at or above the threshold are verified by their
exact cosine in double precision, and united across passes into components. The number of passes grows with the rows of the
label, see `passes_for`.

Identical vectors are one class before the passes, so exact copies cost one row. After the union, the links of each component
are counted over all its pairs, in blocks: a dense group larger than the window is thus counted whole.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label or a null id
link with nothing; vectors of different lengths link with nothing; repeated rows are vectors of their own and link with each
other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, table
from .graph import components


@lru_cache(64)
def planes(length: int, which: int, bits: int) -> np.ndarray:
    """The hyperplanes of one pass."""
    return np.random.default_rng([1000 + length, which]).standard_normal((length, bits))


def pass_keys(v: np.ndarray, which: int, bits: int) -> np.ndarray:
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    return (v @ planes(v.shape[1], which, bits) > 0) @ weights


def passes_for(n: int, *, threshold: float, window: int, recall: float, least: int) -> int:
    """Passes after which a pair at the threshold has met with probability `recall` in a label of n vectors spread about the origin.

    The pair meets in a pass if its first log2(n / window) bits agree; one bit does with probability 1 - angle / pi.
    """
    if n <= 2 * window:
        return least
    meets = (n / window) ** math.log2(1 - math.acos(max(-0.99, min(1.0, threshold))) / math.pi)
    return least if meets >= recall else max(least, math.ceil(math.log(1 - recall) / math.log1p(-meets)))


def linked(v: np.ndarray, w: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of cosine(v_i, w_j) >= threshold, in double precision."""
    norms = np.sqrt((v * v).sum(1))[:, None] * np.sqrt((w * w).sum(1))[None, :]
    return (v @ w.T) / norms >= threshold


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def keys(classes: DataFrame, bits: int) -> DataFrame:
    """One row per class and pass of its label: pass, label, size, key (the bits as one long), rep, v."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (_, passes), own in frame.groupby(["size", "passes"]):
                own, v = own.drop(columns="passes"), _matrix(own["v"])
                for p in range(int(passes)):
                    yield own.assign(key=pass_keys(v, p, bits), **{"pass": p})

    kind = classes.schema["v"].dataType.simpleString()
    return classes.select("label", "size", "rep", "v", "passes").mapInPandas(run, f"label string, size int, rep long, v {kind}, key long, pass int")


def near_pairs(laid: pd.DataFrame, window: int, threshold: float) -> pd.DataFrame:
    """(a, b): a spanning forest of the verified neighbours of one block, rows in order."""
    laid = laid.sort_values("position")
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for _, own in laid.groupby(["pass", "label", "size"], sort=False):
        if len(own) < 2:
            continue
        v, rep = _matrix(own["v"]), own["rep"].to_numpy(np.int64)
        for lo in range(0, len(own), 1024):
            hi = min(lo + 1024, len(own))
            far = min(hi + window, len(own))
            i, j = np.nonzero(linked(v[lo:hi], v[lo:far], threshold))
            near = (j > i) & (j - i <= window)
            a.append(rep[lo + i[near]])
            b.append(rep[lo + j[near]])
    if not a:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return forest(np.concatenate(a), np.concatenate(b))


def forest(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """The components of some pairs as stars around their smallest nodes."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, i, root[j])
        np.minimum.at(least, j, root[i])
        least = least[least]
        if (least == root).all():
            break
        root = least
    far = root != np.arange(len(nodes))
    return pd.DataFrame({"a": nodes[far], "b": nodes[root[far]]})


def near_duplicates(vectors: DataFrame, *, threshold: float = 0.93, passes: int = 12, bits: int = 48, window: int = 256, block: int = 1_024, recall: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    kind = "array<float>" if vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "array<double>"  # floats stay floats on their way
    x = F.col("embedding").cast(kind)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0)
    usable &= F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), x.alias("v"), F.coalesce(usable, F.lit(False)).alias("usable"))
    rows = rows.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(17), "v"))
    same = ["label", "h1", "h2"]
    classes = rows.filter("usable").groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min_by("v", "vec_id").alias("v"))
    classes = cut(classes.withColumn("size", F.size("v")))

    wanted = F.udf(lambda n: passes_for(n, threshold=threshold, window=window, recall=recall, least=passes), "int")
    labels = cut(classes.groupBy("label", "size").agg(F.count("*").alias("own")).withColumn("passes", wanted("own")))
    n_labels, total = labels.agg(F.count("*"), F.coalesce(F.sum(F.col("own") * F.col("passes")), F.lit(0))).first()
    labels = labels.drop("own")
    dense = classes.join(F.broadcast(labels) if n_labels <= 10_000 else labels, ["label", "size"])
    laid = keys(dense, bits).withColumn("at", F.struct("pass", "label", "size", "key", "rep"))
    n = max(1, -(-total // (8 * block)))
    laid = cut(laid.repartitionByRange(n, "at").sortWithinPartitions("at").drop("at").withColumn("row", F.monotonically_increasing_id()))
    part, inside = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = laid.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    laid = laid.withColumn("part", part).join(F.broadcast(starts) if n <= 100_000 else starts, "part").withColumn("position", F.col("start") + inside).drop("part", "start", "row")
    first = F.floor(F.col("position") / block)
    dealt = laid.withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("position") - window) / block)), first)))
    edges = dealt.groupBy("block").applyInPandas(lambda frame: near_pairs(frame, window, threshold), "a long, b long")

    found = components(edges)
    grouped = found.join(classes.select("rep", "n", "v"), found["node"] == F.col("rep")).select("component", "rep", "n", "v")
    counts = _links(grouped, threshold, max(64, found.count() // 2_048))
    per_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
    per_class = per_class.select(
        *[F.col(c).alias(f"k_{c}") for c in same],
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    on = [F.when(F.col("usable"), F.col(c)) == F.col(f"k_{c}") for c in same]
    out = rows.drop("v").join(per_class, on, "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))


def _links(members: DataFrame, threshold: float, crowds: int, block: int = 256) -> DataFrame:
    """rep, links: for each class, the vectors of other classes of its component linked to it.

    Components of more than `block` classes go by pairs of blocks, each pair a group of its own; the others are dealt to `crowds`.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    dealt = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    few, many = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.withColumn("lo", few).withColumn("hi", many)
    crowd = F.when(F.col("parts") > 1, F.xxhash64("component", "lo", "hi")).otherwise(F.pmod(F.xxhash64("component"), F.lit(crowds)))
    dealt = dealt.withColumn("crowd", crowd)

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, lo, hi), group in frame.groupby(["component", "lo", "hi"], sort=False):
            v, n, own, rep = _matrix(group["v"]), group["n"].to_numpy(np.int64), group["own"].to_numpy(), group["rep"].to_numpy(np.int64)
            left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            hits = linked(v[left], v[right], threshold)
            if lo == hi:
                np.fill_diagonal(hits, False)
            found.append((rep[left], hits @ n[right]))
            if lo != hi:
                found.append((rep[right], n[left] @ hits))
        return pd.DataFrame({"rep": np.concatenate([r for r, _ in found]), "links": np.concatenate([k for _, k in found]).astype(np.int64)})

    return dealt.groupBy("crowd").applyInPandas(count, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates among all vectors of equal label at cosine 0.93."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
  SELECT a AS id, b AS other FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other
), least AS (
  SELECT id, min(other) AS other FROM reach GROUP BY id
), n AS (
  SELECT a AS id, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(l.other, v.vec_id)) AS component_id, least(v.vec_id, coalesce(l.other, v.vec_id)) = v.vec_id AS kept
FROM v LEFT JOIN n ON n.id = v.vec_id LEFT JOIN least l ON l.id = v.vec_id
"""
