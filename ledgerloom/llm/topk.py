"""Exact top-k inner products of integer vectors with block-at-a-time pruning.

Documents are cut into blocks of alike rows: a stripe is halved at the median of its widest component until the parts are blocks,
and each block keeps the greatest and the least value of every component. For a query, q+ . max + q- . min bounds every score in
a block. A query visits its blocks by falling bound, a few and then twice as many at a time, scores them through the blocks' own
rows (the forward index), and stops when the next bound is below its k-th score; ties are kept, as they go to the smaller id.
What is pruned depends on the data: of vectors in clusters most blocks are, of vectors spread evenly in many dimensions none,
as no bound on a block lies below the k-th score there.

Rows are dealt into `stripes` by a hash of their id, and queries into groups; each (stripe, group) pair is a task of its own,
so neither side is collected and every task holds one stripe and one group. The tasks' best k are merged by a window.

Edge cases: vectors that are null, hold null or non-finite components, or differ in length from the query take no part; a null
id takes no part; rows with equal ids are candidates of their own, but never of a query with that id; fewer than k candidates
are returned whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table


def quantised(vectors: DataFrame, *, id_col: str = "vec_id", col: str = "embedding", scale: int = 256) -> DataFrame:
    """id and v (array<long>, floor(scale * x) of the components as doubles) of the usable vectors."""
    x = F.col(col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.filter(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def alike(rows: np.ndarray, block: int) -> np.ndarray:
    """An order of the rows in which blocks of neighbours are alike: halves at the median of the widest component, again and again."""
    done: list[np.ndarray] = []
    todo = [np.arange(len(rows))]
    while todo:
        own = todo.pop()
        if len(own) <= block:
            done.append(own)
            continue
        values = rows[own]
        widest = int((values.max(0) - values.min(0)).argmax())
        half = max(block, (len(own) // 2 + block - 1) // block * block)
        order = own[np.argsort(values[:, widest], kind="stable")]
        todo += [order[half:], order[:half]]
    return np.concatenate(done)


def search(documents: pd.DataFrame, queries: pd.DataFrame, k: int, block: int, scored: list[tuple[int, int]] | None = None) -> pd.DataFrame:
    """The best k documents of each query among these documents, by score and then smaller id; (query_id, vec_id, score).

    scored, if given, gets (blocks scored, blocks) of each query.
    """
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for size, own in documents.groupby(documents["v"].map(len)):
        asked = queries[queries["v"].map(len) == size]
        if not len(asked):
            continue
        own = own.sort_values("id")
        ids, rows = own["id"].to_numpy(np.int64), np.array(own["v"].tolist(), np.int64)
        order = alike(rows, block)
        ids, rows = ids[order], rows[order]
        q, q_ids = np.array(asked["v"].tolist(), np.int64), asked["id"].to_numpy(np.int64)
        exact = np.float64 if float(np.abs(rows).max()) * np.abs(q).sum(1).max() < 2**53 else object if _wide(rows, q) else np.int64
        starts = np.arange(0, len(ids), block)
        most, least = np.maximum.reduceat(rows, starts), np.minimum.reduceat(rows, starts)
        q, rows = q.astype(exact), rows.astype(exact)
        bounds = np.maximum(q, 0) @ most.astype(exact).T + np.minimum(q, 0) @ least.astype(exact).T
        falling = np.argsort(-bounds, axis=1, kind="stable") if exact is not object else np.array([sorted(range(len(starts)), key=lambda b, r=r: -r[b]) for r in bounds])
        for at, (query, own_id) in enumerate(zip(q, q_ids, strict=True)):
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, exact)
            visited, more = 0, 4
            while visited < len(starts):
                now = falling[at, visited : visited + more]
                if len(best) >= k:
                    now = now[bounds[at, now] >= best[k - 1]]
                if not len(now):
                    break
                part = (starts[now][:, None] + np.arange(block)).ravel()
                part = part[part < len(ids)]
                part = part[ids[part] != own_id]
                best_ids, best = np.concatenate([best_ids, ids[part]]), np.concatenate([best, rows[part] @ query])
                if len(best) > k and exact is not object:
                    reach = best >= np.partition(best, len(best) - k)[len(best) - k]
                    best_ids, best = best_ids[reach], best[reach]
                top = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[top], best[top]
                visited, more = visited + len(now), 2 * more
            if scored is not None:
                scored.append((visited, len(starts)))
            found.append((int(own_id), best_ids, best))
    if not found:
        return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0, np.int64)})
    return pd.DataFrame(
        {
            "query_id": np.concatenate([np.full(len(i), q, np.int64) for q, i, _ in found]),
            "vec_id": np.concatenate([i for _, i, _ in found]),
            "score": np.concatenate([s.astype(np.int64) for _, _, s in found]),
        }
    )


def _wide(rows: np.ndarray, q: np.ndarray) -> bool:
    """Whether a score may not fit into 64 bits."""
    return float(np.abs(rows).max()) * float(np.abs(q.astype(float)).sum(1).max()) >= 2**62


def top_k(documents: DataFrame, queries: DataFrame, *, k: int = 5, block: int = 64, rows: int = 16_384, group: int = 2_048) -> DataFrame:
    """query_id, rank, vec_id, score: the k best documents of every query. Both inputs have id and v.

    rows and group are the wanted sizes of a stripe and of a query group; their numbers follow from the counts.
    """
    counts = documents.agg(F.count("*")).first()[0], queries.agg(F.count("*")).first()[0]
    stripes, groups = (max(1, -(-n // size)) for n, size in zip(counts, (rows, group), strict=True))
    stripes = max(stripes, min(32, -(-counts[0] // 512)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = documents.withColumn("stripe", F.pmod(F.xxhash64("id"), F.lit(stripes)).cast("int")).withColumn("grp", every(groups))
    right = queries.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).withColumn("stripe", every(stripes))

    def pair(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return search(own, asked, k, block)

    best = left.groupBy("stripe", "grp").cogroup(right.groupBy("stripe", "grp")).applyInPandas(pair, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op9(spark, sf_dir: str) -> DataFrame:
    """The 5 best of all vectors for every vector whose id is divisible by 50."""
    rows = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter(F.col("id") % 50 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""
