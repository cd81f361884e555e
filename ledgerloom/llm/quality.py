"""Quality classifier: ordinal cumulative-link regression over hashed text with ordered thresholds.

Grades count what is right with a text: one for good quality, one for not being toxic, so 0, 1 or 2. P(grade <= k) = sigmoid(threshold_k - s), where s is the sum of one shared weight per
distinct feature of the text: runs of letters (lower case), their first four and five bytes, and runs of marks. The thresholds
are kept in order by learning the lowest one and the logarithm of the step to the next. Weights are held at or below zero: a
feature can only speak against a text, so a long good text does not outweigh what is wrong with it. The weights give the expected grade and the tail
probability P(grade = 2), by which documents are selected.

Fitted on a bounded sample of labelled rows, `sample` of them in expectation, picked by a hash of doc_id.

Edge cases: null and empty texts have no feature and get the scores of s = 0; null labels and labels of unknown documents are
not used; a document labelled twice takes its lowest grade; without labels nothing is rejected; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Prefixes, fitted, give_back, lowered, mixed, segments, table, utf8, whole_documents

BITS = 18
HEADS = (4, 5)  # bytes of a word that are features besides the whole word
_CLASS = np.zeros(256, np.uint8)  # 0 white space, 1 letters (and bytes of longer characters), 2 marks and digits
_CLASS[33:] = 2
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(documents, buckets): the distinct hashed features of each text, by document.

    Two more features say how repetitive it is: the share of distinct runs and that of the most frequent one, in eighths.
    """
    raw, off = utf8(lowered(texts))
    kept, runs, times = [], [], []
    for lo, hi in segments(raw, off, 1 << 20):
        a, kinds = raw[lo:hi], _CLASS[raw[lo:hi]]
        edges = np.r_[True, kinds[1:] != kinds[:-1]]
        inner = off[(off > lo) & (off < hi)] - lo
        edges[inner] = True
        starts = np.flatnonzero(edges)
        ends = np.r_[starts[1:], len(a)]
        own = kinds[starts] > 0
        starts, ends = starts[own], ends[own]
        doc = np.searchsorted(off, starts + lo, "right") - 1
        letters = kinds[starts] == 1
        hashed = Prefixes(a)
        key, n = np.unique(_key(doc, hashed(starts, ends)), return_counts=True)
        runs.append(key)
        times.append(n)
        doc, starts, ends = doc[letters], starts[letters], ends[letters]
        for n in HEADS:
            kept.append(np.unique(_key(doc, hashed(starts, np.minimum(ends, starts + n)) ^ np.uint64(0xA5A5A5A5A5A5A5A5 + n))))
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.concatenate(runs)
    order = np.argsort(key, kind="stable") if len(runs) > 1 else np.arange(len(key))
    key, n = key[order], np.concatenate(times)[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    if len(first):
        key, n = key[first], np.add.reduceat(n, first)
        doc = key >> BITS
        at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total, most, distinct = np.add.reduceat(n, at), np.maximum.reduceat(n, at), np.diff(np.r_[at, len(key)])
        size = np.minimum(np.log2(total).astype(np.int64), 9)
        for what, part in enumerate((distinct, most)):
            bins = (what * 10 + size) * 9 + 8 * part // total
            kept.append(_key(doc[at], mixed((bins + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))))
    keys = np.unique(np.concatenate([key, *kept]))
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _key(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return doc.astype(np.int64) << BITS | (hashes >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    cuts: np.ndarray  # ascending thresholds

    def tails(self, texts: pa.Array) -> np.ndarray:
        """P(grade > k) for each text (row) and threshold k (column)."""
        s = np.zeros(len(texts))
        for i, j in whole_documents(utf8(texts)[1], 2 << 20):
            doc, bucket = features(texts.slice(i, j - i))
            s[i:j] = np.bincount(doc, self.weights[bucket], j - i)
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - s[:, None], -50, 50)))


def train(bags: list[np.ndarray], grades: np.ndarray, *, epochs: int = 40, rate: float = 1.5, least: int = 5, shrink: float = 0.05, seed: int = 1) -> Model:
    """Minibatch gradient descent with per-weight step sizes on the negative log-likelihood of the grades.

    Features of fewer than `least` documents keep weight 0: they would take the blame that belongs to those that recur.
    `shrink` pulls every touched weight towards 0, so that weak evidence does not add up over a long text.
    """
    low, step = -4.0, np.log(2.0)
    if not len(bags):
        return Model(np.zeros(1 << BITS, np.float32), np.array([low, low + 2.0]))
    seen = np.bincount(np.concatenate(bags), minlength=1 << BITS)
    kept = np.flatnonzero(seen >= least)
    number = np.full(1 << BITS, -1, np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    bags = [x[x >= 0] for x in (number[bag] for bag in bags)]
    weights, squares = np.zeros(len(kept)), np.full(len(kept), 1e-2)
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        speed = rate * (1 - epoch / epochs)
        for batch in np.array_split(rng.permutation(len(bags)), len(bags) // 64 + 1):
            ids = np.concatenate([bags[k] for k in batch]) if len(batch) else np.zeros(0, np.int64)
            if not len(ids):
                continue
            rows = np.repeat(np.arange(len(batch)), [len(bags[k]) for k in batch])
            s = np.bincount(rows, weights[ids], len(batch))
            y = grades[batch]
            b = 1 / (1 + np.exp(np.clip(s - low, -50, 50)))
            a = 1 / (1 + np.exp(np.clip(s - low - np.exp(step), -50, 50)))
            width = np.maximum(a - b, 1e-9)
            ds = np.where(y == 0, 1 - b, np.where(y == 2, -a, 1 - a - b))
            da = np.where(y == 2, a, np.where(y == 1, -a * (1 - a) / width, 0.0))
            db = np.where(y == 0, b - 1, np.where(y == 1, b * (1 - b) / width, 0.0))
            g = np.bincount(ids, ds[rows], len(kept))
            touched = np.bincount(ids, minlength=len(kept)) > 0
            g -= shrink * touched
            squares += g * g
            weights = np.minimum(0, weights - speed * g / np.sqrt(squares) * touched)
            low -= 0.2 * speed * float(np.mean(np.clip(da + db, -5, 5)))
            step = min(3.0, step - 0.2 * speed * float(np.mean(np.clip(da, -5, 5))) * np.exp(step))
    every = np.zeros(1 << BITS, np.float32)
    every[kept] = weights
    return Model(every, np.array([low, low + np.exp(step)]))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = 12_000) -> Model:
    """A model from a hashed sample of the labelled documents; their features go to one task, and only the model to the driver."""
    quality, toxic = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    graded = labels.filter("doc_id is not null and quality is not null").select("doc_id", (F.when(quality > 0, 1).otherwise(0) + F.when(toxic > 0, 0).otherwise(1)).alias("grade"))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality sample")), F.lit(1 << 30))
    graded = graded.withColumnRenamed("doc_id", "of").groupBy("of").agg(F.min("grade").alias("grade")).withColumnRenamed("of", "doc_id")
    n = max(1, graded.count())
    few = graded.filter(part < int(min(1, sample / n) * (1 << 30))).limit(2 * sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(few), "doc_id").select("doc_id", "grade", "text")  # at most 2 * sample short rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, bucket = features(batch.column(2))
            first = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            bags = pa.ListArray.from_arrays(pa.array(first), pa.array(bucket.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bags], ["doc_id", "grade", "bag"])

    def learn(found: pa.Table) -> Model:
        found = found.sort_by([("doc_id", "ascending"), ("grade", "ascending")])
        grades, lists = found.column("grade").to_numpy(), pa.concat_arrays(found.column("bag").chunks) if found.num_rows else pa.array([], pa.list_(pa.int32()))
        flat, cuts = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
        return train([flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], grades)  # slices of one array, 4 bytes a feature

    return fitted(joined.mapInArrow(run, "doc_id long, grade int, bag array<int>"), learn)


def score(docs: DataFrame, model: Model, *, accept: float = 0.5) -> DataFrame:
    """All columns of docs, then expected_grade, p_good and accepted; one narrow Arrow pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = docs.columns.index("text")
    numbered = docs.toDF(*names).withColumn(names[at], F.col(names[at]).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = shared.value.tails(batch.column(at))
            extra = [pa.array(tails.sum(1)), pa.array(tails[:, -1].copy()), pa.array(tails[:, -1] >= accept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*names, "expected_grade", "p_good", "accepted"])
        give_back()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema)
    out = numbered.mapInArrow(run, f"{schema}, expected_grade double, p_good double, accepted boolean")
    return out.toDF(*docs.columns, "expected_grade", "p_good", "accepted")


def op3(spark, sf_dir: str) -> DataFrame:
    """doc_id, expected_grade, p_good, accepted of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select("doc_id", "expected_grade", "p_good", "accepted")
