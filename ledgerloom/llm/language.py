"""Language identification: averaged hashed subword embeddings under a linear softmax, trained by SGD in numpy.

Features are all 3- and 4-byte runs of the lower-cased text (digits, marks and line ends read as spaces), each hashed to a row
of an embedding table. A text's vector is the mean of its rows; a linear softmax gives the languages. As both maps are linear,
the table is folded into one score per (row, language) for prediction, and texts of any length are summed block by block.

The model is fitted on a bounded sample of labelled rows of every value of lang, picked by a hash of doc_id: about `per_language`
documents of each, fewer where there are more than `languages` of them, so that the sample stays the same, but not below
`least`. Documents of at most `max_chars` are taken whole, of longer ones the first `stretch` characters. With more than DIM
languages the table is not folded, so the model does not grow with them. Every fifth document is set aside to calibrate
the softmax temperature and the rejection threshold, the lowest score at which the accepted are right to `precision`.

Edge cases: null text and text without a letter give `und` with score 0 and are never accepted; a null doc_id is not held out
and not used for fitting; without a labelled row every prediction is `und`; repeated rows are predicted alike; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fitted, lowered, segments, table, utf8

BITS, DIM = 16, 16
UNKNOWN = "und"
_KEEP = np.full(256, 32, np.uint8)
_KEEP[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]


def subwords(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of the table, documents) of all 3- and 4-byte runs, a bounded block at a time; runs don't cross documents."""
    for lo, hi in segments(raw, off, 1 << 20):
        a = _KEEP[raw[lo:hi]].astype(np.uint32)
        first = int(np.searchsorted(off, lo, "right")) - 1
        last = int(np.searchsorted(off, hi, "left"))
        bounds = np.clip(off[first : last + 1] - lo, 0, hi - lo)
        doc = np.repeat(np.arange(first, last), np.diff(bounds))
        if len(a) < 4:
            a = np.concatenate([a, np.full(4 - len(a), 32, np.uint32)])
            doc = np.concatenate([doc, np.full(4 - len(doc), -1)])
        three = a[:-2] | a[1:-1] << np.uint32(8) | a[2:] << np.uint32(16)
        four = three[:-1] | a[3:] << np.uint32(24)
        for grams, n in ((three, 3), (four, 4)):
            ids = (grams * np.uint32(2654435761) >> np.uint32(32 - BITS)) + np.uint32((n - 3) << BITS)
            same = doc[: len(ids)] == doc[n - 1 :]
            same &= doc[: len(ids)] >= 0
            yield (ids, doc[: len(ids)]) if same.all() else (ids[same], doc[: len(ids)][same])


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # folded table: row -> language; with more than DIM languages the table itself: row -> embedding
    bias: np.ndarray
    temperature: float
    threshold: float
    out: np.ndarray | None = None  # embedding -> language, where the table is not folded

    def logits(self, texts: pa.Array) -> np.ndarray:
        raw, off = utf8(lowered(texts))
        total, n = np.zeros((len(texts), self.scores.shape[1])), np.zeros(len(texts))
        for ids, doc in subwords(raw, off):
            if len(ids):
                starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                total[doc[starts]] += np.add.reduceat(self.scores[ids], starts, axis=0)
                n[doc[starts]] += np.diff(np.r_[starts, len(doc)])
        mean = total / np.maximum(n, 1)[:, None]
        return (mean if self.out is None else mean @ self.out) + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, calibrated probability) of each text."""
        if not self.languages or not len(texts):
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        p = softmax(self.logits(texts) / self.temperature)
        best = p.argmax(1)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)], np.where(letters, p[np.arange(len(best)), best], 0.0)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(texts: list[str], langs: list[str], *, epochs: int = 12, rate: float = 1.0, seed: int = 1, precision: float = 0.99) -> Model:
    """Fit on whole documents; each step sees a random stretch of the document's subwords, so short texts are learned too."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((2 << BITS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    number = {x: k for k, x in enumerate(languages)}
    y = np.array([number[x] for x in langs])
    raw, off = utf8(lowered(pa.array(texts, pa.string())))
    found = list(subwords(raw, off))
    ids, doc = np.concatenate([i for i, _ in found]), np.concatenate([d for _, d in found])
    order = np.argsort(doc, kind="stable")
    ids, first = ids[order], np.searchsorted(doc[order], np.arange(len(texts) + 1))
    held = np.arange(len(texts)) % 5 == 4
    held &= np.bincount(y[~held & (np.diff(first) > 0)], minlength=len(languages))[y] > 0  # a language is not set aside as a whole
    table_, out, bias = rng.normal(0, 0.1, (2 << BITS, DIM)), rng.normal(0, 0.1, (DIM, len(languages))), np.zeros(len(languages))
    use = np.flatnonzero(~held & (np.diff(first) > 0))
    steps, step = epochs * (len(use) // 32 + 1), 0
    for _ in range(epochs):
        rng.shuffle(use)
        for batch in np.array_split(use, len(use) // 32 + 1):
            if not len(batch):
                continue
            lr = rate * (1 - step / steps)
            step += 1
            size = np.minimum(np.diff(first)[batch], rng.integers(10, 400, len(batch)))
            begin = first[batch] + (rng.random(len(batch)) * (np.diff(first)[batch] - size + 1)).astype(int)
            own = np.concatenate([ids[b : b + s] for b, s in zip(begin, size, strict=True)])
            at = np.r_[0, np.cumsum(size)[:-1]]
            mean = np.add.reduceat(table_[own], at, axis=0) / size[:, None]
            g = softmax(mean @ out + bias)
            g[np.arange(len(batch)), y[batch]] -= 1
            back = g @ out.T
            out -= lr * mean.T @ g / len(batch) * 4
            bias -= lr * g.mean(0)
            np.add.at(table_, own, np.repeat(-lr * back / size[:, None] * 8, size, axis=0))
    if len(languages) <= DIM:
        model = Model(languages, (table_ @ out).astype(np.float32), bias, 1.0, 0.0)
    else:
        model = Model(languages, table_.astype(np.float32), bias, 1.0, 0.0, out)
    rest = np.flatnonzero(held)
    if len(rest):
        logits = model.logits(pa.array([texts[k] for k in rest], pa.string()))
        loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(rest)), y[rest]], 1e-12)).mean()
        model.temperature = float(min(np.geomspace(0.05, 10, 60), key=loss))
        p = softmax(logits / model.temperature)
        top, right = p.max(1), p.argmax(1) == y[rest]
        order = np.argsort(-top)
        fine = np.flatnonzero(np.cumsum(right[order]) / np.arange(1, len(rest) + 1) >= precision)
        model.threshold = float(top[order[fine[-1]]]) if len(fine) else 1.0
    return model


def fit(docs: DataFrame, known, *, per_language: int = 600, languages: int = 200, max_chars: int = 20_000, stretch: int = 2_000, least: int = 30) -> Model:
    """A model from the rows of docs where the condition `known` holds and lang is not null; it is fitted in one task."""
    known = docs.filter(known & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return train([], [])
    each = min(per_language, max(least, per_language * languages // len(counts)))
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language sample")), F.lit(1 << 30))
    limits = docs.sparkSession.createDataFrame([(r["lang"], min(1 << 30, int((1 << 30) * each / r["count"]))) for r in counts], "of string, upto long")
    text = F.when(F.length("text") <= max_chars, F.col("text")).otherwise(F.substring("text", 1, stretch)).alias("text")
    rows = known.join(F.broadcast(limits), F.col("lang") == F.col("of")).filter(part < F.col("upto")).select("doc_id", "lang", text).limit(4 * each * len(counts))

    def learn(found: pa.Table) -> Model:
        found = found.sort_by([(c, "ascending") for c in ("doc_id", "lang", "text")])
        return train(found.column("text").to_pylist(), found.column("lang").to_pylist())

    return fitted(rows, learn)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted of every document; reads doc_id and text only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the table's bits and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            names, score = model.predict(batch.column(2))
            accepted = [n != UNKNOWN and s >= model.threshold for n, s in zip(names, score, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    own = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op2(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs, ~held_out() & F.col("doc_id").isNotNull()))
