"""Shared helpers: table loading, checkpointing in the cluster's shared folder, UTF-8 batches and word scanning."""

from __future__ import annotations

import contextlib
import ctypes
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"  # a word: a run without the six ASCII white-space characters
LAST_ID = (1 << 63) - 1  # stands for a null id: it sorts after every real one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fitted(sample: DataFrame, train: Callable[[pa.Table], object]) -> object:
    """train(table) of a sample of bounded size, run in one task, so that the driver gets the model only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = train(pa.Table.from_batches(list(batches), schema))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        give_back()

    schema = to_arrow_schema(sample.schema)
    rows = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else train(schema.empty_table())


def give_back() -> None:
    """Return freed memory to the system: Python workers live on for the next operator, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; operators that bucket by themselves use as many buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: str = "text"):
    """Number of words of a text column; a null text has none. Runs in the JVM."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls count as empty. offsets has one entry more than the column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    off = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(off) == 0:
        return raw[:0], np.zeros(1, np.int64)
    return raw[off[0] : off[-1]], off - off[0]


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of all words, and for each document the index of its first word (one entry more)."""
    space = _SPACE[raw]
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1]
    stops = inside.copy()
    stops[:-1] &= space[1:]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begins[cuts] |= inside[cuts]
    stops[cuts - 1] |= inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, off)


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Prefixes:
    """Hashes of any byte ranges of one buffer, from prefix sums of position-weighted random byte values (modulo 2**64)."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[raw] * _powers(0, n), out=self.sums[1:])
        self.inverse = _powers(1, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(h + (ends - starts).astype(np.uint64) * _ODD)


def _powers(which: int, n: int) -> np.ndarray:
    """Powers of the base (0) or of its inverse (1); kept for the next buffer, up to 8 million."""
    kept = _POWERS[which]
    if len(kept) < n:
        kept = np.full(max(n, 1 << 16), (_ODD, _INVERSE)[which], np.uint64)
        kept[0] = 1
        np.multiply.accumulate(kept, out=kept)
        if len(kept) <= 8 << 20:
            _POWERS[which] = kept
    return kept[:n]


_POWERS = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]
_BYTES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _ODD)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def segments(raw: np.ndarray, off: np.ndarray, size: int = 4 << 20):
    """Cut a batch into ranges [lo, hi) of about `size` bytes that end with a document or, in very long ones, with a word."""
    lo = 0
    while lo < len(raw):
        hi = min(lo + size, len(raw))
        if hi < len(raw):
            k = int(np.searchsorted(off, hi, "right")) - 1
            if off[k] > lo:
                hi = int(off[k])
            else:
                stop = int(off[k + 1])
                gap = np.flatnonzero(_SPACE[raw[hi:stop]])
                hi = hi + int(gap[0]) + 1 if len(gap) else stop
        yield lo, hi
        lo = hi


def lowered(column: pa.Array) -> pa.Array:
    """The column in lower case, nulls as empty."""
    import pyarrow.compute as pc

    return pc.utf8_lower(column.fill_null("") if column.null_count else column)


def whole_documents(off: np.ndarray, size: int = 1 << 20):
    """Cut a batch into ranges [i, j) of whole documents of about `size` bytes; a longer document is a range of its own."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j
        i = j
