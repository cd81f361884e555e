"""Pack tokenised documents into fixed-capacity sequences by patterns fitted to the length histogram.

1. Tokenise (Arrow batches); documents longer than the capacity are cut, the first piece takes the remainder.
2. The histogram of piece lengths has at most `capacity` rows, so it alone goes to the driver.
3. There, enumerate patterns of one to three lengths that fill a sequence exactly, fit repeat counts to the histogram by
   non-negative least squares (accelerated projected gradient), round down, and pack what is left by best fit on counts.
4. The layout says which ranks of a length go where; its size depends on the capacity only. Ranks are dealt in two levels
   (length and salt), so a length that a third of all pieces share does not meet in one task.

Edge cases: null or empty text is the end token alone; a null doc_id is kept; repeated rows are packed once each; an empty
table gives no rows; other columns are ignored. Texts that hold a special token's string are encoded as `tokenizers` does.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, give_back, table

VOCABULARY = "byte_bpe_50k.json"
CAPACITY, END = 1024, 2


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


_UNCUT = re.compile(r" (?=\s|$)")  # spaces that don't begin a pre-token with a word


class Encoder:
    """Ids of a byte-level BPE vocabulary file, as little-endian uint32 bytes, with a bounded cache of words.

    A space before a character that is no white space always begins a new pre-token, so a text can be cut there and the
    parts be encoded and cached one by one; the result equals encoding the whole text.
    """

    def __init__(self, path: str, entries: int = 200_000):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE writes as themselves
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.full = path, None
        self.cache = _Parts(self.plain, entries)

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            if self.full is None:  # few texts need it
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.path)
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *parts = text.split(" ")
        if _UNCUT.search(text):
            joined, whole = [], [first]
            for p in parts:
                if p == "" or p[0].isspace():
                    whole.append(p)
                else:
                    joined.append(" ".join(whole))
                    whole = [p]
            joined.append(" ".join(whole))
            first, *parts = joined
        head = array("I", self.plain.encode_ordinary(first)).tobytes()
        return head + b"".join(map(self.cache.__getitem__, parts))


class _Parts(dict):
    """Ids of a word after a space. Two generations of at most `entries` words each: the older one goes when the newer is full."""

    def __init__(self, plain, entries: int):
        super().__init__()
        self.plain, self.entries, self.old = plain, entries, {}
        self.marks = {m: array("I", plain.encode_ordinary(m)).tobytes() for m in ".,!?;:"}

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            if part[-1] in self.marks and part[:-1].isalpha():  # letters and one mark are two pre-tokens
                return self[part[:-1]] + self.marks[part[-1]]
            ids = array("I", self.plain.encode_ordinary(" " + part)).tobytes()
        if len(part) <= 48:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids


def pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end: int = END, with_ids: bool = False, key: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (array<int>) and key: documents as pieces of at most capacity tokens."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, *[key] * bool(key)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, close = Encoder(path), np.array([end], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64()]
        wanted = [True] * 5 + [with_ids, bool(key)]
        flush = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t, w in zip(rows, kinds, wanted, strict=True) if w], names)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], [], []]
            held = 0
            for doc, text, own_key in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                ids = encode(text.as_py() or "") + close
                n = len(ids) // 4
                stop = n % capacity or capacity
                begin = k = 0
                while begin < n:
                    own = ids[4 * begin : 4 * stop]
                    for to, v in zip(rows, (doc, k, begin, stop - begin, zlib.crc32(own), np.frombuffer(own, "<i4") if with_ids else None, own_key), strict=True):
                        to.append(v)
                    begin, stop, k = stop, stop + capacity, k + 1
                held += len(ids)
                if held > 4 << 20:  # some MB of ids at a time
                    yield flush(rows)
                    rows, held = [[], [], [], [], [], [], []], 0
            yield flush(rows)
        del encode
        give_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + (f", {key} long" if key else "")
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (F.col(key) if key else F.lit(0)).cast("long").alias("key"))
    return own.mapInArrow(run, schema)


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All ways to fill the capacity exactly with one, two or three of the given lengths, longest first, padded with 0."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    found = [(capacity, 0, 0)] if have[capacity] else []
    for a in sorted((int(x) for x in lengths if x < capacity), reverse=True):
        rest = capacity - a
        if rest <= a and have[rest]:
            found.append((a, rest, 0))
        b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
        b = b[have[b] & have[rest - b]]
        found += [(a, int(x), rest - int(x)) for x in b]
    return np.array(found, np.int64).reshape(-1, 3)


def fit(found: np.ndarray, counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 of the patterns with |A x - counts| least; A is kept as its few entries a column."""
    if not len(found):
        return np.zeros(0)
    flat, size = found.ravel(), len(counts)

    def used(x: np.ndarray) -> np.ndarray:
        y = np.bincount(flat, np.repeat(x, 3), size)
        y[0] = 0
        return y

    v = np.ones(len(found))
    for _ in range(30):  # the largest eigenvalue of A'A bounds the step
        v = used(v)[found].sum(1)
        norm = np.linalg.norm(v)
        v /= norm
    x = z = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        residual = used(z) - counts
        residual[0] = 0
        new = np.maximum(0, z - residual[found].sum(1) / (1.02 * norm))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def layout(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Groups (lengths of one sequence, number of such sequences) that use up counts[length] exactly."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    found = patterns(np.flatnonzero(left), capacity)
    x = fit(found, left.astype(float))
    groups: list[tuple[tuple[int, ...], int]] = []
    chosen: dict[int, int] = {}
    order = np.argsort(-x, kind="stable")
    for most in (np.floor(x), np.full(len(x), np.inf)):  # the rounded fit, then what the patterns still can take
        for k in order:
            p = [int(v) for v in found[k] if v]
            n = int(min(most[k], *(left[v] // p.count(v) for v in p)))
            if n > 0:
                chosen[int(k)] = chosen.get(int(k), 0) + n
                for v in p:
                    left[v] -= n
    groups += [(tuple(int(v) for v in found[k] if v), n) for k, n in chosen.items()]
    return groups + best_fit(left, capacity)


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing, on counts: equal sequences stay together as one group."""
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in range(capacity, 0, -1):
        todo = int(counts[length])
        while todo:
            gap = min((g for g in room if g >= length), default=None)
            if gap is None:
                each = capacity // length
                n, each = (todo // each, each) if todo >= each else (1, todo)
                room.setdefault(capacity - each * length, []).append(((length,) * each, n))
                todo -= n * each
                continue
            inside, n = room[gap].pop()
            if not room[gap]:
                del room[gap]
            put = min(n, todo)
            room.setdefault(gap - length, []).append(((*inside, length), put))
            if n > put:
                room.setdefault(gap, []).append((inside, n - put))
            todo -= put
    return [g for of in room.values() for g in of]


def places(groups: list[tuple[tuple[int, ...], int]], capacity: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its ranges, the sequence of each range's first rank, and the offset there."""
    ranges: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    taken, base = [0] * (capacity + 1), 0
    for inside, n in groups:
        offset = 0
        for length in inside:
            ranges[length].append((taken[length], base, offset))
            taken[length] += n
            offset += length
        base += n
    return [tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) if r else (np.zeros(0, np.int64),) * 3 for r in ranges]


def pack(docs: DataFrame, *, path: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False, key: str | None = None, salt: int = 512) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids,] [key,] sequence_id, offset; key is a long column of docs to carry."""
    cutup = pieces(docs, path or vocabulary_path(), capacity=capacity, end=end, with_ids=with_ids, key=key)
    cutup = cut(cutup.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salt))))
    groups = cutup.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in groups.groupBy("length").agg(F.sum("n")).collect():  # at most one row per length
        counts[length] = n
    table_of = docs.sparkSession.sparkContext.broadcast(places(layout(counts, capacity), capacity))
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cutup.withColumn("rank", F.row_number().over(inside) - 1).join(groups, ["length", "salt"])
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, *[key] * bool(key)]
    ranked = ranked.select(*names, (F.col("rank") + F.col("ahead")).alias("rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at, length, rank = table_of.value, length.to_numpy(), rank.to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
            first, base, off = at[length[own[0]]]
            k = np.searchsorted(first, rank[own], "right") - 1
            sequence[own], offset[own] = base[k] + rank[own] - first[k], off[k]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("place", placed("length", "rank")).select(*names, "place.sequence_id", "place.offset")


def op8(spark, sf_dir: str) -> DataFrame:
    """Every document of the corpus packed into sequences of 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))
