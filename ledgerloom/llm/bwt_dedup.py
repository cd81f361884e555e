"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

Only fragments around anchors that occur in more than one document are compared (see `anchors`; every repeated string has such
an anchor). A batch is some whole groups of fragments with one anchor; its shards are the fragments that came from different
buckets of documents. Each shard is sorted by itself and gives its own transform, and the transforms are merged by refining an
interleave: the vector that says which shard each suffix of the merged order comes from. Reading the shards' transforms through
the interleave and dealing it by the symbols found sorts it by one more symbol; no suffix is compared again. A symbol is a run of
`STRIDE` bytes, so a few rounds sort by the wanted length. Block borders carried along the rounds are the places where the common
prefix ends, so the blocks after the last round are the repeated intervals, and the smallest document id of a block owns the
string. A merge over all suffixes of the corpus at once would shuffle every suffix once a round, ten times the input and more;
with the anchors only what may be repeated is merged.

Edge cases: null or empty texts have no byte and the hash of the empty string; a null doc_id sorts after all others; rows with
equal doc_id don't remove each other's bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import HOT, Stretch, keyed, repeated_spans
from .common import LAST_ID, mixed, table

STRIDE, SHARDS, MERGED = 5, 8, 60_000  # bytes a symbol, shards a merge, suffixes a merge (more only for one group of texts)


def byte_units(raw: np.ndarray, off: np.ndarray, hashed: bool, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes themselves, and the hash of the `seed` bytes (a multiple of 8) from each one on."""
    n = len(raw)
    seeds = np.zeros(0, np.uint64)
    if hashed:
        x = np.zeros(n + seed, np.uint64)
        x[:n] = raw
        for k in (1, 2, 4):
            x = x[:-k] | x[k:] << np.uint64(8 * k)
        seeds = x[:n]
        for k in range(8, seed, 8):
            seeds = mixed(seeds * np.uint64(0x9E3779B97F4A7C15)) ^ x[k : n + k]
        seeds = mixed(seeds * np.uint64(0x9E3779B97F4A7C15))
    return raw, np.arange(n + 1), off, seeds


def shard_order(symbols: np.ndarray, terminal: np.ndarray) -> np.ndarray:
    """Suffix order of one shard by prefix doubling; the empty suffixes come first, by position."""
    n, ends = len(symbols), int(terminal.sum())
    rank = symbols.astype(np.int64) + ends
    rank[terminal] = np.arange(ends)
    step = STRIDE
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:]
        values, rank = np.unique(rank * (int(rank.max()) + int(after.max()) + 2) + after, return_inverse=True)
        if len(values) == n:
            break
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def repeated_intervals(texts: list[bytes], length: int, senders: np.ndarray | None = None, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """(begins, block): where each text begins in the merged collection, and for every position of it the block of its suffix.

    Texts of one sender lie together and in one shard; without senders every text is one of its own. Two positions at least `length` bytes before their texts' ends are in one block exactly if these bytes are equal.
    """
    if length % STRIDE:
        raise ValueError(f"length must be a multiple of {STRIDE}")
    size = np.array([len(x) + STRIDE for x in texts])
    begins = np.cumsum(size) - size
    data = np.frombuffer(b"".join(x + b"\0" * STRIDE for x in texts), np.uint8)
    n = len(data)
    within = np.arange(n) - np.repeat(begins, size)
    terminal = within >= np.repeat(size - STRIDE, size)
    gram = np.zeros(n, np.int64)
    for k in range(STRIDE):
        gram[: n - k] |= data[k:].astype(np.int64) << (8 * (STRIDE - 1 - k))
    symbols = np.unique(gram, return_inverse=True)[1]
    narrow = np.uint16 if int(symbols.max()) < 1 << 16 else np.int64
    heads = np.arange(len(texts)) if senders is None else np.flatnonzero(np.r_[True, senders[1:] != senders[:-1]])
    cuts = np.unique(np.r_[0, begins[heads[np.linspace(0, len(heads), min(shards, len(heads)), endpoint=False).astype(int)]], n])
    order = np.concatenate([a + shard_order(symbols[a:b], terminal[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    has = within[order] >= STRIDE  # suffixes with a symbol before them; the transform of each shard, one after the other
    transform = symbols[np.maximum(order - STRIDE, 0)].astype(narrow)
    source = np.repeat(np.arange(len(cuts) - 1, dtype=np.uint8), np.diff(cuts))
    ends = source[terminal]
    interleave, block = source, np.zeros(n, np.int64)
    for _ in range(length // STRIDE):
        place = np.argsort(interleave, kind="stable")  # of the shards' suffixes, in their own order
        read, known = np.empty(n, narrow), np.empty(n, bool)
        read[place], known[place] = transform, has
        at = np.flatnonzero(known)
        at = at[np.argsort(read[at], kind="stable")]
        symbol, before = read[at], block[at]
        border = np.ones(n, bool)
        border[len(ends) + 1 :] = (symbol[1:] != symbol[:-1]) | (before[1:] != before[:-1])
        interleave, block = np.concatenate([ends, interleave[at]]), np.cumsum(border)
    found = np.empty(n, np.int64)
    found[order] = block[np.argsort(interleave, kind="stable")]
    return begins, found


def merged(texts: list[bytes], hashes: np.ndarray, windows: np.ndarray, least: np.ndarray, senders: np.ndarray, *, length: int) -> np.ndarray:
    """Smallest id of each window over all fragments of a slice; fragments of one anchor lie together."""
    out = np.repeat(least, windows)
    first = np.cumsum(windows) - windows
    begins = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    ends = np.r_[begins[1:], len(hashes)]
    several = ends - begins > 1
    batch: list[np.ndarray] = []
    total = 0
    for a, b in zip(begins[several].tolist(), ends[several].tolist(), strict=True):
        batch.append(np.arange(a, b))
        total += sum(len(x) + STRIDE for x in texts[a:b])
        if total >= MERGED:
            _settle(np.concatenate(batch), texts, windows, least, senders, first, out, length)
            batch, total = [], 0
    if batch:
        _settle(np.concatenate(batch), texts, windows, least, senders, first, out, length)
    return out


def _settle(own: np.ndarray, texts: list[bytes], windows: np.ndarray, least: np.ndarray, senders: np.ndarray, first: np.ndarray, out: np.ndarray, length: int) -> None:
    own = own[np.argsort(senders[own], kind="stable")]
    begins, block = repeated_intervals([texts[k] for k in own], length, senders[own])
    n = windows[own]
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    blocks = block[np.repeat(begins, n) + k]
    owner = np.full(int(block.max()) + 1, LAST_ID, np.int64)
    np.minimum.at(owner, blocks, np.repeat(least[own], n))
    out[np.repeat(first[own], n) + k] = owner[blocks]


def remove_repeats(docs: DataFrame, *, length: int = 50, seed: int = 24, with_text: bool = False, carry: tuple[str, ...] = (), hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, carried columns of docs and, if asked for, kept: what stays, as text.

    In kept, the parts of characters that a cut runs through are left out.
    """

    def compare(texts, hashes, at, windows, least, senders):
        return merged(texts, hashes, windows, least, senders, length=length)

    def finish(s: Stretch, gone: np.ndarray) -> pa.Table:
        rows, raw, off = s.table, s.raw, s.off
        begins = gone.copy()
        if len(gone):
            begins[1:] &= ~gone[:-1]
            heads = off[1:-1][off[1:-1] < len(gone)]
            begins[heads] = gone[heads]
        kept_bytes = raw[~gone].tobytes()
        cuts = np.r_[0, np.cumsum(~gone)][off]
        removed, runs = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
        kept = [kept_bytes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = {
            "doc_id": pa.array([None if i == LAST_ID else i for i in rows.column("id").to_pylist()], pa.int64()),
            "n_bytes": pa.array(np.diff(off)),
            "n_removed": pa.array(removed[off[1:]] - removed[off[:-1]]),
            "n_spans": pa.array(runs[off[1:]] - runs[off[:-1]]),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        columns |= {c: rows.column(c) for c in carry}
        return pa.table(columns | ({"kept": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())} if with_text else {}))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry) + ", kept string" * with_text
    rows, size = keyed(docs, carry)
    return repeated_spans(rows, size, lambda raw, off, hashed: byte_units(raw, off, hashed, seed), compare, finish, schema, length=length, seed=seed, hot=hot)


def op4(spark, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings that start in a document with a smaller id."""
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = """
WITH w AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), win AS (
  SELECT doc_id, k, md5(substr(h, 2 * k + 1, 100)) AS g FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS k FROM w WHERE n >= 50)
), owner AS (
  SELECT g, min(doc_id) AS first_doc FROM win GROUP BY g
), starts AS (
  SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM win JOIN owner USING (g) WHERE first_doc < doc_id
), runs AS (
  SELECT doc_id, k, sum(CASE WHEN before IS NULL OR k > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM starts
), spans AS (
  SELECT doc_id, run, min(k) AS a, max(k) + 50 AS b FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM spans
), cut AS (
  SELECT w.doc_id, any_value(n) AS n, any_value(h) AS h, count(a) AS n_spans, coalesce(sum(b - a), 0) AS n_removed,
    string_agg(substr(h, CAST(2 * prev + 1 AS BIGINT), CAST(2 * (a - prev) AS BIGINT)), '' ORDER BY a) AS front, coalesce(max(b), 0) AS last
  FROM w LEFT JOIN gaps ON gaps.doc_id = w.doc_id GROUP BY w.doc_id
)
SELECT doc_id, n AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans,
  sha256(unhex(coalesce(front, '') || substr(h, CAST(2 * last + 1 AS BIGINT)))) AS kept_sha256 FROM cut
"""
