"""Removal of passages that repeat across documents, by seed and extend over words.

Documents are joined on winnowed anchors of `seed` words (see `anchors`). In each group of fragments with one anchor, the words
of the anchor are compared first, and the match is then extended to the right and to the left a word at a time: fragments that
agree so far stay in one class. A window with l words left and r words right of the anchor is a repeat of exactly those that share
its left class l and its right class r, so every maximal repeat over the threshold is found without comparing pairs. The smallest
document id of the class owns the passage. Within a slice of a MB a word is named by a 64-bit hash.

Edge cases: null or empty texts have no word and the hash of the empty string; a null doc_id sorts after all others; rows with
equal doc_id don't remove each other's words; white space between words doesn't matter; words may be of any length; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import HOT, Stretch, keyed, repeated_spans
from .common import LAST_ID, Prefixes, mixed, table, words


def word_units(raw: np.ndarray, off: np.ndarray, hashed: bool, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words one after the other, each with one space behind it, and the hash of the `seed` words from each word on."""
    starts, ends, first = words(raw, off)
    size = ends - starts
    begin = np.r_[0, np.cumsum(size + 1)]
    buffer = np.full(int(begin[-1]), 32, np.uint8)
    if len(size):
        inside = np.repeat(begin[:-1] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        buffer[inside] = raw[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    if not hashed:
        return buffer, begin, first, np.zeros(0, np.uint64)
    h = Prefixes(raw)(starts, ends)
    seeds = np.zeros(len(h), np.uint64)
    for k in range(seed):
        n = max(0, len(h) - k)
        seeds[:n] = seeds[:n] * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return buffer, begin, first, mixed(seeds)


def extended(texts: list[bytes], hashes: np.ndarray, at: np.ndarray, windows: np.ndarray, least: np.ndarray, *, length: int, seed: int) -> np.ndarray:
    """Smallest id of each window, by extending the fragments of each anchor both ways."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    off = np.r_[0, np.cumsum([len(x) for x in texts])]
    starts, ends, first = words(raw, off)
    _, word = np.unique(Prefixes(raw)(starts, ends), return_inverse=True)
    word = word.astype(np.int64) + 1
    n, reach = np.diff(first), length - seed
    _, group = np.unique(hashes, return_inverse=True)
    wide = int(word.max()) + 2

    def step(classes: np.ndarray, place: np.ndarray) -> np.ndarray:
        inside = (place >= 0) & (place < n)
        next_word = np.where(inside, word[np.minimum(np.maximum(first[:-1] + place, 0), len(word) - 1)], 0)
        return np.unique(classes.astype(np.int64) * wide + next_word, return_inverse=True)[1]

    for k in range(seed):
        group = step(group, at + k)
    right, left = [group], [group]
    for k in range(reach):
        right.append(step(right[-1], at + seed + k))
        left.append(step(left[-1], at - 1 - k))
    out = np.full(int(windows.sum()), LAST_ID, np.int64)
    begin = np.cumsum(windows) - windows
    for ahead in range(reach + 1):  # words of the window left of the anchor
        which = np.flatnonzero((at - ahead >= 0) & (at - ahead < windows))
        if len(which):
            _, same = np.unique(left[ahead][which].astype(np.int64) * (len(texts) + 1) + right[reach - ahead][which], return_inverse=True)
            owner = np.full(int(same.max()) + 1, LAST_ID, np.int64)
            np.minimum.at(owner, same, least[which])
            out[begin[which] + at[which] - ahead] = owner[same]
    return out


def remove_repeats(docs: DataFrame, *, length: int = 13, seed: int = 6, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the words that stay, joined by one space)."""

    def compare(texts, hashes, at, windows, least, senders):
        return extended(texts, hashes, at, windows, least, length=length, seed=seed)

    def finish(s: Stretch, gone: np.ndarray) -> pa.Table:
        buffer, begin, first = s.buffer, s.starts, s.unit_off
        keep = np.repeat(~gone, np.diff(begin))
        removed = np.r_[0, np.cumsum(gone)]
        kept_bytes = buffer[keep].tobytes()
        cuts = np.r_[0, np.cumsum(keep)][begin[first]]
        kept = [kept_bytes[a : max(a, b - 1)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        ids = s.ids.tolist()
        columns = {
            "doc_id": pa.array([None if i == LAST_ID else i for i in ids], pa.int64()),
            "n_words": pa.array(np.diff(first)),
            "n_removed": pa.array(removed[first[1:]] - removed[first[:-1]]),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
        }
        return pa.table(columns | ({"kept": pa.array([x.decode() for x in kept], pa.string())} if with_text else {}))

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    rows, size = keyed(docs)
    return repeated_spans(rows, size, lambda raw, off, hashed: word_units(raw, off, hashed, seed), compare, finish, schema, length=length, seed=seed, hot=hot)


def op10(spark, sf_dir: str) -> DataFrame:
    """Every document without the passages of 13 words or more that a document with a smaller id has."""
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents
), win AS (
  SELECT doc_id, k, md5(array_to_string(list_slice(ws, k, k + 12), ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w WHERE len(ws) >= 13)
), owner AS (
  SELECT g, min(doc_id) AS first_doc FROM win GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(k, k + 13)) AS pos FROM win JOIN owner USING (g) WHERE first_doc < doc_id)
), word AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w
), kept AS (
  SELECT word.doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY word.pos) FILTER (gone.pos IS NULL) AS text
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.pos = word.pos GROUP BY word.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""
