"""Exchange of text fragments around winnowed anchors, shared by the two removal operators of repeated passages.

Units are bytes or words; a window is `length` consecutive units of one document. Of the seeds (`seed` units) in a window the
one with the smallest hash is its anchor, so equal windows have equal anchors, wherever they stand. A fragment is the run of
windows that share one anchor. Documents are dealt to buckets of about `BUCKET` bytes, and all traffic is in rows (bucket,
sender, block of entries), one Python call for each bucket:

1. anchors      each bucket of documents names its distinct anchors -> buckets of anchors: which occur in several documents?
2. fragments    the answers go back, and each bucket of documents sends the distinct fragments of those anchors, each with the
                smallest id that it has there
3. comparison   each bucket of anchors compares its distinct fragments (the operator's own method, see `Compare`), group by
                group, and finds for each window the smallest document id that it occurs in
4. removal      runs of windows that a smaller id has go back to the buckets that sent the fragment, and there to its places

A passage that a third of all documents hold is one entry for each bucket of documents, not one for each document. An anchor of
more than `HOT` documents may have as many different fragments around it (at the ends of such a passage); its windows travel one
by one, each under its own hash, so no group holds them all. The number of buckets follows from the bytes of the input, a bucket
is read in stretches of a few MB, and nothing but the exchanges is kept, so a lost executor costs a recomputation of its part.

Anchors are named by 56 bits, which can only send a fragment in vain; inside a bucket of documents a 64-bit hash stands for the
text of a fragment. Between buckets texts are compared by their bytes or words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST_ID, cut, give_back, mixed, partitions, utf8, whole_documents

#: (fragments, their anchors' hashes in order, anchor offsets, windows, smallest ids, senders) -> smallest id of each window, concatenated
Compare = Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: (bytes, document offsets, hashes wanted) -> (unit buffer, starts of the units in it, document offsets in units, seed hashes of each unit)
Units = Callable[[np.ndarray, np.ndarray, bool], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

BUCKET, STRETCH, SLICE, HOT = 12 << 20, 1 << 20, 1 << 20, 1 << 12

NAME = np.dtype([("name", "<u8")])  # hash << 8 | logarithm of the documents (1), or whether the anchor is hot (2)
TEXT = np.dtype([("hash", "<u8"), ("anchor", "<u8"), ("text", "<u8"), ("least", "<i8"), ("size", "<u4"), ("windows", "u1"), ("at", "u1"), ("kind", "u1")])
RUN = np.dtype([("anchor", "<u8"), ("text", "<u8"), ("owner", "<i8"), ("start", "u1"), ("size", "u1")])
SINGLE, SEVERAL = 1, 2  # kinds of a text: one window of a hot anchor, in several documents of its bucket
KIND = "bucket int, sender int, block binary"


def keyed(docs: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(rows, bytes of text). rows: key (one per row), id, text (never null), carried columns.

    The key is doc_id where that is unique and never null, else a row number.
    """
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *carry)
    per = own.groupBy("id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    most, last, size = per.agg(F.max("n"), F.max("id"), F.sum("bytes")).first()
    if (most or 0) > 1 or last == LAST_ID:
        return cut(own).withColumn("key", F.monotonically_increasing_id()).select("key", "id", "text", *carry), size or 0
    return own.select(F.col("id").alias("key"), "id", "text", *carry), size or 0


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values the place of its leftmost minimum."""
    v, at = (h >> np.uint64(32)).astype(np.uint32), np.arange(len(h), dtype=np.uint32)
    step = 1
    while step < width:
        move = min(step, width - step)
        right = v[move:] < v[:-move]
        at = np.where(right, at[move:], at[:-move])
        v = np.minimum(v[move:], v[:-move])
        step += move
    return at


def fragments(seeds: np.ndarray, off: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, windows, at, hash) of all fragments; start counts in the buffer's units, at from the start to the anchor."""
    none = np.zeros(0, np.int64)
    if len(seeds) < length:
        return none, none, none, none, none.astype(np.uint64)
    anchor = leftmost_minima(seeds[: len(seeds) - seed + 1], length - seed + 1)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))[: len(anchor)]
    whole = np.arange(len(anchor)) + length <= off[doc + 1]
    edge = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])]
    start = np.flatnonzero(edge)
    windows = np.diff(np.r_[start, len(anchor)])
    keep = whole[start]
    start, windows = start[keep], windows[keep]
    at = anchor[start].astype(np.int64)
    return doc[start], start, windows, at - start, seeds[at] >> np.uint64(8)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the runs of equal values."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return first, np.r_[first[1:], len(values)][: len(first)]


def _ranges(n: np.ndarray) -> np.ndarray:
    """0 to n[0] - 1, 0 to n[1] - 1 and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _rows(bucket: np.ndarray, sender: int, blocks: list[bytes]) -> pa.Table:
    kinds = (pa.array(bucket.astype(np.int32)), pa.array(np.full(len(bucket), sender, np.int32)), pa.array(blocks, pa.binary()))
    return pa.table(kinds, names=["bucket", "sender", "block"])


def _dealt_entries(bucket: np.ndarray, sender: int, entries: np.ndarray) -> pa.Table:
    """Rows with the entries of each bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, entries = bucket[order], entries[order]
    first, ends = _groups(bucket)
    return _rows(bucket[first], sender, [_planes(entries[a:b]) for a, b in zip(first, ends, strict=True)])


def _planes(entries: np.ndarray) -> bytes:
    """The entries byte by byte: first all first bytes, then all second ones. Equal high bytes then lie together and compress."""
    return entries.view(np.uint8).reshape(len(entries), entries.dtype.itemsize).T.tobytes()


def _entries(data, kind: np.dtype, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8, n * kind.itemsize).reshape(kind.itemsize, n).T.copy().view(kind).reshape(n)


def _joined(table: pa.Table, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(entries, sender of each)."""
    parts = [_entries(x, kind, len(x) // kind.itemsize) for x in (b.as_py() for b in table.column("block"))]
    senders = np.repeat(table.column("sender").to_numpy(), [len(p) for p in parts]) if parts else np.zeros(0, np.int32)
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), senders


def _pick(h: np.ndarray, n: int) -> np.ndarray:
    return (mixed(h.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


class Stretch:
    """Some documents of a bucket with the fragments in them; without `named` only the documents and their units."""

    def __init__(self, table: pa.Table, raw: np.ndarray, off: np.ndarray, units: Units, length: int, seed: int, named: bool):
        self.table, self.raw, self.off, self.length, self.seed = table, raw, off, length, seed
        self.buffer, self.starts, self.unit_off, self.seeds = units(raw, off, named)
        self.ids = table.column("id").to_numpy()
        if named:
            self.doc, self.start, self.windows, self.at, self.hash = fragments(self.seeds, self.unit_off, length, seed)

    def bounds(self, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of the text of so many windows."""
        return self.starts[start], self.starts[start + windows + (self.length - 1)]

    def text(self, start: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """A hash of the text of so many windows, from the hashes of the seeds that cover it."""
        size = windows + (self.length - 1)
        h = size.astype(np.uint64)
        for k in range(0, int(size.max()) if len(size) else 0, self.seed):
            inside = k < size
            h = np.where(inside, mixed(h * np.uint64(0x9E3779B97F4A7C15) ^ self.seeds[start + np.minimum(k, size - self.seed)]), h)
        return h


def stretches(dealt: pa.Table, units: Units, length: int, seed: int, *, named: bool = True) -> Iterator[Stretch]:
    """The documents of a bucket, a few MB at a time; no document is cut."""
    for block in dealt.column("block"):
        table = pa.ipc.open_stream(block.as_py()).read_all()
        raw, off = utf8(table.column("text"))
        for i, j in whole_documents(off, STRETCH):
            yield Stretch(table.slice(i, j - i), raw[off[i] : off[j]], off[i : j + 1] - off[i], units, length, seed, named)


def _expanded(start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, start) of every single window."""
    return np.repeat(np.arange(len(start)), windows), np.repeat(start, windows) + _ranges(windows)


def repeated_spans(rows: DataFrame, size: int, units: Units, compare: Compare, finish, schema: str, *, length: int, seed: int, hot: int = HOT) -> DataFrame:
    """Run the exchange over rows of `keyed` and give each stretch of documents with its covered units to finish(stretch, gone)."""
    n = max(min(2 * partitions(rows.sparkSession), 64), -(-size // BUCKET))  # a small input in a few buckets: rows grow with their square

    def anchors(dealt: pa.Table) -> pa.Table:
        own = dealt.column("bucket")[0].as_py()
        found = []
        for s in stretches(dealt, units, length, seed):
            order = np.argsort(s.hash, kind="stable")
            h, doc = s.hash[order], s.doc[order]
            found.append(h[np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][: len(h)]])
        names, docs = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        entries = (names << np.uint64(8) | np.log2(np.maximum(docs, 1)).astype(np.uint64)).view(NAME)
        return _dealt_entries(_pick(names, n), own, entries)

    def repeated(table: pa.Table) -> pa.Table:
        entries, sender = _joined(table, NAME)
        name = entries["name"]
        order = np.argsort(name, kind="stable")
        h, docs, sender = name[order] >> np.uint64(8), np.int64(1) << (name[order] & np.uint64(255)).astype(np.int64), sender[order]
        first, ends = _groups(h)
        total = np.add.reduceat(docs, first)
        times = np.where(total > 1, ends - first, 0)
        keep = np.repeat(total > 1, ends - first)
        answer = (h[keep] << np.uint64(8) | np.repeat(total > hot, times).astype(np.uint64)).view(NAME)
        return _dealt_entries(sender[keep].astype(np.int64), table.column("bucket")[0].as_py(), answer)

    def texts(dealt: pa.Table, asked: pa.Table) -> pa.Table:
        if not dealt.num_rows or not asked.num_rows:
            return _rows(np.zeros(0, np.int64), 0, [])
        wanted = np.sort(_joined(asked, NAME)[0]["name"])
        names, crowded = wanted >> np.uint64(8), (wanted & np.uint64(255)) > 0
        heads, bodies = [], []
        for s in stretches(dealt, units, length, seed):
            k = np.minimum(np.searchsorted(names, s.hash), len(names) - 1)
            hit = names[k] == s.hash
            for single in (False, True):
                of = np.flatnonzero(hit & (crowded[k] == single))
                start, windows, at, name = s.start[of], s.windows[of], s.at[of], s.hash[of]
                if single:
                    part, start = _expanded(start, windows)
                    of, name, windows, at = of[part], name[part], np.ones(len(part), np.int64), at[part] - (start - s.start[of[part]])
                if not len(of):
                    continue
                lo, hi = s.bounds(start, windows)
                key = s.text(start, windows)
                order = np.argsort(key, kind="stable")
                first, _ = _groups(key[order])
                ids = s.ids[s.doc[of]][order]
                one = order[first]
                head = np.empty(len(one), TEXT)
                head["anchor"], head["text"], head["least"], head["size"], head["windows"], head["at"] = name[one], key[one], np.minimum.reduceat(ids, first), (hi - lo)[one], windows[one], at[one]
                head["hash"] = mixed(key[one]) >> np.uint64(8) if single else name[one]
                head["kind"] = SINGLE * single + SEVERAL * (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first))
                heads.append(head)
                bodies.append(s.buffer[np.repeat(lo[one], (hi - lo)[one]) + _ranges((hi - lo)[one])])
        if not heads:
            return _rows(np.zeros(0, np.int64), 0, [])
        head, body = np.concatenate(heads), np.concatenate(bodies)
        ends = np.cumsum(head["size"], dtype=np.int64)
        order = np.argsort(head["text"], kind="stable")
        first, stop = _groups(head["text"][order])
        least = np.minimum.reduceat(head["least"][order], first)
        several = (head["kind"][order] & SEVERAL) | SEVERAL * (np.repeat(least, stop - first) != head["least"][order])
        one = order[first]
        kind = np.maximum.reduceat(several, first) | (head["kind"][one] & SINGLE)
        head, begins, stops = head[one], (ends - head["size"])[one], ends[one]
        head["least"], head["kind"] = least, kind
        to = _pick(head["hash"], n)
        order = np.argsort(to, kind="stable")
        blocks, zstd = [], pa.Codec("zstd")
        first, stop = _groups(to[order])
        for a, b in zip(first, stop, strict=True):
            own = order[a:b]
            size = head["size"][own].astype(np.int64)
            text = body[np.repeat(begins[own], size) + _ranges(size)]
            blocks.append(np.int64(len(own)).tobytes() + _planes(head[own]) + zstd.compress(text.tobytes(), asbytes=True))
        return _rows(to[order][first], dealt.column("bucket")[0].as_py(), blocks)

    def compared(table: pa.Table) -> pa.Table:
        heads, bodies, zstd = [], [], pa.Codec("zstd")
        for block in table.column("block"):
            data = block.as_py()
            count = int(np.frombuffer(data, "<i8", 1)[0])
            heads.append(_entries(data[8 : 8 + count * TEXT.itemsize], TEXT, count))
            bodies.append(zstd.decompress(data[8 + heads[-1].nbytes :], int(heads[-1]["size"].sum(dtype=np.int64)), asbytes=True))
        sender = np.repeat(table.column("sender").to_numpy(), [len(h) for h in heads])
        head, body = np.concatenate(heads), b"".join(bodies)
        ends = np.cumsum(head["size"], dtype=np.int64)
        del heads, bodies
        order = np.lexsort((sender, head["hash"]))
        first, stop = _groups(head["hash"][order])
        weight = np.cumsum(head["size"][order], dtype=np.int64)[stop - 1]  # slices of whole groups
        share = np.flatnonzero(np.r_[True, weight[1:] // SLICE != weight[:-1] // SLICE])
        found = []
        for a, b in zip(first[share], np.r_[first[share[1:]], len(order)], strict=True):
            own = order[a:b]
            number: dict[bytes, int] = {}
            which = np.fromiter((number.setdefault(body[e - m : e], len(number)) for e, m in zip(ends[own].tolist(), head["size"][own].tolist(), strict=True)), np.int64, len(own))
            part = head[own]
            least = np.full(len(number), LAST_ID, np.int64)
            np.minimum.at(least, which, part["least"])
            example = np.zeros(len(number), np.int64)
            example[which[::-1]] = np.arange(len(which))[::-1]
            kinds, windows = part[example], part["windows"][example].astype(np.int64)
            owner = compare(list(number), kinds["hash"], kinds["at"].astype(np.int64), windows, least, sender[own][example])
            n_own = windows[which]
            k = _ranges(n_own)
            mine = owner[np.repeat((np.cumsum(windows) - windows)[which], n_own) + k]
            told = (mine < np.repeat(part["least"], n_own)) | np.repeat(part["kind"] == SINGLE | SEVERAL, n_own)
            before = np.r_[False, told[:-1] & (mine[1:] == mine[:-1])][: len(told)] & (k > 0)
            opens = np.flatnonzero(told & ~before)
            closes = np.flatnonzero(told & ~np.r_[before[1:], False][: len(told)])
            of = np.repeat(np.arange(len(own)), n_own)[opens]
            run = np.empty(len(opens), RUN)
            run["anchor"], run["text"], run["owner"], run["start"] = part["anchor"][of], part["text"][of], mine[opens], k[opens]
            run["size"] = np.where(part["kind"][of] & SINGLE, 0, closes - opens + 1)
            found.append((sender[own][of], run))
        runs = np.concatenate([r for _, r in found])
        return _dealt_entries(np.concatenate([s for s, _ in found]).astype(np.int64), table.column("bucket")[0].as_py(), runs)

    def ended(dealt: pa.Table, told: pa.Table) -> pa.Table:
        runs = _joined(told, RUN)[0]
        runs = runs[np.argsort(runs["text"], kind="stable")]
        loose = runs["size"] == 0
        singles, runs = runs[loose], runs[~loose]
        crowded = np.unique(singles["anchor"])
        found, key, ids = [], [], []
        for s in stretches(dealt, units, length, seed):
            own = s.ids[s.doc]
            key.append(s.text(s.start, s.windows))
            ids.append(own)
            of = np.flatnonzero(np.isin(s.hash, crowded)) if len(crowded) else np.zeros(0, np.int64)
            part, start = _expanded(s.start[of], s.windows[of])
            single = (own[of[part]], s.hash[of[part]], start, s.text(start, np.ones(len(part), np.int64)))
            found.append(((own, s.hash, s.start, key[-1]), single, s.windows))
        local, least = _smallest(np.concatenate(key), np.concatenate(ids))  # the smallest id that a text has in this bucket
        del key, ids
        out = []
        for s, (plain, single, windows) in zip(stretches(dealt, units, length, seed, named=False), found, strict=True):
            change = np.zeros(int(s.unit_off[-1]) + 1, np.int32)

            def cover(begin: np.ndarray, windows: np.ndarray, change=change) -> None:
                np.add.at(change, begin, 1)
                np.add.at(change, begin + windows + (length - 1), -1)

            if len(local):
                own, _, start, text = plain
                k = np.minimum(np.searchsorted(local, text), len(local) - 1)
                gone = (local[k] == text) & (least[k] < own)
                cover(start[gone], windows[gone])
            for these, (own, anchor, start, text) in ((runs, plain), (singles, single)):
                lo = np.searchsorted(these["text"], text, "left")
                n_own = np.searchsorted(these["text"], text, "right") - lo
                place = np.repeat(np.arange(len(text)), n_own)
                run = these[np.repeat(lo, n_own) + _ranges(n_own)]
                gone = (run["owner"] < own[place]) & (run["anchor"] == anchor[place])
                cover(start[place][gone] + run["start"][gone], np.maximum(run["size"][gone], 1).astype(np.int64))
            out.append(finish(s, np.cumsum(change[:-1]) > 0))
        return pa.concat_tables(out)

    dealt = rows.mapInArrow(_dealer(n), "bucket int, block binary")
    asked = dealt.groupBy("bucket").applyInArrow(lambda t: _frugal(anchors, t), KIND).groupBy("bucket").applyInArrow(lambda t: _frugal(repeated, t), KIND)
    sent = dealt.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(lambda t, u: _frugal(texts, t, u), KIND)
    told = sent.groupBy("bucket").applyInArrow(lambda t: _frugal(compared, t), KIND)
    return dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(lambda t, u: _frugal(ended, t, u), schema)


def _frugal(step: Callable, *tables: pa.Table) -> pa.Table:
    """step(*tables), with the memory that it freed given back before the next bucket."""
    out = step(*tables)
    give_back()
    return out


def _smallest(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys that occur more than once, in order; the smallest id of each)."""
    order = np.argsort(key, kind="stable")
    first, stop = _groups(key[order])
    twice = stop - first > 1
    least = np.minimum.reduceat(ids[order], first)[twice] if len(first) else ids
    return key[order][first[twice]], least


def _dealer(n: int):
    """Rows dealt to buckets of documents, as one compressed Arrow stream for each bucket and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            bucket = _pick(batch.column(0).to_numpy(), n)
            order = np.argsort(bucket, kind="stable")
            bucket, batch = bucket[order], batch.take(pa.array(order))
            first, stop = _groups(bucket)
            blocks = []
            for lo, hi in zip(first, stop, strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.slice(lo, hi - lo).columns], schema=batch.schema))
                blocks.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(blocks, pa.binary())], ["bucket", "block"])

    return run
