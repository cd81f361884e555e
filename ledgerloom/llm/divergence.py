"""How the sources of a language differ in their words: exact smoothed frequencies, chi-square-like distances, and the words that tell.

1. Each task hashes the words of its documents into a count-min table of document frequencies, saturated at the wanted minimum; tables are
   merged slice by slice. A cell never holds less than the frequency of each word in it, so a word with a lower cell is too rare, for
   certain. What goes to every task is one bit a cell: ROWS * WIDTH / 8 bytes, whatever the input.
2. Tasks count the words that may be frequent enough, by language and source, and send partial counts; sums are exact, and the words
   below the minimum (which the table let through) go.
3. Frequencies are whole numbers in 1e-9. A word that a source lacks has the source's smallest frequency, so the distance of two
   sources is the sum over the words that both have, corrected for those that one of them has, which follows from how many
   words occur how often in each.

Edge cases: null text, language and source are ''; documents without words count as members of their source; a language without kept
words has distances of 0; ties go to the smaller name in UTF-8; doc_id isn't read, so null and repeated ids don't matter, and a
repeated row is a document of its own; an empty table gives no rows; other columns are ignored. Counts may reach 1e28.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, give_back, mixed, table, utf8, whole_documents

LEAST, SHOWN, UNIT = 3, 200, 1_000_000_000
ROWS, WIDTH, SLICE = 4, 1 << 22, 1 << 16  # of the table; a larger WIDTH lets fewer rare words through
CHUNK, PIECE = 32 << 20, 2 << 20  # bytes of text that a task counts before it sends what it has, and that it splits into words at a time
_FOLD = np.zeros(256, np.uint8)  # letters and the bytes of non-ASCII characters as they count, 0 for all that parts words
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _split(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lengths, documents) of the words of a buffer of documents: runs of letters and non-ASCII characters, A-Z in lower case."""
    low = _FOLD[raw]
    inside = low != 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = off[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begins[cuts] |= inside[cuts]
    stops[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return low[inside], np.flatnonzero(stops) + 1 - starts, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(starts, off)))


class Words:
    """The words of some documents: vocabulary, the names of their languages and groups, and one entry for each document and word of it.

    lang, group (a language and source) and code say what an entry is about, times how often the word occurs in the document.
    """

    def __init__(self, batches: list[pa.RecordBatch]):
        data, lengths, docs, langs, sources, seen = [], [], [], [], [], 0
        for batch in batches:
            raw, off = utf8(batch["text"])
            for i, j in whole_documents(off, PIECE):
                found = _split(raw[off[i] : off[j]], off[i : j + 1] - off[i])
                for to, v in zip((data, lengths, docs), (found[0], found[1].astype(np.int32), (found[2] + i + seen).astype(np.int32)), strict=True):
                    to.append(v)
            langs += batch["lang"].to_pylist()
            sources += batch["source"].to_pylist()
            seen += batch.num_rows
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        offsets = np.concatenate([[0], np.cumsum(joined(lengths, np.int32), dtype=np.int64)])
        words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined(data, np.uint8))]).dictionary_encode()
        self.vocabulary, size = words.dictionary, max(1, len(words.dictionary))
        ids: dict = {}
        lang_of = np.fromiter((ids.setdefault(k, len(ids)) for k in langs), np.int64, seen)
        self.langs, ids = list(ids), {}
        group_of = np.fromiter((ids.setdefault(k, len(ids)) for k in zip(langs, sources, strict=True)), np.int64, seen)
        self.groups = list(ids)
        own, self.times = np.unique(joined(docs, np.int32).astype(np.int64) * size + np.asarray(words.indices).astype(np.int64), return_counts=True)
        doc, self.code = np.divmod(own, size)
        self.lang, self.group, self.size = lang_of[doc], group_of[doc], size

    def by(self, what: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(what, code, occurrences, documents) of every word of every language or group, in that order."""
        key = what * self.size + self.code
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        times = np.add.reduceat(self.times[order], first) if len(key) else first
        return *np.divmod(key[first], self.size), times, np.diff(np.r_[first, len(key)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    held, size = [], 0
    for batch in batches:
        if size and size + batch.nbytes > CHUNK:
            yield Words(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield Words(held)


def _cells(lang: str, words: list[bytes], width: int) -> np.ndarray:
    """Cells of words, one row of the result for each row of the table."""
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    own = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))
    step = mixed(own) | np.uint64(1)
    return np.stack([(own + np.uint64(k) * step) >> np.uint64(64 - width.bit_length() + 1) for k in range(ROWS)]).astype(np.int64)


def sketch(docs: DataFrame, *, least: int = LEAST, width: int = WIDTH) -> np.ndarray:
    """Bits (ROWS, width / 8) of the cells that `least` documents or more reach; docs(lang, source, text) without nulls."""
    cells = min(SLICE, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((ROWS, width), np.uint16)
        for words in _chunks(batches):
            lang, code, _, df = words.by(words.lang)
            often = np.minimum(df, least).astype(np.uint16)
            for k, name in enumerate(words.langs):
                own = np.flatnonzero(lang == k)
                at = _cells(name, words.vocabulary.take(pa.array(code[own])).to_pylist(), width)
                for i in range(0, len(own), 20_000):  # so that no cell overflows before it is cut back to `least`
                    for row, cell in zip(held, at[:, i : i + 20_000], strict=True):
                        np.add.at(row, cell, often[own[i : i + 20_000]])
                        row[cell] = np.minimum(row[cell], least)
        flat = held.astype(np.uint8).reshape(-1, cells)
        used = np.flatnonzero(flat.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(flat[k].tobytes(), 1) for k in used], pa.binary())], ["slice", "held"])
        give_back()

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint8)
        for batch in batches:
            for held in batch["held"]:
                total = np.minimum(total + np.frombuffer(zlib.decompress(held.as_py()), np.uint8), least).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["slice", "held"])

    schema = "slice int, held binary"
    own = docs.select("lang", "source", "text").mapInArrow(count, schema).withColumn("salt", F.spark_partition_id() % 64)
    for keys in (["slice", "salt"], ["slice"]):  # so no task reads the tables of all others
        own = own.groupBy(*keys).applyInArrow(merge, schema)
    full = np.zeros((ROWS * width) // cells * cells // 8, np.uint8).reshape(-1, cells // 8)
    for k, held in own.collect():  # ROWS * width cells at most
        full[k] = np.packbits(np.frombuffer(zlib.decompress(held), np.uint8) >= least)
    return full.reshape(ROWS, width // 8)


def counts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """lang, source, term, n (occurrences), df (documents) of the words that the table lets through; term '' stands for the group itself."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    width = bits.shape[1] * 8

    names = ["lang", "source", "term", "n", "df"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, groups_seen = shared.value, set()
        for words in _chunks(batches):
            lang, code, _, _ = words.by(words.lang)
            may = np.ones(len(code), bool)
            for k, name in enumerate(words.langs):
                own = np.flatnonzero(lang == k)
                for row, at in zip(table, _cells(name, words.vocabulary.take(pa.array(code[own])).to_pylist(), width), strict=True):
                    may[own] &= (row[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            lang_of = np.array([words.langs.index(la) for la, _ in words.groups], np.int64)
            group, term, n, df = words.by(words.group)
            kept = may[np.searchsorted(lang * words.size + code, lang_of[group] * words.size + term)] if len(group) else np.zeros(0, bool)
            group = pa.array(group[kept])
            said = [pa.array([g[k] for g in words.groups], pa.string()).take(group) for k in (0, 1)]
            rows = pa.RecordBatch.from_arrays([*said, words.vocabulary.take(pa.array(term[kept])).cast(pa.large_string()).cast(pa.string()), pa.array(n[kept]), pa.array(df[kept])], names)
            yield from (rows.slice(k, 50_000) for k in range(0, rows.num_rows, 50_000))
            new = [g for g in words.groups if g not in groups_seen]
            groups_seen.update(new)
            none = pa.array([0] * len(new), pa.int64())
            yield pa.RecordBatch.from_arrays([*(pa.array([g[k] for g in new], pa.string()) for k in (0, 1)), pa.array([""] * len(new), pa.string()), none, none], names)
        give_back()

    part = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, df long")
    # tasks have summed up what they can; dealt by word, all sources of a word meet, and no later step on words needs another exchange
    return part.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def frequency(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)): exact, also where the product passes 64 bits."""
    wide = lambda c: c.cast("decimal(28,0)")
    ratio = F.call_function("div", wide(n + 1) * F.lit(UNIT).cast("decimal(10,0)"), wide(total + kept))
    return (ratio + 1).cast("long")


def distance(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, *, least: int = LEAST, shown: int = SHOWN, width: int = WIDTH) -> DataFrame:
    """lang, source, part, item, value, rank of docs(lang, source, text): all pairs of sources of a language, and each source's `shown` words."""
    c = F.col
    own = docs.select(*[F.coalesce(c(k).cast("string"), F.lit("")).alias(k) for k in ("lang", "source", "text")])
    of_word = Window.partitionBy("lang", "term")
    found = counts(own, sketch(own, least=least, width=width)).withColumns({"all_n": F.sum("n").over(of_word), "all_df": F.sum("df").over(of_word)})
    found = cut(found.filter((c("all_df") >= least) | (c("term") == "")).drop("df", "all_df"))
    words = found.filter("term <> ''")
    langs = words.groupBy("lang", "term").agg(F.max("all_n").alias("all_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total"))
    totals = words.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = found.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), "all_total")
    groups = cut(groups.withColumn("base", F.when(c("v") > 0, frequency(F.lit(0), c("total"), c("v")))))
    words = words.join(groups, ["lang", "source"]).withColumn("p", frequency(c("n"), c("total"), c("v")))

    telling = words.withColumn("q", frequency(c("all_n"), c("all_total"), c("v"))).filter("p > q")
    telling = telling.select("lang", "source", F.lit("term").alias("part"), c("term").alias("item"), distance(c("p"), c("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(c("value").desc(), c("item"))
    telling = telling.withColumn("rank", F.row_number().over(order)).filter(c("rank") <= shown)

    side = lambda df, name, *cols: df.select(*[c(k) if k in ("lang", "term") else c(k).alias(f"{name}_{k}") for k in cols])
    other = c("g_source") != c("h_source")
    pairs = side(groups, "g", "lang", "source", "base").join(side(groups, "h", "lang", "source", "base", "v"), "lang").filter(other)
    both = side(words, "g", "lang", "term", "source", "p", "base").join(side(words, "h", "lang", "term", "source", "p", "base"), ["lang", "term"]).filter("g_source < h_source")
    p, q, a, b = c("g_p"), c("h_p"), c("g_base"), c("h_base")
    excess = lambda p, q, a, b: F.sum(distance(p, q) - distance(p, b) - distance(a, q) + distance(a, b))
    both = both.groupBy("lang", "g_source", "h_source").agg(excess(p, q, a, b).alias("there"), excess(q, p, b, a).alias("back"))
    shared = both.select("lang", "g_source", "h_source", c("there").alias("shared")).unionByName(both.select("lang", c("h_source").alias("g_source"), c("g_source").alias("h_source"), c("back").alias("shared")))
    levels = words.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))  # how many words of a source have one frequency
    own_levels = side(levels, "g", "lang", "source", "p", "times").join(side(groups, "h", "lang", "source", "base"), "lang").filter(other)
    mine = own_levels.groupBy("lang", "g_source", "h_source").agg(F.sum(c("g_times") * distance(p, b)).alias("mine"), F.sum("g_times").alias("g_words"))
    their_levels = side(levels, "h", "lang", "source", "p", "times").join(side(groups, "g", "lang", "source", "base"), "lang").filter(other)
    theirs = their_levels.groupBy("lang", "g_source", "h_source").agg(F.sum(c("h_times") * distance(a, q)).alias("theirs"), F.sum("h_times").alias("h_words"))
    key = ["lang", "g_source", "h_source"]
    pairs = pairs.join(shared, key, "left").join(mine, key, "left").join(theirs, key, "left")
    zero = lambda k: F.coalesce(c(k), F.lit(0))
    rest = (c("h_v") - zero("g_words") - zero("h_words")) * distance(a, b)  # words of both are counted twice; `shared` gives them back
    value = F.when(c("h_v") > 0, zero("shared") + zero("mine") + zero("theirs") + rest).otherwise(0)
    pairs = pairs.select("lang", c("g_source").alias("source"), F.lit("pair").alias("part"), c("h_source").alias("item"), value.cast("long").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(telling)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = """WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT lang, source, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
n AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT doc_id) AS df FROM t GROUP BY ALL), k AS (SELECT lang, term, sum(n) AS n FROM n GROUP BY ALL HAVING sum(df) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang), g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, k.n AS all_n FROM g JOIN k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS (SELECT c.lang, c.source, term, n, 1 + CAST(1000000000 * CAST(n + 1 AS HUGEINT) // (sum(n) OVER (PARTITION BY c.lang, c.source) + v) AS HUGEINT) AS p, 1 + CAST(1000000000 * CAST(all_n + 1 AS HUGEINT) // (total + v) AS HUGEINT) AS q FROM c JOIN v ON v.lang = c.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
r AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r) SELECT * FROM o WHERE part = 'pair' OR rank <= 200"""
