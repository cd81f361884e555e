"""Merkle manifest of a table: a tree over the rows of every source, a tree over the sources, and a proof for each row.

1. Every row becomes a leaf in the JVM. Leaves are dealt by ranges of source, id and digest, so that each partition holds
   neighbours, and each partition learns the index of its first leaf from counts (one number a partition).
2. A partition keeps a stack of mountains: at each level the nodes of the run that is not full yet. A run of `fanout` nodes becomes
   its parent, a carry in base `fanout`. Every node is written; those whose run crosses the partition's edge are `open`.
3. Open nodes meet by tree and run, level by level: at most 2 * (fanout - 1) of them a level and partition. The last run of a level
   may be short, without padding; a run that is a single node of index 0 is the top.
4. Proofs need the runs above each row: they are handed down from the tops, a join of fan-out `fanout` a level, and meet the rows
   in blocks of fanout ** 2 neighbours.

Edge cases: null columns are `-`; a null source is a source of its own, before all others; null ids stand first in their source,
equal ids in the order of their digests; repeated rows are leaves of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, give_back, partitions, table

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ROWS_A_PARTITION = 2_000_000  # leaves; a partition is streamed, so this bounds a task's time only
NODES = "tree string, level int, idx long, digest string, open boolean, doc_id long, mate string"


def leaf(columns: list[Column]) -> Column:
    """Digest of one row: each value as its UTF-8 length, a colon and itself, or `-` if it is null."""
    said = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in said]), 256)


def tree_of(source: Column) -> Column:
    """The source as the name of a tree: names sort as sources do, null first."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), source.cast("string")))


class Mountains:
    """The stack over consecutive leaves of one tree: at each level the index of the first node held, and the nodes of its run."""

    def __init__(self, fanout: int, emit):
        self.fanout, self.emit, self.held = fanout, emit, []

    def add(self, idx: int, node: tuple) -> None:
        level = 0
        while True:
            if level == len(self.held):
                self.held.append([idx, []])
            own = self.held[level]
            if not own[1]:
                own[0] = idx
            own[1].append(node)
            if (idx + 1) % self.fanout:
                return
            first, run = own
            self.held[level] = [0, []]
            whole = len(run) == self.fanout
            self.emit(level, first, run, not whole)
            if not whole:  # its first nodes lie in an earlier partition
                return
            node, level, idx = (joined([n[0] for n in run]), None, None), level + 1, idx // self.fanout

    def close(self) -> None:
        for level, (first, run) in enumerate(self.held):
            if run:
                self.emit(level, first, run, True)
        self.held = []


def joined(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def ranged(leaves: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, dict[int, int]]:
    """leaves(tree, doc_id, digest, mate) dealt by ranges of tree and order, with their partition; the index of each partition's first leaf.

    Rows that agree in all these columns are told apart by a row number, so that even they can be dealt to several partitions.
    """
    held = cut(leaves.withColumn("row", F.monotonically_increasing_id()))  # ranging reads its input twice
    n = max(partitions(leaves.sparkSession), held.count() // ROWS_A_PARTITION)
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order, "row")]
    dealt = cut(held.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("row").withColumn("part", F.spark_partition_id()))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition of the tree
    counts = dealt.groupBy("part", "tree").count().withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0)))
    return dealt, dict(map(tuple, counts.groupBy("part").agg(F.min_by("before", "tree")).collect()))


def mountains(dealt: DataFrame, starts: dict[int, int], fanout: int = FANOUT) -> DataFrame:
    """All nodes that single partitions can make, leaves included: NODES."""
    begin = dealt.sparkSession.sparkContext.broadcast(starts)
    names = [c.split()[0] for c in NODES.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[] for _ in names]
        tree, idx, stack = None, 0, None

        def emit(level: int, first: int, nodes: list[tuple], is_open: bool) -> None:
            k = len(nodes)
            for to, v in zip(rows, ([tree] * k, [level] * k, range(first, first + k), [n[0] for n in nodes], [is_open] * k, [n[1] for n in nodes], [n[2] for n in nodes]), strict=True):
                to.extend(v)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds, strict=True)], names)
            for v in rows:
                v.clear()
            return batch

        for batch in batches:
            for own, node, part in zip(batch["tree"].to_pylist(), zip(*[batch[c].to_pylist() for c in ("digest", "doc_id", "mate")], strict=True), batch["part"].to_pylist(), strict=True):
                if stack is None or own != tree:
                    if stack is not None:
                        stack.close()
                    idx = begin.value[part] if stack is None else 0
                    tree, stack = own, Mountains(fanout, emit)
                stack.add(idx, node)
                idx += 1
            if len(rows[0]) > 20_000:
                yield flush()
        if stack is not None:
            stack.close()
        yield flush()
        give_back()

    return dealt.select("tree", "digest", "doc_id", "mate", "part").mapInArrow(run, NODES)


def _runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """tree, run and hashes: digests of neighbouring nodes of one level, in order."""
    per = nodes.groupBy("tree", F.floor(F.col("idx") / fanout).alias("run")).agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("own"))
    return per.select("tree", "run", F.col("own.digest").alias("hashes"))


def merged(made: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame, int]:
    """The nodes above the partitions' edges, the top of every tree (tree, level, digest), and the highest level of a top.

    A level is one grouping of what is open there, written before the next one reads it.
    """
    opened = made.filter("open").select("tree", "level", "idx", "digest")
    last = opened.agg(F.max("level")).first()[0]
    above, tops, rising, level = opened.limit(0), opened.limit(0).drop("idx"), None, 0
    while last is not None and (level <= last or rising is not None):
        own = opened.filter(F.col("level") == level)
        own = own if rising is None else own.unionByName(rising)
        runs = _runs(own, fanout)
        top = (F.col("run") == 0) & (F.size("hashes") == 1)
        runs = cut(runs.select("tree", "run", top.alias("top"), F.when(top, F.get("hashes", F.lit(0))).otherwise(F.sha2(F.array_join("hashes", ""), 256)).alias("digest")))
        tops = tops.unionByName(runs.filter("top").select("tree", F.lit(level).alias("level"), "digest"))
        found = runs.filter("not top")
        rising = None if found.isEmpty() else found.select("tree", F.lit(level + 1).alias("level"), F.col("run").alias("idx"), "digest")
        above = above if rising is None else above.unionByName(rising)
        level += 1
    return above, tops, level - 1


def grown(leaves: DataFrame, order: tuple[str, ...], fanout: int = FANOUT) -> tuple[DataFrame, DataFrame, int]:
    """(nodes, tops, highest level) of the trees over leaves(tree, doc_id, digest, mate); the nodes of level 0 are the leaves."""
    dealt, starts = ranged(leaves, order)
    made = cut(mountains(dealt, starts, fanout))
    above, tops, level = merged(made, fanout)
    return made.drop("open").unionByName(above, allowMissingColumns=True), tops, level


def handed_down(nodes: DataFrame, tops: DataFrame, highest: int, base: int, fanout: int = FANOUT) -> DataFrame:
    """tops with run and path: for every run of the level `base`, the runs from there to the top, the lowest first."""
    path = tops.withColumns({"run": F.lit(0).cast("long"), "path": F.array().cast("array<array<string>>")})
    kept = [c for c in path.columns if c not in ("tree", "run", "path")]
    for level in range(highest, base - 1, -1):
        runs = _runs(nodes.filter(F.col("level") == level), fanout).filter("run > 0 or size(hashes) > 1")
        runs = runs.select(F.col("tree").alias("of"), F.col("run").alias("below"), F.floor(F.col("run") / fanout).alias("under"), "hashes")
        path = path.join(runs, (F.col("tree") == F.col("of")) & (F.col("run") == F.col("under")), "left")
        more = F.when(F.col("hashes").isNull(), F.col("path")).otherwise(F.concat(F.array("hashes"), "path"))
        path = path.select("tree", F.coalesce("below", "run").alias("run"), more.alias("path"), *kept)
    return path


def manifest(leaves: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame, int]:
    """(nodes of the sources' trees, one row per source with its way to the root, highest level of the former).

    leaves: tree, doc_id, digest, mate (another digest that travels along). nodes: tree, level, idx, digest; leaves have doc_id and
    mate, too. The rows: tree, subroot, place (among the sources), upper (the runs from the subroots to the root), root.
    """
    nodes, tops, highest = grown(leaves, ("doc_id", "digest"), fanout)
    subroots = tops.select(F.lit("").alias("tree"), F.lit(None).cast("long").alias("doc_id"), "digest", F.col("tree").alias("mate"))
    upper, crown, last = grown(subroots, ("mate",), fanout)
    ways = handed_down(upper, crown.select("tree", F.col("digest").alias("root")), last, 0, fanout).select("run", F.col("path").alias("upper"), "root")
    if last == 0:  # one source: its subroot is the root
        ways = crown.select(F.lit(0).cast("long").alias("run"), F.array().cast("array<array<string>>").alias("upper"), F.col("digest").alias("root"))
    places = upper.filter("level = 0").select(F.col("mate").alias("tree"), F.col("digest").alias("subroot"), F.col("idx").alias("place"), F.floor(F.col("idx") / fanout).alias("run"))
    return nodes, places.join(ways, "run").drop("run"), highest


PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(nodes: DataFrame, ways: DataFrame, highest: int, fanout: int = FANOUT) -> DataFrame:
    """PROOFS of every leaf: the digest of its siblings, and the root that its mate (or itself, if null) folds to with them."""
    block = fanout * fanout
    own = nodes.filter("level = 0").withColumn("block", F.floor(F.col("idx") / block))
    own = own.groupBy("tree", "block").agg(F.array_sort(F.collect_list(F.struct("idx", "digest", "doc_id", "mate"))).alias("own"))
    own = own.select("tree", "block", F.floor(F.col("block") / fanout).alias("run"), F.col("own.digest").alias("digests"), F.col("own.doc_id").alias("ids"), F.col("own.mate").alias("mates"))
    above = handed_down(nodes, ways, highest, 2, fanout)
    both = own.join(above, ["tree", "run"]).select("block", "digests", "ids", "mates", "path", "place", "upper", "subroot", "root")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _block(batch.slice(k, 1).to_pylist()[0], fanout)
        give_back()

    return both.mapInArrow(run, PROOFS)


def _sides(place: int, runs: list[list[str]], fanout: int) -> list[tuple[str, str]]:
    """What stands left and right of a node and of its ancestors in their runs, from the run of the node to the last one."""
    out = []
    for run in runs:
        k = place % fanout
        out.append(("".join(run[:k]), "".join(run[k + 1 :])))
        place //= fanout
    return out


def _block(row: dict, fanout: int) -> pa.RecordBatch:
    """PROOFS of the leaves of one block: fanout * fanout neighbours, or the last ones of a tree."""
    leaves, block = row["digests"], row["block"]
    low = [leaves[k : k + fanout] for k in range(0, len(leaves), fanout)]
    alone = block == 0 and len(leaves) == 1  # the only leaf of its tree is the subroot
    middle = [joined(run) for run in low]
    high = _sides(block, row["path"], fanout) + _sides(row["place"], row["upper"], fanout)
    tail = "".join(left + right for left, right in high)
    digests, folded = [], []
    for k, (digest, mate) in enumerate(zip(leaves, row["mates"], strict=True)):
        sides = [] if alone else _sides(k, [low[k // fanout]], fanout)
        if block or len(middle) > 1:
            sides += _sides(k // fanout, [middle], fanout)
        digests.append(sha256(("".join(left + right for left, right in sides) + tail).encode()).hexdigest())
        at = digest if mate is None else mate
        for left, right in sides + high:
            at = sha256(f"{left}{at}{right}".encode()).hexdigest()
        folded.append(at)
    n, root = len(leaves), row["root"]
    values = [row["ids"], leaves, [row["subroot"]] * n, [root] * n, digests, folded, [f == root for f in folded]]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], [c.split()[0] for c in PROOFS.split(", ")])


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of documents by source, with a proof per row; where 5 divides crc32 of the id, the text's A-Z were lower-cased since."""
    c = F.col
    tampered = F.crc32(c("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate(c("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    docs = table(spark, sf_dir, "documents")
    own = [c(k) for k in COLUMNS]
    leaves = docs.select(tree_of(c("source")).alias("tree"), c("doc_id").cast("long").alias("doc_id"), leaf(own).alias("digest"), F.when(tampered, leaf([*own[:-1], lowered])).alias("mate"))
    nodes, ways, highest = manifest(leaves)
    return proofs(nodes, ways, highest)


def _said(columns: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({k} AS VARCHAR)) || ':' || CAST({k} AS VARCHAR), '-')" for k in columns.split(", "))


_GROWN = """{0}(tree, level, idx, digest) AS ({1} UNION ALL SELECT tree, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS c FROM {0}) WHERE c > 1 GROUP BY tree, level, idx // 16),
{0}_c AS (SELECT *, count(*) OVER (PARTITION BY tree, level) AS c FROM {0})"""
_FOLDED = """{0}(rk, tree, level, idx, folded, sib) AS ({2} UNION ALL SELECT f.rk, f.tree, f.level + 1, f.idx // 16, sha256(string_agg(CASE WHEN n.idx = f.idx THEN f.folded ELSE n.digest END, '' ORDER BY n.idx)),
f.sib || coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx <> f.idx), '') FROM {0} f JOIN {1}_c n ON n.tree = f.tree AND n.level = f.level AND n.idx // 16 = f.idx // 16 WHERE n.c > 1 GROUP BY f.rk, f.tree, f.level, f.idx, f.folded, f.sib),
{0}_end AS (SELECT rk, arg_max(folded, level) AS folded, arg_max(sib, level) AS sib FROM {0} GROUP BY rk)"""
ORACLE = (
    f"""WITH RECURSIVE d AS (SELECT *, coalesce('+' || source, '') AS tree, {_said(", ".join(COLUMNS))} AS said, row_number() OVER () AS rk FROM documents),
e AS (SELECT *, sha256(said) AS leaf, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) WHEN r & 1 = 1 THEN xor(r >> 1, CAST(3988292384 AS BIGINT)) ELSE r >> 1 END), CAST(4294967295 AS BIGINT)) AS crc FROM d),
l AS (SELECT *, CASE WHEN crc % 5 = 0 THEN sha256({_said("doc_id, source, lang, n_chars, low")}) ELSE leaf END AS told, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
FROM (SELECT *, translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS low FROM e)),
"""
    + _GROWN.format("n", "SELECT tree, 0, idx, leaf FROM l")
    + ", s AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM n_c WHERE c = 1 QUALIFY row_number() OVER (PARTITION BY tree ORDER BY level) = 1), "
    + _GROWN.format("u", "SELECT '', 0, place, digest FROM s")
    + ", "
    + _FOLDED.format("f", "n", "SELECT rk, tree, 0, idx, told, '' FROM l")
    + ", "
    + _FOLDED.format("g", "u", "SELECT l.rk, '', 0, s.place, f_end.folded, f_end.sib FROM l JOIN s ON s.tree = l.tree JOIN f_end ON f_end.rk = l.rk")
    + """, r AS (SELECT digest AS root FROM u_c WHERE c = 1 ORDER BY level LIMIT 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(sib) AS proof_sha256, folded AS folded_root, folded = root AS verified FROM l JOIN s ON s.tree = l.tree JOIN g_end ON g_end.rk = l.rk, r"""
)
