"""Mix sources to target weights by a low-discrepancy schedule of equal-token blocks. DataFrame operations only.

A source of target t takes round(t) words of its shuffled word stream, starting anew after its last word (two rounds at most).
The stream is cut into blocks of `block` words that run on over the end of a round, so all slots are equal in tokens but the last
one of a source. Slot i of the mix has the point frac((i + 1/2) / golden ratio); the cumulative targets say which source the
point falls to, and the slots of a source take its blocks in turn. As the points are spread evenly, every stretch of the mix is
close to the wanted proportions. A source that gets more points than it has blocks leaves the rest unused; the few blocks of one
that gets less are put evenly between the others. So the words taken are within half a word of the target, whatever the size of
the source.

Every running sum over documents or slots is taken in two levels (sums of small groups, then rows inside a group), so no source,
however large, has to pass through one task. The table of sources, one row each, is summed in one task.

Edge cases: a null or empty text has size 0 and takes nothing; a null source is a source of its own and sorts last; repeated
rows are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, word_count

SMALL = 10_000  # rows of the source table up to which it is broadcast
SCALE, POINT, PERIOD = 10**10, 6_180_339_887, 1 << 29  # the golden ratio in units of 1 / SCALE; points repeat after PERIOD slots
GRID = 1024  # parts of the unit interval by which points and sources are joined; as many as sources, if these are more


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def source_targets(sized: DataFrame, weights: tuple[float, ...], total_ratio: float, repeat: float) -> DataFrame:
    """source, sid (rank by code point, null last), source_size, target: weighted shares of the total, stopped at repeat * size.

    The shares are those of repeated resharing: with the sources in order of cap / weight, a source stops at its cap exactly
    if the share per weight left for it and all later sources would pass the cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("sid", F.row_number().over(order))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") - 1) % len(weights) + 1)
    per = per.withColumn("w", weight).withColumn("cap", F.lit(float(repeat)) * F.col("source_size"))
    every = Window.partitionBy()
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("sid").asc())
    upto = fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("left_total", F.lit(float(total_ratio)) * F.sum("source_size").over(every) - F.sum("cap").over(upto) + F.col("cap"))
    per = per.withColumn("left_w", F.sum("w").over(every) - F.sum("w").over(upto) + F.col("w"))
    per = per.withColumn("full", F.col("left_total") >= F.col("cap") / F.col("w") * F.col("left_w"))
    first = F.first(F.when(~F.col("full"), F.col("left_total") / F.col("left_w")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.select("source", "sid", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(first * F.col("w")).alias("target"))


def placed(sized: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Every document with its place [begins, begins + size) in the shuffled word stream of its source."""
    docs = sized.join(_small(sources.withColumnRenamed("source", "of"), n_sources), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    docs = docs.withColumn("cell", F.substring("shuffle", 1, 3))
    cells = docs.groupBy("sid", "cell").agg(F.sum("size").alias("cell_size"))
    ahead = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("sid", "cell", F.coalesce(F.sum("cell_size").over(ahead), F.lit(0)).alias("cell_begins"))
    inside = Window.partitionBy("sid", "cell").orderBy("shuffle", "doc_id", "size", "row_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    docs = docs.withColumn("within", F.sum("size").over(inside) - F.col("size"))
    return docs.join(cells, ["sid", "cell"]).withColumn("begins", F.col("cell_begins") + F.col("within"))


def schedule(sources: DataFrame, n_sources: int, n_slots: int, block: int) -> DataFrame:
    """slot, sid, k, words: slot number in the mix; the k-th block of the source's endless stream; how many of its words."""
    order = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.sum("target").over(order) / F.sum("target").over(Window.partitionBy())
    own = sources.withColumn("hi", F.floor(F.round(share, 12) * SCALE)).withColumn("lo", F.lag("hi", 1, 0).over(Window.orderBy("sid")))
    own = own.filter("words > 0").select("sid", "words", "lo", "hi", F.ceil(F.col("words") / block).alias("need"))
    grid = SCALE // max(GRID, min(n_sources, SCALE // GRID))
    parts = own.filter("hi > lo").withColumn("grid", F.explode(F.sequence(F.floor(F.col("lo") / grid), F.floor((F.col("hi") - 1) / grid))))
    run = 1024
    while run * run < n_slots:
        run *= 2
    points = sources.sparkSession.range(n_slots).select(F.col("id").alias("i"), ((F.col("id") % PERIOD * 2 + 1) * F.lit(POINT) % SCALE).alias("u"))
    hit = points.withColumn("grid", F.floor(F.col("u") / grid)).join(_small(parts, n_sources), "grid").filter("u >= lo and u < hi")
    hit = hit.select("i", "sid", "words", "need", F.floor(F.col("i") / run).alias("run"))
    runs = hit.groupBy("sid", "run").agg(F.count("*").alias("n"), F.max("i").alias("end"))
    ahead = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = cut(runs.select("sid", "run", "n", "end", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")))
    ranked = hit.withColumn("inside", F.row_number().over(Window.partitionBy("sid", "run").orderBy("i")) - 1).join(runs.drop("n", "end"), ["sid", "run"])
    ranked = ranked.select("sid", "words", (F.col("inside") + F.col("ahead")).alias("k"), "need", F.col("i").cast("double").alias("at")).filter("k < need")
    have = own.join(runs.groupBy("sid").agg(F.sum("n").alias("have"), F.max("end").alias("end")), "sid", "left").withColumn("have", F.coalesce("have", F.lit(0)))
    late = have.filter("have < need").withColumn("k", F.explode(F.sequence(F.col("have"), F.col("need") - 1)))
    even, after = (F.col("k") + 0.5) / F.col("need") * n_slots - 0.5, F.coalesce(F.col("end") + (F.col("k") - F.col("have") + 0.5) / F.col("need"), F.lit(0.0))
    late = late.select("sid", "words", "k", "need", F.greatest(even, after).alias("at"))  # in turn: behind the source's last point
    slots = ranked.unionByName(late).withColumn("cell", F.greatest(F.lit(0), F.floor(F.col("at") / run)))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row for each run of slots
    cells = slots.groupBy("cell").agg(F.count("*").alias("n")).select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("at", "sid", "k")) - 1
    slots = slots.withColumn("place", place).join(cells, "cell")
    return slots.select((F.col("before") + F.col("place")).alias("slot"), "sid", "k", F.least(F.lit(block), F.col("words") - F.col("k") * block).alias("words"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (3.0, 1.0, 2.0), total_ratio: float = 1.5, repeat: float = 2.0, block: int = 128) -> tuple[DataFrame, DataFrame]:
    """(documents, schedule) of the mix.

    documents: doc_id, size, source_size, target, taken, sid, begins, words (that its source takes). schedule: slot, sid, k,
    words; the k-th block begins at word k * block of the source's stream, in which a document begins at its `begins`, and again
    one source_size later. taken is what the blocks of the schedule cover.
    """
    if repeat > 2:
        raise ValueError("the schedule goes through a source at most twice")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = cut(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("size"), key.alias("shuffle")))
    sized = sized.withColumn("row_id", F.monotonically_increasing_id())
    sources = cut(source_targets(sized, weights, total_ratio, repeat))
    words = F.least(F.round("target"), F.floor(F.lit(float(repeat)) * F.col("source_size"))).cast("long")
    sources = sources.withColumn("words", words)
    n_sources, n_slots = sources.agg(F.count("*"), F.coalesce(F.sum(F.ceil(F.col("words") / block)), F.lit(0))).first()
    slots = cut(schedule(sources, n_sources, n_slots, block))
    covered = slots.groupBy("sid").agg(F.sum("words").alias("words"))
    docs = placed(sized, sources.drop("words").join(covered, "sid", "left").withColumn("words", F.coalesce("words", F.lit(0))), n_sources)
    rounds = F.when(F.col("size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0)
    rest = F.col("words") - rounds * F.col("source_size") - F.col("begins")
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    docs = docs.withColumn("taken", taken.cast("long"))
    return docs.select("doc_id", "size", "source_size", "target", "taken", "sid", "begins", "words"), slots


def occurrences(documents: DataFrame, slots: DataFrame, *, block: int = 128) -> DataFrame:
    """doc_id, slot, part: each time that a document enters the mix, the slot in which it begins, and how many of its words are taken."""
    each = documents.filter("taken > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.floor((F.col("words") - F.col("begins") - 1) / F.col("source_size")))))
    each = each.withColumn("first", F.col("round") * F.col("source_size") + F.col("begins"))
    each = each.select("doc_id", "sid", F.floor(F.col("first") / block).alias("k"), F.least(F.col("size"), F.col("words") - F.col("first")).alias("part"))
    return each.join(slots.select("slot", "sid", "k"), ["sid", "k"]).select("doc_id", "slot", "part")


def op7(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken for all documents, at 150 % of the corpus."""
    from .common import table

    return mix(table(spark, sf_dir, "documents"))[0].select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS shuffle,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap FROM per
), filled AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () - sum(cap) OVER f + cap AS left_total, sum(w) OVER () - sum(w) OVER f + w AS left_w FROM weighed
  WINDOW f AS (ORDER BY cap / w, sid ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT arg_min(left_total / left_w, cap / w) FILTER (WHERE NOT left_total >= cap / w * left_w) AS each FROM filled
), targets AS (
  SELECT source, sid, source_size, CASE WHEN left_total >= cap / w * left_w THEN cap ELSE each * w END AS target FROM filled, level
), whole AS (
  SELECT *, CAST(least(round(target), 2 * source_size) AS BIGINT) AS words FROM targets
), placed AS (
  SELECT doc_id, size, t.source_size, t.target, t.words, CAST(sum(size) OVER (PARTITION BY t.sid ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS begins
  FROM sized s JOIN whole t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE words // source_size * size + greatest(0, least(size, words % source_size - begins)) END AS taken FROM placed
"""
