"""A join for ranges that overlap, as a join on equal keys that survives hot ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN, STEP, LEVELS = 64, 16, 8  # width of the finest bins, how much wider each next level is, and the number of levels


def _level(low: Column, high: Column) -> Column:
    """The finest level on which a range touches two bins at most."""
    width = high.cast("double") - low.cast("double")
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(width <= BIN * STEP**k, k).otherwise(level)
    return level


def _bin(value: Column, level: Column) -> Column:
    return F.floor(value / F.element_at(F.array(*[F.lit(float(BIN * STEP**k)) for k in range(LEVELS)]), level + 1)).cast("long")


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_range: tuple[str, str], right_range: tuple[str, str], *, salts: int = 8) -> DataFrame:
    """Pairs of equal keys whose ranges [low, high] share a value; columns of both sides, whose names must differ but for the keys.

    A range lies in the one or two bins that it touches on the level of its width, and meets only what touches the same bin on the
    wider of the two levels; levels on which no two ranges can meet are left out, so each side is read once more, for its widths. A pair
    counts in the first bin that both touch, so it comes once. Left rows of one key and bin are dealt to `salts` tasks and right rows
    repeated as often, so the smaller side should be the right one; the optimiser does not see how often, so it may not broadcast them.
    Ranges without an end, or with the high end below the low one, overlap nothing; widths beyond the widest level only touch more bins.
    """
    c, (low, high), (other_low, other_high) = F.col, left_range, right_range
    bins = lambda a, b: F.explode(F.sequence(_bin(c(a), c("spot.level")), _bin(c(b), c("spot.level"))))
    a = left.filter(c(low) <= c(high)).withColumn("own", _level(c(low), c(high)))
    b = right.filter(c(other_low) <= c(other_high)).withColumn("own", _level(c(other_low), c(other_high)))
    mine, other = ({r["own"] for r in df.select("own").distinct().collect()} for df in (a, b))  # LEVELS numbers at most
    meet = [(k, True) for k in sorted(mine) if other and min(other) <= k] + [(k, False) for k in sorted(other) if mine and min(mine) < k]  # level, whether it is the left one's
    every = F.array(*[F.struct(F.lit(k).alias("level"), F.lit(w).alias("wider")) for k, w in meet]).cast("array<struct<level: int, wider: boolean>>")
    a = a.withColumn("spot", F.explode(F.filter(every, lambda x: (x["wider"] & (x["level"] == c("own"))) | (~x["wider"] & (x["level"] > c("own"))))))
    a = a.withColumn("bin", bins(low, high)).withColumn("salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).drop("own")
    b = b.withColumn("spot", F.explode(F.filter(every, lambda x: (x["wider"] & (x["level"] >= c("own"))) | (~x["wider"] & (x["level"] == c("own"))))))
    b = b.withColumn("bin", bins(other_low, other_high)).withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(salts)]))).drop("own")
    both = a.hint("merge").join(b.hint("merge"), [*keys, "spot", "bin", "salt"])
    meets = (c(low) <= c(other_high)) & (c(high) >= c(other_low))
    first = c("bin") == _bin(F.greatest(c(low), c(other_low)), c("spot.level"))
    return both.filter(meets & first).drop("spot", "bin", "salt")
