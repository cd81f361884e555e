"""Exact statistics as native columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ln_factorial(n: Column) -> Column:
    """ln(n!): the product's logarithm up to 32, Stirling's series beyond, which is then as good as a double."""
    x = F.greatest(n, F.lit(33)).cast("double")
    series = F.lit(1 / 12) / x - F.lit(1 / 360) / (x * x * x) + F.lit(1 / 1260) / (x * x * x * x * x) - F.lit(1 / 1680) / (x * x * x * x * x * x * x)
    small = F.element_at(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(33)]), F.least(F.greatest(n, F.lit(0)), F.lit(32)).cast("int") + 1)
    return F.when(n <= 32, small).otherwise((x + 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + series)


CHUNK = 1000  # tables whose chances are held at once


def fisher_exact(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided p of the table [[a, b], [c, d]]: the sum of all tables with these margins that are no more likely."""
    fixed = _ln_factorial(a + b) + _ln_factorial(c + d) + _ln_factorial(a + c) + _ln_factorial(b + d) - _ln_factorial(a + b + c + d)
    chance = lambda t, x: F.exp(t["fixed"] - _ln_factorial(x) - _ln_factorial(t["row"] - x) - _ln_factorial(t["column"] - x) - _ln_factorial(t["rest"] + x))
    low, high = F.greatest(F.lit(0), a - d).cast("long"), F.least(a + b, a + c).cast("long")
    table = F.struct(fixed.alias("fixed"), (a + b).alias("row"), (a + c).alias("column"), (d - a).alias("rest"), a.alias("seen"), low.alias("low"), high.alias("high"))

    def whole(t: Column) -> Column:
        limit = chance(t, t["seen"]) * (1 + 1e-7)
        return F.aggregate(F.transform(F.array(limit), lambda most: F.aggregate(F.sequence(t["low"], t["high"], F.lit(CHUNK).cast("long")), F.lit(0.0), lambda acc, x: acc + part(t, x, most))), F.lit(0.0), lambda acc, p: acc + p)

    def part(t: Column, first: Column, most: Column) -> Column:
        own = F.transform(F.sequence(first, F.least(first + (CHUNK - 1), t["high"])), lambda x: chance(t, x))
        return F.aggregate(own, F.lit(0.0), lambda acc, p: acc + F.when(p <= most, p).otherwise(0.0))

    return F.least(F.lit(1.0), F.get(F.transform(F.array(table), whole), F.lit(0)))  # so that what all tables share is computed once
