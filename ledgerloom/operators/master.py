"""Site master: normalised columns, quality flags, timeline, nested documents and the explore filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address
from ..session import numbered


def normalise(raw: DataFrame) -> DataFrame:
    """Padded ids, blank years, placeholder flags, canonical street and address key of raw(pops_id, bbl, bin, year, borough, num, street, building_name).

    A master may be one small file, which one or two tasks read; its rows are dealt to all tasks before numbers and keys are worked out.
    """
    whole = lambda c: F.split_part(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("."), F.lit(1))
    df = raw.repartition("pops_id").withColumns({"bbl": F.when(whole("bbl") != "", F.lpad(whole("bbl"), 10, "0")).otherwise(""), "bin": F.when(whole("bin") != "", F.lpad(whole("bin"), 7, "0")).otherwise("")})
    ways = raw.select(F.col("street").alias("_written")).distinct().withColumn("street_canonical", address.canonical_street(F.col("_written")))  # each way to write a street once
    df = df.join(ways, F.col("street").eqNullSafe(F.col("_written")), "left").drop("_written")
    df = df.withColumns({"year": F.when(whole("year") == "0", "").otherwise(whole("year")), "bin_is_placeholder": F.col("bin").endswith("000000")})
    df, hn = df.withColumn("_hn", address.house_number(F.col("num"), F.col("borough"))), F.col("_hn")  # a column, so that it is worked out once
    df = df.withColumns({"hn_low": hn["low"], "hn_high": hn["high"], "address_key": F.coalesce(address.key_of(F.col("borough"), F.col("num"), F.col("street_canonical")), F.lit("")),
                           "address_normalized": F.when(hn.isNotNull() & (F.col("street_canonical") != ""), F.concat_ws(" ", hn["text"], "street_canonical")).otherwise("")})
    return df.drop("_hn")


def quality_flags(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """flags: the names of the checks (SQL conditions) that hold, joined by ';'."""
    flags = F.array_compact(F.array(*[F.when(F.expr(cond), F.lit(name)) for name, cond in checks.items()]))
    return df.withColumn("flags", F.array_join(flags, ";"))


# What a record of the master may lack, as conditions on the normalised columns and the source's own.
QUALITY_CHECKS = {
    "missing_bbl": "bbl = ''",
    "missing_bin": "bin = ''",
    "bin_placeholder_not_matchable": "bin_is_placeholder",
    "year_completed_is_0_in_source": "trim(year_completed) = '0'",
    "missing_year": "year = '' and trim(year_completed) <> '0'",
    "under_construction": "contains(lower(building_constructed), 'under construction')",
    "address_not_normalizable": "address_key = ''",
    "missing_required_hours": "trim(required_hours) = ''",
    "missing_required_amenities": "trim(required_amenities) = ''",
}


def requirements(master: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Unpivot of the requirement columns; blanks go, text is trimmed."""
    long = master.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(key, columns, "requirement", "value")
    return long.withColumn("value", F.trim("value")).filter("value is not null and value <> ''")


def timeline(*events: DataFrame) -> DataFrame:
    """All events(site, date, kind, detail) in one order."""
    out = events[0]
    for more in events[1:]:
        out = out.unionByName(more)
    return out.orderBy("site", "date", "kind", "detail")


def nested(sites: DataFrame, children: DataFrame, key: str, order: str, columns: list[str], name: str = "e") -> DataFrame:
    """Sites with their children as an ordered array of structs."""
    kids = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias(name))
    empty = F.array().cast(kids.schema[name].dataType)
    return sites.join(kids, key, "left").withColumn(name, F.coalesce(name, empty))


def nested_parts(sites: DataFrame, children: DataFrame, key: str, order: str, columns: list[str], name: str = "e", *, size: int = 1000) -> DataFrame:
    """Sites with their children in numbered parts: part (from 0), parts, and an ordered array of at most `size` structs.

    So a document stays small, however many children a site has; a site without any is one part with an empty array. Children that
    agree in `order` stand in the order of their other columns.
    """
    more = [c for c in columns if c != order]
    rows = numbered(children.select(key, order, *more), key, order, *more)
    own = rows.groupBy(key, F.floor(F.col("number") / size).cast("int").alias("part")).agg(F.array_sort(F.collect_list(F.struct("number", order, *more))).alias(name))
    own = own.withColumn(name, F.transform(name, lambda x: x.dropFields("number")))
    parts = own.groupBy(key).agg((F.max("part") + 1).alias("parts"))
    empty = F.array().cast(own.schema[name].dataType)
    df = sites.join(parts, key, "left").join(own, key, "left")
    return df.withColumns({name: F.coalesce(name, empty), "part": F.coalesce("part", F.lit(0)), "parts": F.coalesce("parts", F.lit(1))})


def explore(df: DataFrame, fields: list[str], *, q: str = "", equals: dict[str, str] | None = None, where: str | None = None, order: list[str] | None = None, limit: int = 150) -> DataFrame:
    """Rows that hold the text in one of the fields and meet the other filters: the first `limit` of them."""
    if q:
        df = df.filter(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(q.lower())))
    for column, value in (equals or {}).items():
        df = df.filter(F.col(column) == value)
    df = df.filter(where) if where else df
    return df.orderBy(*(order or fields)).limit(limit)
