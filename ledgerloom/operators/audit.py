"""Audit appendix: rows from page text, and their link to the site master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address
from ..session import cut
from . import joins

ROW = r"^\s*(\d{1,3})\s+(.+?)\s+(Yes|No|Construction)\s*$"  # fixed value: a line of the appendix


def appendix_rows(pages: DataFrame, title: str = "Appendix", most: int = 400) -> DataFrame:
    """audit_row, address, outcome of pages(page, text); only pages that hold the title or the word Full are read."""
    lines = pages.filter(F.contains("text", F.lit(title)) | F.contains("text", F.lit("Full"))).select("page", F.posexplode(F.split("text", "\n")).alias("line", "s")).filter(F.col("s").rlike(ROW))
    df = lines.select(F.regexp_extract("s", ROW, 1).try_cast("int").alias("audit_row"), F.trim(F.regexp_extract("s", ROW, 2)).alias("address"), F.regexp_extract("s", ROW, 3).alias("outcome"), "page", "line")
    df = df.filter(F.col("audit_row") <= most)
    return df.groupBy("audit_row").agg(F.min_by(F.struct("address", "outcome"), F.struct("page", "line")).alias("x")).select("audit_row", "x.address", "x.outcome")


def segments(raw: Column) -> Column:
    """Parts of an audit address that begin with a number (or 'One'), split at ' - ' and '/'; the whole address if none does."""
    parts = F.filter(F.transform(F.split(raw, r"\s+-\s+|/"), lambda x: F.trim(x)), lambda x: x.rlike(r"^(?:One\s|\d)"))
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.trim(raw)))


_PART = r"^(\d+(?:-\d+)?[A-Za-z]?)\s+(.+)$"


def _numbered(part: Column) -> tuple[Column, Column]:
    """(number, street) of one part; without a number the number is '' and the street is the part."""
    plain = F.regexp_replace(F.trim(part), r"^One\b", "1")
    number = F.regexp_extract(plain, _PART, 1)
    return number, F.when(number != "", F.regexp_extract(plain, _PART, 2)).otherwise(plain)


def link(audit: DataFrame, master: DataFrame) -> DataFrame:
    """audit_row, match_status, method, confidence, pops_id, candidates of every audit row.

    Each part is tried by number and street, then by a range that holds the number, and by street alone where it has no number;
    the last part with a hit gives method and confidence, and all hits are candidates, in the order of parts and sites. Sites of one
    address (range, street) are listed once, and rows meet the list, so no street's rows are paired with all its sites.
    """
    number, street = _numbered(F.col("part"))
    rows = audit.select("audit_row", F.size(segments(F.col("address"))).alias("n"), F.posexplode(segments(F.col("address"))).alias("pos", "part"))
    rows = rows.select("audit_row", "n", "pos", number.alias("number"), address.canonical_street(street).alias("street"))
    tail = F.when(F.col("number").rlike(r"-\d{2}$"), "Queens").otherwise("")
    rows = cut(rows.withColumn("hn", address.house_number(F.nullif("number", F.lit("")), tail)).select("audit_row", "n", "pos", "street", F.col("hn.text").alias("num"), F.col("hn.kind").alias("kind"), F.col("hn.low").alias("low"), F.col("hn").isNull().alias("bare")))
    sites = cut(master.filter("address_normalized <> ''").select("pops_id", F.split_part("address_normalized", F.lit(" "), F.lit(1)).alias("num"), F.col("street_canonical").alias("street"), "hn_low", "hn_high"))

    def listed(asked: DataFrame, keys: list[str], level: int) -> DataFrame:
        """The asked rows with the sites of equal keys."""
        own = sites.join(asked.select(*keys).distinct().hint("merge"), keys, "left_semi").groupBy(*keys).agg(F.array_sort(F.collect_list("pops_id")).alias("own"))
        return asked.join(own.hint("merge"), keys).select("audit_row", "n", "pos", F.lit(level).alias("best"), "own")

    held = sites.select("street", "num").distinct().hint("merge")
    spans = rows.filter("kind <> 'range' and low is not null").join(held, ["street", "num"], "left_anti")
    points = spans.select("street", "low", F.col("low").alias("high")).distinct()
    inside = cut(joins.overlapping(points, sites.select("street", "hn_low", "hn_high").distinct(), ["street"], ("low", "high"), ("hn_low", "hn_high")).drop("high"))
    ranges = spans.join(inside.hint("merge"), ["street", "low"])
    hits = listed(rows, ["street", "num"], 1).unionByName(listed(ranges, ["street", "hn_low", "hn_high"], 2)).unionByName(listed(rows.filter("bare"), ["street"], 3))
    hits = hits.groupBy("audit_row", "pos").agg(F.array_sort(F.flatten(F.collect_list("own"))).alias("own"), F.first(F.struct("best", "n")).alias("lead"))
    order = F.array_sort(F.collect_list(F.struct("pos", "own")))
    out = hits.groupBy("audit_row").agg(F.array_distinct(F.flatten(F.transform(order, lambda x: x["own"]))).alias("ids"), F.max_by("lead", "pos").alias("lead"))
    out = audit.select("audit_row").join(out.hint("merge"), "audit_row", "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    best = F.when(F.size("ids") > 0, F.col("lead.best"))
    method = F.when(best == 1, "address_exact").when(best == 2, "address_range").when(best == 3, "street_only").otherwise("none")
    conf = F.when(F.size("ids") != 1, "none").when((F.col("lead.best") == 1) & (F.col("lead.n") == 1), "high").when(F.col("lead.best") < 3, "medium").otherwise("low")
    status = F.when(F.size("ids") == 1, "matched").when(F.size("ids") > 1, "ambiguous").otherwise("no_match")
    return out.select(
        "audit_row", status.alias("match_status"), method.alias("method"), conf.alias("confidence"), F.when(F.size("ids") == 1, F.get("ids", F.lit(0))).otherwise("").alias("pops_id"),
        F.array_join("ids", ";").alias("candidates"),
    )


def findings(pages: DataFrame, audit: DataFrame, *, title: str = "Appendix", most: int = 3, before: int = 160, after: int = 260) -> DataFrame:
    """audit_row, findings: the first `most` mentions of an audit address in the report's body (the pages before the appendix), in order of page and place.

    Each mention is shown with the `before` characters before and the `after` characters after it, however near the next one is.

    pages(page, text), audit(audit_row, address). The join is on the number and the first word of the street; the passage is then
    held against the address, in which Street may be written St or St.
    """
    body = pages.join(pages.filter(F.contains("text", F.lit(title))).agg(F.min("page").alias("until")), F.lit(True))  # one row
    flat = body.filter(F.col("until").isNull() | (F.col("page") < F.col("until"))).select("page", F.regexp_replace("text", r"\s+", " ").alias("flat"))
    low = F.lower("flat")
    named = lambda number: F.zip_with(*[F.regexp_extract_all(low, F.lit(rf"\b({number})(?=\s+([a-z0-9]+))"), F.lit(k)) for k in (1, 2)], lambda a, b: F.concat_ws(" ", a, b))
    spots = flat.select("page", "flat", F.explode(F.array_distinct(F.concat(named(r"\d+[a-z]?"), named(r"\d+-\d+[a-z]?")))).alias("spot"))
    number, street = _numbered(F.col("address"))
    asked = audit.select("audit_row", number.alias("number"), street.alias("street")).filter((F.col("number") != "") & (F.length("street") >= 5))
    asked = asked.withColumn("spot", F.lower(F.concat_ws(" ", "number", F.regexp_extract("street", "^([A-Za-z0-9]+)", 1))))
    quoted = lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))
    pattern = F.concat(F.lit(r"(?i)\b"), quoted(F.col("number")), F.lit(r"\s+"), F.replace(quoted(F.col("street")), F.lit("Street"), F.lit(r"\E(?:Street|St\.?)\Q")))
    both = asked.join(spots, "spot").withColumn("pattern", pattern)
    # where a text is cut at the pattern, the lengths of the pieces give the places
    both = both.withColumns({"hits": F.expr("regexp_extract_all(flat, pattern, 0)"), "between": F.expr("split(flat, pattern, -1)")}).filter(F.size("hits") > 0)
    place = lambda acc, k: F.concat(acc, F.array(F.coalesce(F.get(acc, k - 1) + F.length(F.get("hits", k - 1)), F.lit(0)) + F.length(F.get("between", k))))
    starts = F.aggregate(F.sequence(F.lit(0), F.size("hits") - 1), F.array().cast("array<int>"), place)
    spans = both.select("audit_row", "page", "flat", F.explode(F.arrays_zip(starts.alias("start"), F.transform("hits", lambda h: F.length(h)).alias("size"))).alias("at"))
    first = F.greatest(F.col("at.start") - before, F.lit(0))
    said = F.regexp_replace(F.substring(F.col("flat"), first + 1, F.col("at.start") + F.col("at.size") + after - first), r"^\s+|\s+$", "")
    around = spans.select("audit_row", "page", F.col("at.start").alias("start"), said.alias("said")).distinct()
    kept = F.slice(F.array_sort(F.collect_list(F.struct("page", "start", "said"))), 1, most)
    return around.groupBy("audit_row").agg(F.array_join(F.transform(kept, lambda x: F.concat(F.lit("[p."), x["page"].cast("string"), F.lit("] "), x["said"])), " || ").alias("findings"))
