"""What the site shows: formatted values, the feed of latest actions, the labelled audit table, and the note below a long list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address, rules

# Labels of the audit groups, in the order in which they are shown.
AUDIT_LABELS = (
    ("no", "Audit: not fully compliant (No)"), ("yes", "Audit: full compliance (Yes)"), ("construction", "Audit: marked “Construction”"), ("not_in_audit", "Not in the audit"),
)


def money(amount: Column) -> Column:
    """'$1,234', or words where there is no amount."""
    return F.when(amount.isNull(), "amount not stated").otherwise(F.concat(F.lit("$"), F.format_number(amount.cast("long"), 0)))


def when(month: Column, year: Column) -> Column:
    """'May 2024'."""
    return F.concat_ws(" ", F.get(F.array(*map(F.lit, rules.MONTHS)), month.cast("int") - 1), year.cast("string"))


def title(text: Column) -> Column:
    """Lower case with a capital at the start and after a space, bracket, slash or hyphen."""
    marks = r"(?<=[\s(/-])"
    return F.array_join(F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), marks), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 20))), "")


def escaped(text: Column) -> Column:
    """The text for HTML."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(mark), F.lit(entity))
    return out


def feed(actions: DataFrame, *, most: int = 8, length: int = 230) -> DataFrame:
    """The latest confirmed actions, by year and month as numbers: when, site, penalty, text (cut with an ellipsis)."""
    last = actions.filter("tier = 'A'").orderBy(F.desc("year"), F.desc("month"), "pops_id", "seq").limit(most)
    said = F.when(F.length("text") > length, F.concat(F.substring("text", 1, length), F.lit("…"))).otherwise(F.col("text"))
    return last.select("seq", when(F.col("month"), F.col("year")).alias("when"), F.col("pops_id").alias("site"), money(F.col("penalty")).alias("penalty"), said.alias("text"))


def audit_table(groups: DataFrame) -> DataFrame:
    """Audit groups that have a label, with it, in the order of the labels."""
    names = [k for k, _ in AUDIT_LABELS]
    labelled = groups.withColumn("label", address.lookup(dict(AUDIT_LABELS), F.col("audit_group"))).filter("label is not null")
    return labelled.orderBy(F.array_position(F.array(*map(F.lit, names)), F.col("audit_group")))


def list_note(found: DataFrame, *, most: int = 150) -> DataFrame:
    """One row: how many rows a filter found, and the note below the first `most` of them."""
    n = F.col("found")
    note = F.when(n > most, f"Showing the first {most}. Narrow the search to see the rest.").when(n == 0, "Nothing matches these filters.").otherwise("")
    return found.agg(F.count("*").alias("found")).withColumn("note", note)
