"""Text functions as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def normalised(text: Column) -> Column:
    """Lower case; everything but a-z, 0-9 and $ becomes one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9$]+", " "))


def entity(name: Column) -> Column:
    """Company name in lower case, without punctuation, legal forms and words for owners."""
    s = F.regexp_replace(F.lower(name), r"[^a-z0-9 ]", " ")
    s = F.regexp_replace(s, rf"\b(?:{'|'.join(rules.ENTITY_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def money(text: Column) -> Column:
    """All whole-dollar amounts, in order; '$22, 500' counts as 22500 and cents are dropped."""
    return F.transform(F.regexp_extract_all(text, F.lit(rules.MONEY), F.lit(1)), lambda m: F.regexp_replace(m, r"[,\s]", "").try_cast("long"))


def lead_penalty(text: Column) -> Column:
    """struct(amount, basis) of the opening clause; amount is NULL without one."""
    found = F.regexp_extract(text, rules.LEAD_PENALTY, 0)
    amount = F.regexp_replace(F.regexp_extract(text, rules.LEAD_PENALTY, 1), r"[,\s]", "").try_cast("long")
    basis = F.when(amount.isNull(), "").when(found.rlike(r"(?i)violations?$"), "leading_amount_violations_wording").otherwise("leading_amount")
    return F.struct(amount.alias("amount"), basis.alias("basis"))


def join_lines(lines: Column) -> Column:
    """One paragraph of wrapped lines: a hyphen at a line's end stays, without a space if the next line begins in lower case."""
    kept = F.filter(F.transform(lines, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    glue = lambda acc, x: F.when(acc == "", x).when(F.endswith(acc, F.lit("-")) & x.rlike(r"^\p{Ll}"), F.concat(acc, x)).otherwise(F.concat_ws(" ", acc, x))
    return F.regexp_replace(F.aggregate(kept, F.lit(""), glue), r"\s+", " ")


def written_date(text: Column) -> Column:
    """struct(text, date) of the first 'Month D, YYYY'; an impossible date keeps its text and has a NULL date."""
    pattern = rf"(?i)\b({'|'.join(rules.MONTHS)})\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})\b"
    plain = F.concat_ws(" ", F.initcap(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3))
    return F.struct(F.regexp_extract(text, pattern, 0).alias("text"), F.to_date(F.try_to_timestamp(plain, F.lit("MMMM d yyyy"))).alias("date"))


def detect(text: Column, blanked: Column, wording=rules.WORDING) -> Column:
    """struct(tier, hits): wording tiers; weak wording is sought in `blanked`, the text without addresses and respondent."""
    hits = F.array_compact(F.array(*[F.when((blanked if t == "weak" else text).rlike(p), F.lit(f"{t}:{label}")) for t, label, p in wording]))
    tier = F.coalesce(F.split_part(F.get(hits, F.lit(0)), F.lit(":"), F.lit(1)), F.lit(""))
    return F.struct(tier.alias("tier"), F.transform(hits, lambda h: F.regexp_replace(h, "^[a-z]+:", "")).alias("hits"))


def blank_out(text: Column, parts: Column) -> Column:
    """The text with every occurrence of the given strings read as a space."""
    return F.aggregate(F.filter(parts, lambda p: p != ""), text, lambda acc, p: F.replace(acc, p, F.lit(" ")))


def classify(text: Column, categories=rules.CATEGORIES) -> Column:
    """struct(categories, terms): every category with a hit ('other' if none), and the wordings found for each."""
    found = {
        name: F.array_sort(F.array_distinct(F.filter(F.array(*[F.lower(F.regexp_extract(text, f"(?iu){p}", 0)) for p in patterns]), lambda t: t != "")))
        for name, patterns in categories.items()
    }
    names = F.array_compact(F.array(*[F.when(F.size(t) > 0, F.lit(name)) for name, t in found.items()]))
    terms = F.map_filter(F.create_map(*[x for name, t in found.items() for x in (F.lit(name), t)]), lambda _, t: F.size(t) > 0)
    return F.struct(F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("other"))).alias("categories"), terms.alias("terms"))


def digits(s: Column) -> Column:
    """Sorted multiset of the numbers in a string, as text."""
    return F.array_join(F.array_sort(F.regexp_extract_all(s, F.lit(r"(\d+)"), F.lit(1))), ",")


def compass(s: Column) -> Column:
    """Sorted multiset of the compass words in a string, as text."""
    return F.array_join(F.array_sort(F.filter(F.split(s, " "), lambda t: t.isin("EAST", "WEST", "NORTH", "SOUTH"))), ",")


def indel_ratio(a: Column, b: Column) -> Column:
    """200 * longest common subsequence / total length, by dynamic programming over arrays; for short strings."""
    ys = F.split(b, "")
    zero = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))

    def row(last: Column, x: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            same = F.get(ys, j - 1) == x
            best = F.when(same, F.get(last, j - 1) + 1).otherwise(F.greatest(F.get(last, j), F.element_at(acc, -1)))
            return F.concat(acc, F.array(best))

        return F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), cell)

    lcs = F.element_at(F.aggregate(F.split(a, ""), zero, row), -1)
    return F.when((F.length(a) > 0) & (F.length(b) > 0), F.lit(200.0) * lcs / (F.length(a) + F.length(b))).otherwise(F.lit(0.0))


def indel_at_least(a: Column, b: Column, floor: float) -> Column:
    """indel_ratio where it reaches `floor`, else NULL: only diagonals that can hold such a pair are computed.

    With a ratio of `floor` at most (1 - floor / 100) of all characters are left out, so the longest common subsequence stays
    within that many diagonals. A row holds its values there, from the left diagonal to the right one; -1 lies outside.
    """
    m, n = F.length(a), F.length(b)
    band = F.floor((m + n) * F.lit(round(1 - floor / 100, 10)) + F.lit(1e-9)).cast("int")
    xs, ys = F.split(a, ""), F.split(b, "")
    offsets = F.sequence(F.lit(0), 2 * band)
    begin = F.transform(offsets, lambda k: F.when((k >= band) & (k - band <= n), 0).otherwise(-1))

    def row(last: Column, i: Column) -> Column:
        def cell(done: Column, k: Column) -> Column:
            j = i - band + k
            same = F.get(last, k) + 1
            best = F.greatest(F.coalesce(F.get(last, k + 1), F.lit(-1)), F.coalesce(F.get(done, F.size(done) - 1), F.lit(-1)))
            value = F.when((j < 0) | (j > n), -1).when(j == 0, 0).when(F.get(xs, i - 1) == F.get(ys, j - 1), same).otherwise(best)
            return F.concat(done, F.array(value))

        return F.aggregate(offsets, F.array().cast("array<int>"), cell)

    lcs = F.get(F.aggregate(F.sequence(F.lit(1), m), begin, row), n - m + band)
    ratio = F.lit(200.0) * lcs / (m + n)
    return F.when((m > 0) & (n > 0) & (F.abs(m - n) <= band), F.when(ratio >= floor, ratio))
