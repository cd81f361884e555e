"""Tiered counts, rates, crosstabs, exact tests and per-site summaries over linked actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, stats, text

CONFIRMED = ("auto_confirmed", "reviewed_confirmed")
EVIDENCE_NOTE = "bulletins show some of what is enforced; no action here is no proof that a site complies"


def tier() -> Column:
    """A confirmed text and property; B text awaiting review; C property only; NULL else. Rejected actions have no tier but A's."""
    both, rejected = F.col("pops_relation") == "pops_text_and_property_match", F.col("review_status") == "reviewed_rejected"
    confirmed = F.col("review_status").isin(*CONFIRMED)
    return (
        F.when(both & confirmed, "A").when(~rejected & (both | (F.col("pops_relation") == "pops_text_only")), "B")
        .when(~rejected & (F.col("pops_relation") == "property_match_only"), "C")
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half to even; NULL where whole is 0."""
    return F.bround(100.0 * part / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def tier_totals(actions: DataFrame) -> DataFrame:
    """Per tier: actions, distinct sites, penalty count, sum, median and maximum."""
    return actions.filter("tier is not null").groupBy("tier").agg(
        F.count("*").alias("actions"), F.countDistinct(F.nullif("pops_id", F.lit(""))).alias("sites"), F.count("penalty").alias("with_penalty"),
        F.coalesce(F.sum("penalty"), F.lit(0)).alias("penalties"), F.median("penalty").alias("median_penalty"), F.max("penalty").alias("max_penalty"),
    )


def repeats(actions: DataFrame, sites: DataFrame, least: int = 2) -> DataFrame:
    """Sites with several tiered actions, counts per tier, first and last month, penalties, and the sites' attributes."""
    per = actions.filter("tier is not null and pops_id <> ''").groupBy("pops_id").agg(
        F.count("*").alias("total_actions"), *[F.count_if(F.col("tier") == t).alias(f"tier{t}") for t in "ABC"],
        F.min("ym").alias("first"), F.max("ym").alias("last"), F.coalesce(F.sum("penalty"), F.lit(0)).alias("penalties"),
    )
    return per.filter(F.col("total_actions") >= least).join(sites, "pops_id").orderBy(F.desc("tierA"), F.desc("total_actions"), "pops_id")


def repeat_entities(actions: DataFrame, least: int = 2) -> DataFrame:
    """Respondents of tier A actions by normalised name, with `least` actions or more (1: all), the busiest first."""
    df = actions.filter("tier = 'A'").withColumn("entity", text.entity(F.col("respondent"))).filter("entity <> ''")
    per = df.groupBy("entity").agg(
        F.count("*").alias("actions"), F.min_by("respondent", "seq").alias("example_name"),
        F.array_join(F.array_sort(F.collect_set(F.nullif("pops_id", F.lit("")))), ";").alias("sites"), F.coalesce(F.sum("penalty"), F.lit(0)).alias("penalties"),
    )
    return per.filter(F.col("actions") >= least).orderBy(F.desc("actions"), "entity")


def category_share(actions: DataFrame) -> DataFrame:
    """Actions per category and their share of all actions, a fraction of three digits; an action counts in each of its categories."""
    total = actions.agg(F.count("*").alias("total"))
    per = actions.select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("actions"))
    return per.crossJoin(F.broadcast(total)).select("category", "actions", F.bround(F.col("actions") / F.col("total"), 3).alias("share"))  # total is one row


def accountability(sites: DataFrame, actions: DataFrame, audit: DataFrame, since: str = "2017-04") -> DataFrame:
    """One row per site, with its own columns: counts by kind; penalties, last month and its precision, and ids of the confirmed actions; the first audit row.

    audit: audit_row, pops_id, outcome and, if there are any, findings and confidence.
    """
    base = actions.filter("pops_id <> '' and review_status <> 'reviewed_rejected'")
    confirmed = F.col("review_status").isin(*CONFIRMED) & (F.col("pops_relation") == "pops_text_and_property_match")
    per = base.groupBy("pops_id").agg(
        F.count_if(confirmed).alias("confirmed"), F.count_if(confirmed & (F.col("ym") >= since)).alias("confirmed_recent"),
        F.count_if(F.col("pops_relation") == "property_match_only").alias("property_only"), F.count_if(F.col("review_status") == "needs_review").alias("needs_review"),
        F.count("*").alias("any"), F.coalesce(F.sum(F.when(confirmed, F.col("penalty"))), F.lit(0)).alias("penalties"), F.max(F.when(confirmed, F.col("ym"))).alias("last"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(confirmed, F.struct("seq", "enforcement_id")))), lambda x: x["enforcement_id"]), ";").alias("enforcement_ids"),
    )
    told = {"outcome": "audit_outcome", "findings": "audit_findings", "confidence": "audit_confidence"}
    told = {c: to for c, to in told.items() if c in audit.columns}
    first = audit.filter("pops_id <> ''").groupBy("pops_id").agg(F.min_by(F.struct(*told), "audit_row").alias("x"), F.min("audit_row").cast("string").alias("audit_row"))
    first = first.select("pops_id", "audit_row", *[F.col(f"x.{c}").alias(to) for c, to in told.items()])
    out = sites.join(per, "pops_id", "left").join(first, "pops_id", "left").withColumn("in_audit", F.col("audit_row").isNotNull())
    counts = ["confirmed", "confirmed_recent", "property_only", "needs_review", "any", "penalties"]
    out = out.fillna(0, counts).fillna("", ["last", "enforcement_ids", "audit_row", *told.values()])
    return out.withColumns({"last_precision": F.when(F.col("last") != "", "bulletin_month").otherwise(""), "evidence_note": F.lit(EVIDENCE_NOTE)})


def fisher(table: DataFrame, group: Column, hit: Column) -> DataFrame:
    """One row: the 2x2 table of two boolean columns and its exact two-sided p."""
    cells = table.agg(
        F.count_if(group & hit).alias("a"), F.count_if(group & ~hit).alias("b"), F.count_if(~group & hit).alias("c"), F.count_if(~group & ~hit).alias("d")
    )
    return cells.withColumn("p", stats.fisher_exact(*[F.col(c) for c in "abcd"]))


def era_crosstab(actions: DataFrame, eras: dict[str, tuple[int, int]]) -> DataFrame:
    """Category by era, zero-filled; eras are half-open to the left, (low, high], and years outside drop out."""
    era = F.coalesce(*[F.when((F.col("year") > lo) & (F.col("year") <= hi), F.lit(name)) for name, (lo, hi) in eras.items()])
    df = actions.withColumn("era", era).filter("era is not null").select("era", F.explode("categories").alias("category"))
    return df.groupBy("category").pivot("era", list(eras)).count().fillna(0)


def decade(year: Column) -> Column:
    """Age group of a year of completion; 'unknown' for what is no year or lies outside."""
    n = year.try_cast("int")
    return F.coalesce(*[F.when(n.between(low, high), F.lit(name)) for low, high, name in rules.DECADES], F.lit("unknown"))


def last_wording(actions: DataFrame, bulletins: DataFrame) -> DataFrame:
    """One row: the last month with strong or moderate wording, and the number of bulletins after it."""
    last = actions.filter(F.col("pops_keyword_tier").isin("strong", "moderate")).agg(F.max("ym").alias("last_wording"))
    both = bulletins.select("bulletin_id").crossJoin(last)  # last is one row
    return both.agg(F.max("last_wording").alias("last_wording"), F.count_if(F.col("bulletin_id") > F.col("last_wording")).alias("bulletins_after"))


def summary(actions: DataFrame) -> DataFrame:
    """One row of headline figures: actions, sites and penalties by tier, sites of A or B and of any tier, duplicates in tier A."""
    a = F.col("tier") == "A"
    site = F.nullif("pops_id", F.lit(""))
    per = [
        x
        for t in "ABC"
        for x in (
            F.count_if(F.col("tier") == t).alias(f"tier_{t}_actions"), F.countDistinct(F.when(F.col("tier") == t, site)).alias(f"tier_{t}_sites"),
            F.coalesce(F.sum(F.when(F.col("tier") == t, F.col("penalty"))), F.lit(0)).alias(f"tier_{t}_penalty_total"), F.count(F.when(F.col("tier") == t, F.col("penalty"))).alias(f"tier_{t}_penalty_n"),
        )
    ]
    return actions.agg(
        F.count("*").alias("actions"), *per, F.countDistinct(F.when(F.col("tier").isin("A", "B"), site)).alias("tier_AB_sites"),
        F.countDistinct(F.when(F.col("tier").isNotNull(), site)).alias("tier_ABC_sites"), F.median(F.when(a, F.col("penalty"))).alias("tier_A_penalty_median"),
        F.max(F.when(a, F.col("penalty"))).alias("tier_A_penalty_max"), F.count_if(a & (F.col("duplicate_of") != "")).alias("tier_A_duplicates"),
        F.coalesce(F.sum("penalty"), F.lit(0)).alias("penalty_total"),
    )


def by_year(actions: DataFrame, bulletins: DataFrame) -> DataFrame:
    """year, bulletins, all entries, actions by tier and tier A for 100 entries; bulletins(bulletin_id), actions(year, tier)."""
    months = bulletins.groupBy(F.substring("bulletin_id", 1, 4).try_cast("int").alias("year")).agg(F.count("*").alias("bulletins"))
    per = actions.groupBy("year").agg(F.count("*").alias("all_entries"), *[F.count_if(F.col("tier") == t).alias(f"tier{t}_actions") for t in "ABC"])
    names = ["bulletins", "all_entries", *[f"tier{t}_actions" for t in "ABC"]]
    df = months.join(per, "year", "full_outer").fillna(0, names).select("year", *names)
    return df.withColumn("tierA_per_100_entries", percent(F.col("tierA_actions"), F.col("all_entries"), 2)).orderBy("year")


def by_borough(actions: DataFrame, sites: DataFrame) -> DataFrame:
    """borough, sites there, their tier A actions, the sites that have some, and their share in percent."""
    own = actions.filter("tier = 'A' and pops_id <> ''").join(sites.select("pops_id", "borough"), "pops_id")
    per = own.groupBy("borough").agg(F.count("*").alias("tierA_actions"), F.countDistinct("pops_id").alias("tierA_sites"))
    df = sites.groupBy("borough").agg(F.count("*").alias("sites")).join(per, "borough", "left").fillna(0, ["tierA_actions", "tierA_sites"])
    return df.withColumn("with_tierA_pct", percent(F.col("tierA_sites"), F.col("sites"))).orderBy("borough")


def by_decade(accounts: DataFrame) -> DataFrame:
    """decade of completion, sites, those with a confirmed action, their share; accounts(year_established, confirmed)."""
    df = accounts.withColumns({"decade": decade(F.col("year_established")), "has": F.col("confirmed") > 0})
    per = df.groupBy("decade").agg(F.count("*").alias("sites"), F.count_if("has").alias("with_tierA"))
    return per.withColumn("pct", percent(F.col("with_tierA"), F.col("sites"))).orderBy("decade")


def followed_up(accounts: DataFrame, actions: DataFrame) -> DataFrame:
    """accounts with audit_group (the printed outcome, or not_in_audit) and whether the site has actions of tier A, of A or B, of any tier."""
    own = actions.filter("tier is not null and pops_id <> ''").groupBy("pops_id").agg(F.max((F.col("tier") != "C").cast("int")).alias("ab"), F.lit(1).alias("linked"))
    df = accounts.join(own, "pops_id", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    outcome = F.lower(F.coalesce(F.nullif("audit_outcome", F.lit("")), F.lit("not_in_audit")))
    return df.withColumns({"audit_group": outcome, "has_a": F.col("confirmed") > 0, "has_ab": has("ab"), "has_any": has("linked")}).drop("ab", "linked")


def by_audit(followed: DataFrame) -> DataFrame:
    """audit_group, sites, and how many of them, and what share, have actions of tier A, of A or B, of any tier."""
    kinds = {"tierA": "has_a", "tierAB": "has_ab", "any_linked": "has_any"}
    per = followed.groupBy("audit_group").agg(F.count("*").alias("sites"), *[F.count_if(c).alias(k) for k, c in kinds.items()])
    return per.withColumns({f"{k}_pct": percent(F.col(k), F.col("sites")) for k in kinds}).orderBy("audit_group")


ERAS = {"2018-19": (2017, 2019), "2020-21": (2019, 2021), "2022-24": (2021, 2100)}  # fixed values: years after the first, up to the second


def tables(actions: DataFrame, sites: DataFrame, accounts: DataFrame, bulletins: DataFrame) -> dict[str, DataFrame]:
    """All tables of the analysis by name, q4 to q11, as `readers.write_tables` takes them.

    actions: tier, pops_id, ym, year, penalty, seq, enforcement_id, respondent, categories (array). sites: pops_id, borough and
    attributes. accounts: what `accountability` gives over sites with year_established. bulletins: bulletin_id.
    """
    confirmed = actions.filter("tier = 'A'")
    return {
        "q4_repeat_sites": repeats(actions, sites), "q5_entities": repeat_entities(actions, 1), "q6_categories": category_share(confirmed), "q7_by_year": by_year(actions, bulletins),
        "q8_borough": by_borough(actions, sites), "q9_age": by_decade(accounts), "q10_audit_followup": by_audit(followed_up(accounts, actions)), "q11_categories_by_era": era_crosstab(confirmed, ERAS),
    }


def full_summary(actions: DataFrame, accounts: DataFrame, bulletins: DataFrame, audit: DataFrame, issues: DataFrame) -> DataFrame:
    """One row: `summary` and the span of bulletins, repeated sites and respondents, last wording, the exact tests by age and by audit outcome, audit and review counts.

    Arguments as in `tables`; actions have duplicate_of and pops_keyword_tier, too; audit: pops_id, outcome; issues: status.
    """
    known = accounts.withColumn("decade", decade(F.col("year_established"))).filter("decade <> 'unknown'")
    old, has = F.col("decade").isin("1961-69", "1970s"), F.col("confirmed") > 0
    age = fisher(known, old, has).select(F.col("a").alias("q9_old_with_a"), (F.col("a") + F.col("b")).alias("q9_old"), F.col("c").alias("q9_new_with_a"), (F.col("c") + F.col("d")).alias("q9_new"), F.col("p").alias("q9_fisher_p"))
    followed = followed_up(accounts, actions).filter("audit_group in ('no', 'yes')")
    no = F.col("audit_group") == "no"
    outcome = fisher(followed, no, F.col("has_a")).select((F.col("a") + F.col("b")).alias("q10_no"), F.col("a").alias("q10_no_a"), (F.col("c") + F.col("d")).alias("q10_yes"), F.col("c").alias("q10_yes_a"), F.col("p").alias("q10_fisher_p"))
    more = followed.agg(F.count_if(no & F.col("has_ab")).alias("q10_no_ab"))
    span = bulletins.agg(F.count("*").alias("bulletins"), F.concat(F.min("bulletin_id"), F.lit(" to "), F.max("bulletin_id")).alias("span"))
    sites = actions.filter("tier is not null and pops_id <> ''").groupBy("pops_id").count().agg(F.count_if(F.col("count") >= 2).alias("repeat_sites"))
    names = repeat_entities(actions, 1).agg(F.count_if(F.col("actions") >= 2).alias("repeat_entities"))
    counted = audit.groupBy("outcome").agg(F.count("*").alias("n"), F.count_if(F.coalesce("pops_id", F.lit("")) == "").alias("free"))
    audited = counted.agg(F.coalesce(F.sum("free"), F.lit(0)).alias("audit_unlinked_rows"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))).alias("audit_status_counts"))
    waiting = issues.agg(F.count_if(F.col("status") == "open").alias("review_open"))
    out = summary(actions)
    for part in (span, sites, names, last_wording(actions, bulletins), age, outcome, more, audited, waiting):
        out = out.crossJoin(part)  # one row each
    return out
