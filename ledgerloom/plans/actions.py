"""Bindings of the driver's tables to the roles of the engine: orders as actions, customers as sites, and so on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics
from ..session import table

# The same bindings in SQL, for the oracles.
ACTIONS_SQL = """
acts AS (
  SELECT o_orderkey AS enforcement_id, o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS pops_id, strftime(o_orderdate, '%Y-%m') AS ym,
    CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS penalty,
    CASE WHEN o_orderstatus = 'F' THEN 'pops_text_and_property_match' WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 'pops_text_only'
      WHEN o_orderstatus = 'O' THEN 'property_match_only' WHEN o_orderkey % 2 = 0 THEN 'weak_keyword_only' ELSE 'none' END AS pops_relation,
    CASE left(o_orderpriority, 1) WHEN '1' THEN 'auto_confirmed' WHEN '2' THEN 'reviewed_confirmed' WHEN '3' THEN 'needs_review'
      WHEN '4' THEN 'reviewed_rejected' ELSE '' END AS review_status, o_orderpriority AS priority FROM orders
), tiered AS (
  SELECT *, CASE WHEN pops_relation = 'pops_text_and_property_match' AND review_status IN ('auto_confirmed', 'reviewed_confirmed') THEN 'A'
    WHEN review_status <> 'reviewed_rejected' AND pops_relation IN ('pops_text_and_property_match', 'pops_text_only') THEN 'B'
    WHEN review_status <> 'reviewed_rejected' AND pops_relation = 'property_match_only' THEN 'C' END AS tier FROM acts
)"""


def actions(spark: SparkSession, d: str) -> DataFrame:
    """Orders as linked actions with relation, review status, month and penalty."""
    c = F.col
    odd = c("o_orderkey")
    relation = (
        F.when(c("o_orderstatus") == "F", "pops_text_and_property_match").when((c("o_orderstatus") == "O") & (odd % 3 == 0), "pops_text_only")
        .when(c("o_orderstatus") == "O", "property_match_only").when(odd % 2 == 0, "weak_keyword_only").otherwise("none")
    )
    first = F.substring("o_orderpriority", 1, 1)
    status = F.when(first == "1", "auto_confirmed").when(first == "2", "reviewed_confirmed").when(first == "3", "needs_review").when(first == "4", "reviewed_rejected").otherwise("")
    df = table(spark, d, "orders").select(
        odd.alias("enforcement_id"), odd.alias("seq"), c("o_custkey").cast("string").alias("pops_id"), F.date_format("o_orderdate", "yyyy-MM").alias("ym"),
        F.year("o_orderdate").alias("year"), F.when(odd % 7 != 0, F.floor("o_totalprice")).alias("penalty"), relation.alias("pops_relation"),
        status.alias("review_status"), c("o_orderpriority").alias("priority"),
    )
    return df.withColumn("tier", analytics.tier())


def streets(kind: str) -> tuple[str, str, str]:
    """(number, written street, canonical street) of a generated address over an integer column k, as SQL usable in both engines."""
    number = f"CAST({kind} % 900 + 1 AS VARCHAR)"
    n = f"CAST({kind} % 89 + 4 AS VARCHAR)"
    form = f"{kind} % 5"
    written = (
        f"CASE {form} WHEN 0 THEN 'E. ' || {n} || 'th St.' WHEN 1 THEN 'West ' || {n} || ' th Street' WHEN 2 THEN 'Avenue of the Americas' "
        f"WHEN 3 THEN 'Twenty-Third St' ELSE 'Park Ave S' END"
    )
    canonical = (
        f"CASE {form} WHEN 0 THEN 'EAST ' || {n} || ' STREET' WHEN 1 THEN 'WEST ' || {n} || ' STREET' WHEN 2 THEN '6 AVENUE' "
        f"WHEN 3 THEN '23 STREET' ELSE 'PARK AVENUE SOUTH' END"
    )
    return number, written, canonical
