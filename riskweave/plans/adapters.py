"""Entity roles on the driver's TPC-H-like tables.

The original application works on school tables (students, enrolments,
attendance, grades, engagement, interventions).  The driver's tables hold
none of those, so each role is a projection of them.

================  ==========================================================
role              definition
================  ==========================================================
entity            customer: id, name, nation key, balance, segment
area dimension    nation ⨝ region: area = nation name, region = region name
status            per customer over *all* orders: lapsed when the last order
                  is before the cut-off; reason = priority of the last order
order facts       per order: lines, returned lines, quantity sum, lines with
                  quantity < 30 (0 for no lines)
activity          order facts: offered = lines, missed = returned lines
marks             order facts with ≥1 line: mark = quantity / 5
engagement        events per user: views, purchases, clicks
actions           urgent orders (one row each)
lines by part     lines: part key, 1, returned
================  ==========================================================

Roles take all rows.  Only where a label is predicted (profile, scores,
model) the order facts, marks and actions stop at the cut-off date, so that
no feature comes from the time its label is taken from; elsewhere ``before``
is left out.

Scale notes.  ``order_facts`` reduces lineitem to one row per order *before*
it meets orders (partial aggregation map-side, then a shuffle of one row per
order); the join with orders is then 1:1 and the per-customer rollups see
one row per order.  With ``all_orders=True`` the same pass also carries what
the status needs, so the profile reads orders and lineitem once each
(``flows.entity_orders``).  Joins carry no hints: the planner broadcasts by
measured size and AQE re-plans at run time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.io import read_table

# Fixed values of the adapted roles.
CUTOFF = "2000-08-01 00:00:00"          # facts are taken strictly before this instant
LAPSED, ACTIVE = "lapsed", "active"     # status values; LAPSED is the positive label
URGENT_PRIORITY = "1-URGENT"            # an "action" is an urgent order
RETURNED_FLAG = "R"                     # a "missed" line is a returned line
LOW_QUANTITY = 30                       # quantity < 30 ⇔ mark < 6
MARK_DIVISOR = 5.0                      # mark = quantity / 5 (0.2 .. 10)


def cutoff_col():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def _before(df: DataFrame, column: str, before: str | None) -> DataFrame:
    """Rows strictly before an instant; all rows where none is given."""
    return df if before is None else df.where(F.col(column) < F.lit(before).cast("timestamp_ntz"))


@dataclass
class Tables:
    """Driver tables of one scale-factor directory, each read at its first use
    and only then; one object serves one query."""
    spark: SparkSession
    root: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = read_table(self.spark, self.root, name)
        setattr(self, name, table)
        return table


def tables(spark: SparkSession, root: str) -> Tables:
    return Tables(spark, root)


# ------------------------------------------------------------------ roles
def entity(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"))


def area_dim(t: Tables) -> DataFrame:
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "inner")
           .select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("area"),
                   F.col("r_name").alias("region")))


def status_columns(last: str = "_last", last_priority: str = "_last_priority") -> list:
    """status / last_order_date / reason from the last order date and priority."""
    lapsed = F.col(last) < cutoff_col()
    return [F.when(lapsed, F.lit(LAPSED)).otherwise(F.lit(ACTIVE)).alias("status"),
            F.date_format(last, "yyyy-MM-dd").alias("last_order_date"),
            F.when(lapsed, F.col(last_priority)).alias("reason")]


def last_order_aggs(date: str, key: str, priority: str) -> list:
    """Latest order date, and the priority of the latest order (ties → higher key).

    ``max_by`` keeps a string (the priority) in its aggregation buffer, so
    Spark plans the aggregate sort-based; it still aggregates partially
    map-side (one row per customer per task) and spills rather than fails
    when a task's keys do not fit in memory.
    """
    return [F.max(date).alias("_last"),
            F.max_by(priority, F.struct(date, key)).alias("_last_priority")]


def status(t: Tables) -> DataFrame:
    """One row per customer with orders: status, last order date, reason."""
    per = t.orders.groupBy(F.col("o_custkey").alias("entity_id")).agg(
        *last_order_aggs("o_orderdate", "o_orderkey", "o_orderpriority"))
    return per.select("entity_id", *status_columns())


def line_facts(t: Tables) -> DataFrame:
    """lineitem reduced to one row per order (partial aggregation map-side)."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("l_returnflag") == RETURNED_FLAG, 1).otherwise(0)).cast("long")
        .alias("n_returned"),
        F.sum("l_quantity").alias("qty_sum"),
        F.sum(F.when(F.col("l_quantity") < LOW_QUANTITY, 1).otherwise(0)).cast("long")
        .alias("n_low"))


def order_facts(t: Tables, all_orders: bool = False, before: str | None = None) -> DataFrame:
    """Per order: urgent flag, line counts, quantity sums (0 if no lines).

    All orders, or those ``before`` an instant (the filter reaches the
    scan).  ``all_orders=True`` keeps every order and adds ``early`` (before
    the cut-off), ``order_date`` and ``priority``, so one pass over orders
    can feed both the status (all orders) and the facts (early orders).
    """
    orders = _before(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
                     "o_orderdate", before)
    lines = line_facts(t)
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    cols = [F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("entity_id"),
            F.when(F.col("o_orderpriority") == URGENT_PRIORITY, 1).otherwise(0).alias("urgent"),
            F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
            F.coalesce("n_returned", F.lit(0)).alias("n_returned"),
            F.coalesce("qty_sum", F.lit(0.0)).alias("qty_sum"),
            F.coalesce("n_low", F.lit(0)).alias("n_low")]
    if all_orders:
        cols += [(F.col("o_orderdate") < cutoff_col()).alias("early"),
                 F.col("o_orderdate").alias("order_date"),
                 F.col("o_orderpriority").alias("priority")]
    return joined.select(*cols)


def activity(t: Tables, facts: DataFrame | None = None, before: str | None = None) -> DataFrame:
    f = facts if facts is not None else order_facts(t, before=before)
    return f.select("entity_id", F.col("n_lines").alias("offered"),
                    F.col("n_returned").alias("missed"))


def marks(t: Tables, facts: DataFrame | None = None, before: str | None = None) -> DataFrame:
    """Orders with lines: quantity sum, line count, low marks (mark = quantity / 5).

    Marks are kept as integer-valued quantity sums so that rollups add exact
    numbers; the division by ``MARK_DIVISOR`` happens once, per entity.
    """
    f = facts if facts is not None else order_facts(t, before=before)
    return f.where(F.col("n_lines") > 0).select(
        "entity_id", "qty_sum", F.col("n_lines").alias("mark_count"),
        F.col("n_low").alias("low_marks"))


def engagement(t: Tables) -> DataFrame:
    et = F.col("event_type")
    return t.events.select(
        F.col("user_id").alias("entity_id"),
        F.when(et == "view", 1).otherwise(0).alias("views"),
        F.when(et == "purchase", 1).otherwise(0).alias("purchases"),
        F.when(et == "click", 1).otherwise(0).alias("clicks"))


def actions(t: Tables, before: str | None = None) -> DataFrame:
    o = _before(t.orders.where(F.col("o_orderpriority") == URGENT_PRIORITY), "o_orderdate", before)
    return o.select(F.col("o_custkey").alias("entity_id"), F.col("o_orderkey").alias("action_id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("action_date"))


def lines_by_part(t: Tables, before: str | None = None) -> DataFrame:
    """Every line, or those of orders ``before`` an instant (semi join)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag")
    if before is not None:
        early = _before(t.orders, "o_orderdate", before)
        li = li.join(early.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    return li.select("l_partkey", F.lit(1).alias("offered"),
                     F.when(F.col("l_returnflag") == RETURNED_FLAG, 1).otherwise(0).alias("missed"))


def part_dim(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("part_key"), F.col("p_type").alias("part_type"),
                         F.col("p_name").alias("part_name"))

