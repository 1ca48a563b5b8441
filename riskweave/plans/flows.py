"""The standard flows on the adapted driver tables.

profile → rule score → band → scored gold table, and the model variant.
Each function returns a lazy DataFrame; nothing here runs an action except
where a scalar is explicitly needed (model fit / evaluation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import clamp, ratio, ratio_half_up, round_half_up
from riskweave.operators.aggregates import avg_by, count_by, rate_by, sum_by
from riskweave.operators.profile import FlagRule, add_flags, build_profile
from riskweave.operators.risk import band, rule_score
from riskweave.plans import adapters as A

KEY = "entity_id"

PROFILE_COLUMNS = ("entity_id", "nation_key", "name", "balance", "segment", "status",
                   "last_order_date", "reason", "area", "region", "offered_total",
                   "missed_total", "miss_rate", "avg_mark", "low_marks", "views", "purchases",
                   "clicks", "action_count")

# Flag rules of the profile (column, operator, threshold, name).
FLAG_RULES = (
    FlagRule("status", "eq", A.LAPSED, "lapsed_label"),   # label
    FlagRule("balance", "lt", 2200.0, "low_balance"),      # strict less-than
    FlagRule("missed_total", "gt", 8, "high_missed"),      # strict greater-than
    FlagRule("action_count", "eq0", None, "no_actions"),   # equals zero
    FlagRule("purchases", "eq0", None, "no_purchases"),    # equals zero
    FlagRule("low_marks", "double"),                       # int -> double, in place
)

# The additive logistic rule of the original application
# (intercept -3.1; weights 3.0 rate, 1.6 mark deficit, 0.9, 0.8, 0.7, 0.6
# binary risk factors, -0.8 engagement), applied to the adapted features.
RULE_INTERCEPT = -3.1
MARK_PASS = 6.0
ENGAGEMENT_SCALE = (160.0, 210.0)

# Band thresholds for the adapted rule score (its range is lower than the
# original model's probabilities, so the original 0.70 / 0.40 would leave
# the top bands empty).
RULE_THRESHOLDS = (0.30, 0.20)

MODEL_FEATURES = ("miss_rate", "avg_mark", "low_marks", "balance", "low_balance",
                  "high_missed", "no_actions", "action_count")


def engagement_rate():
    v, p = ENGAGEMENT_SCALE
    return clamp((F.col("views") / F.lit(v) + F.col("purchases") / F.lit(p)) / F.lit(2.0), 0.0, 1.0)


def rule_terms():
    deficit = F.greatest(F.lit(0.0), F.lit(MARK_PASS) - F.col("avg_mark")) / F.lit(MARK_PASS)
    return [
        (F.col("miss_rate"), 3.0),
        (deficit, 1.6),
        (F.col("low_balance"), 0.9),
        (F.col("no_purchases"), 0.8),
        (F.col("no_actions"), 0.7),
        (F.col("high_missed"), 0.6),
        (engagement_rate(), -0.8),
    ]


# -------------------------------------------------------------- fact rollups
def entity_rates(t: A.Tables, before: str | None = None) -> DataFrame:
    return rate_by(A.activity(t, before=before), KEY, "missed", "offered", num_total="missed_total",
                   den_total="offered_total", rate="miss_rate")


def entity_marks(t: A.Tables, before: str | None = None) -> DataFrame:
    m = A.marks(t, before=before).withColumn("mark_units", F.col("mark_count") * F.lit(A.MARK_DIVISOR))
    # mean mark = Σ quantity / (5 · lines): integer-valued sums, one division
    return avg_by(m, KEY, sum_col="qty_sum", count_col="mark_units", out="avg_mark", digits=2,
                  extra=[F.sum("low_marks").cast("long").alias("low_marks")])


def entity_engagement(t: A.Tables) -> DataFrame:
    return sum_by(A.engagement(t), KEY, {"views": "views", "purchases": "purchases",
                                          "clicks": "clicks"})


def entity_actions(t: A.Tables, before: str | None = None) -> DataFrame:
    return count_by(A.actions(t, before), KEY, "action_count")


def entity_orders(t: A.Tables) -> DataFrame:
    """Status, rates, marks and action counts of each entity in ONE pass over
    orders (and one over lineitem).

    Equivalent to joining ``status``, ``entity_rates``, ``entity_marks`` and
    ``entity_actions``: the status aggregates run over all orders, the
    activity aggregates only over the orders before the cut-off (conditional
    sums; NULL when an entity has no such order, exactly as a left join to
    the separate rollups would give).  ``has_marks`` is false for an entity
    without early orders that have lines (its mark columns are NULL).
    """
    f = A.order_facts(t, all_orders=True)
    early = F.col("early")
    has = early & (F.col("n_lines") > 0)
    agg = f.groupBy(KEY).agg(
        *A.last_order_aggs("order_date", "order_id", "priority"),
        F.sum(F.when(early, F.col("n_lines"))).cast("long").alias("offered_total"),
        F.sum(F.when(early, F.col("n_returned"))).cast("long").alias("missed_total"),
        F.sum(F.when(has, F.col("qty_sum"))).alias("_qty"),
        F.sum(F.when(has, F.col("n_lines") * F.lit(A.MARK_DIVISOR))).alias("_units"),
        F.sum(F.when(has, F.col("n_low"))).cast("long").alias("low_marks"),
        F.sum(F.when(early, F.col("urgent"))).cast("long").alias("action_count"))
    return agg.select(
        KEY, *A.status_columns(), "offered_total", "missed_total",
        ratio("missed_total", "offered_total").alias("miss_rate"),
        round_half_up(ratio("_qty", "_units"), 2).alias("avg_mark"), "low_marks",
        "action_count", F.col("_units").isNotNull().alias("has_marks"))


# ------------------------------------------------------------------ profile
def profile(t: A.Tables, how: str = "inner", flags: bool = True, check: tuple[str, ...] = ()) -> DataFrame:
    """Wide per-entity profile.

    ``how="inner"`` keeps entities with activity, marks and engagement (an
    entity missing any of them vanishes, as in the original pipeline);
    ``how="left"`` keeps every entity with a status, NULLs where facts are
    missing.  Action counts are filled with 0 in both.  All frames but the
    entity and the dimension are aggregates by the key; ``check`` has those
    two checked as well (``q_guarded_profile``).
    """
    per = entity_orders(t)
    if how == "inner":
        per = per.where(F.col("has_marks"))
    # status + activity come from one rollup (attribute: every entity with
    # orders); engagement is the fact joined with ``how``
    out = build_profile(
        A.entity(t), KEY,
        attributes=[per.drop("has_marks")],
        dimension=(A.area_dim(t), "nation_key"),
        facts=[entity_engagement(t)],
        how=how,
        fill={"action_count": 0}, check=check)
    out = out.select(*PROFILE_COLUMNS)
    return add_flags(out, FLAG_RULES) if flags else out


def with_rule_score(prof: DataFrame) -> DataFrame:
    return rule_score(prof.withColumn("engagement_rate", engagement_rate()),
                      RULE_INTERCEPT, rule_terms(), out="risk_raw")


SCORED_COLUMNS = ("entity_id", "name", "segment", "region", "area", "status", "reason",
                  "risk", "risk_band", "miss_rate", "avg_mark", "low_marks", "views",
                  "purchases", "clicks", "balance", "action_count")


def scored(prof: DataFrame, risk_raw: str = "risk_raw",
           thresholds=RULE_THRESHOLDS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Gold scored table: band from the unrounded score, published rounded."""
    b = band(prof, risk_raw, thresholds, out="risk_band")
    return b.select(*extra,
        "entity_id", "name", "segment", "region", "area", "status", "reason",
        round_half_up(F.col(risk_raw), 4).alias("risk"), "risk_band",
        ratio_half_up("missed_total", "offered_total", 4).alias("miss_rate"),
        "avg_mark", F.col("low_marks").cast("long").alias("low_marks"),
        "views", "purchases", "clicks", "balance", "action_count")


def rule_scored(t: A.Tables) -> DataFrame:
    return scored(with_rule_score(profile(t)))


def detail_aggs() -> list:
    """Per (entity, part) detail: lines, missed lines, mean mark (unrounded)."""
    return [F.count(F.lit(1)).alias("lines"),
            F.sum(F.when(F.col("l_returnflag") == A.RETURNED_FLAG, 1).otherwise(0)).cast("long")
            .alias("total_missed"),
            ratio(F.sum("l_quantity"), F.count(F.lit(1)) * F.lit(A.MARK_DIVISOR)).alias("avg_mark")]


def with_part_names(t: A.Tables, agg: DataFrame) -> DataFrame:
    """Name the parts of a detail table (left join)."""
    named = agg.join(A.part_dim(t), agg.l_partkey == F.col("part_key"), "left")
    return named.select("entity_id", F.col("l_partkey").alias("part_key"), "part_name",
                        "lines", "total_missed", "avg_mark")


DETAIL_COLUMNS = ("entity_id", "part_key", "part_name", "lines", "total_missed", "avg_mark")


def entity_detail(t: A.Tables) -> DataFrame:
    """Lines per (entity, part) of every entity; part names are joined at read
    time (``with_part_names``), so the stored table does not carry them."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity_id"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_quantity").join(
        orders, "l_orderkey", "inner")
    return lines.groupBy("entity_id", "l_partkey").agg(*detail_aggs())
