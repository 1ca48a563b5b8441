"""Gold indicators over a scored population.

Averages of published values (risk rounded to 4, rates rounded to 4, marks
rounded to 2) are computed from exact integer unit sums (``scaled_long``),
so they do not depend on row order, and then rounded half-up exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import ratio_half_up, round_half_up, scaled_long
from riskweave.operators.risk import hash_split


def _avg_units(col: str, digits: int, out_digits: int | None = None):
    """Exact mean of a column already rounded to ``digits``, rounded to ``out_digits``."""
    od = digits if out_digits is None else out_digits
    units = F.sum(scaled_long(col, digits))
    n = F.count(F.col(col)) * F.lit(10 ** digits)
    return ratio_half_up(units, n, od)


def by_group(scored: DataFrame, key: str | Sequence[str], status: str, positive: str,
             risk: str = "risk", risk_digits: int = 4, count_name: str = "entities",
             positive_name: str = "positives", avg_name: str = "avg_risk",
             rate_name: str = "positive_rate") -> DataFrame:
    """Per group: entities, positives, mean risk (4 dp), positive rate (4 dp)."""
    keys = [key] if isinstance(key, str) else list(key)
    agg = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name),
        F.sum(F.when(F.col(status) == positive, 1).otherwise(0)).cast("long").alias(positive_name),
        _avg_units(risk, risk_digits).alias(avg_name))
    return agg.withColumn(rate_name, ratio_half_up(positive_name, count_name, 4))


def reasons(scored: DataFrame, status: str, positive: str, reason: str,
            out: str = "entities") -> DataFrame:
    """Positive entities per reason; a NULL reason is its own group."""
    return (scored.where(F.col(status) == positive)
            .groupBy(reason).agg(F.count(F.lit(1)).alias(out)))


def reason_share(reason_counts: DataFrame, count_col: str = "entities",
                 out: str = "share", digits: int = 4) -> DataFrame:
    """Share of each row in the column total.

    The total is a scalar subquery, so the table may have any number of rows.
    """
    total = reason_counts.agg(F.sum(count_col)).scalar()
    return reason_counts.withColumn(out, ratio_half_up(F.col(count_col), total, digits))


def kpis_with_auc(scored: DataFrame, key: str, status: str, positive: str, risk: str = "risk",
                  rate: str = "miss_rate", mark: str = "avg_mark",
                  names: dict[str, str] | None = None) -> DataFrame:
    """``kpis`` with the held-out AUC of the published score, in one pass.

    The table is first reduced to one row per published score (at most
    10,001, and one for no score), which holds every sum the row needs; the
    window over those rows is bounded.
    """
    n = {"total": "total_entities", "positives": "positives", "risk": "avg_risk",
         "rate": "avg_miss_rate", "mark": "avg_mark", "auc": "model_auc", **(names or {})}
    is_pos = F.col(status).eqNullSafe(F.lit(positive))
    test = (F.col("split") == "test") & F.col(risk).isNotNull()
    per = hash_split(scored, key).groupBy(risk).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(is_pos).alias("_pos"),
        F.sum(scaled_long(rate, 4)).alias("_rate"), F.count(rate).alias("_rate_n"),
        F.sum(scaled_long(mark, 2)).alias("_mark"), F.count(mark).alias("_mark_n"),
        F.count_if(test & is_pos).cast("decimal(19,0)").alias("_tp"),
        F.count_if(test & ~is_pos).cast("decimal(19,0)").alias("_tn"))
    below = F.coalesce(F.sum("_tn").over(Window.partitionBy().orderBy(F.col(risk).asc_nulls_first())
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(19,0)")
    per = per.withColumn("_below", below)
    scored_n = F.sum(F.when(F.col(risk).isNotNull(), F.col("_n")))
    auc = F.try_divide(F.sum(F.col("_tp") * (F.col("_below") + F.col("_below") + F.col("_tn"))).cast("double"),
                       (F.sum("_tp").cast("decimal(19,0)") * F.sum("_tn").cast("decimal(19,0)")).cast("double") * 2)
    return per.agg(
        F.sum("_n").cast("long").alias(n["total"]), F.sum("_pos").cast("long").alias(n["positives"]),
        ratio_half_up(F.sum(scaled_long(risk, 4) * F.col("_n")), scored_n * F.lit(10 ** 4), 4).alias(n["risk"]),
        ratio_half_up(F.sum("_rate"), F.sum("_rate_n") * F.lit(10 ** 4), 4).alias(n["rate"]),
        ratio_half_up(F.sum("_mark"), F.sum("_mark_n") * F.lit(100), 2).alias(n["mark"]),
        round_half_up(auc, 4).alias(n["auc"]))


def kpis(scored: DataFrame, status: str, positive: str, risk: str = "risk",
         rate: str = "miss_rate", mark: str = "avg_mark", auc: float | None = None,
         names: dict[str, str] | None = None) -> DataFrame:
    """One row: population, positives, mean risk, mean rate, mean mark [, AUC].

    ``auc`` is a scalar from a previous action (the model evaluation); it
    enters the plan as a literal rounded to 4 places with the same
    engine-independent rule as the other published numbers.
    """
    n = {"total": "total_entities", "positives": "positives", "risk": "avg_risk",
         "rate": "avg_miss_rate", "mark": "avg_mark", "auc": "model_auc", **(names or {})}
    out = scored.agg(
        F.count(F.lit(1)).alias(n["total"]),
        F.sum(F.when(F.col(status) == positive, 1).otherwise(0)).cast("long").alias(n["positives"]),
        _avg_units(risk, 4).alias(n["risk"]),
        _avg_units(rate, 4).alias(n["rate"]),
        _avg_units(mark, 2).alias(n["mark"]))
    if auc is not None:
        import math
        a = float(auc)
        value = None if math.isnan(a) else math.floor(a * 10000 + 0.5) / 10000
        out = out.withColumn(n["auc"], F.lit(value).cast("double"))  # NaN → NULL
    return out
