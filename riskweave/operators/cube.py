"""A small cube that answers the page's cards, histogram and facets.

One aggregate with grouping sets holds, for every combination of the facet
columns, the counts and integer unit sums per score unit (for the histogram,
the mean risk and the AUC) and per step of the range filter (for the cards of
any filter), and each facet's values.  Its size depends on the facets, the
10,001 score units and the steps, never on the population.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import ratio_half_up, round_half_up, scaled_long

#: Steps of the range filter in [0, 1].
STEPS = 100


def page_cube(scored: DataFrame, facets: Sequence[str], score: str, rate: str, mark: str, positive: Column,
              test: Column, sums: dict[str, Column], digits: int = 4) -> DataFrame:
    """``cut`` ('score', 'step' or a facet's name), facets, ``unit`` (score in
    ``10^-digits``), ``step``, counts and sums.

    ``unit`` and ``step`` are NULL where score or rate is NULL; ``positive``
    and ``test`` are conditions (label, held-out row).  ``step`` is the
    largest whole step not above the published rate, so "rate at least x" for a whole
    step x is "step at least x".
    """
    unit = scaled_long(score, digits)
    rows = scored.select(
        *facets, unit.alias("unit"), F.call_function("div", scaled_long(rate, digits), F.lit(10 ** digits // STEPS)).cast("int").alias("step"),
        F.coalesce(positive, F.lit(False)).alias("_pos"), F.coalesce(test, F.lit(False)).alias("_test"),
        scaled_long(rate, digits).alias("_rate"), scaled_long(mark, 2).alias("_mark"),
        *[v.alias(f"_{k}") for k, v in sums.items()])
    measures = [
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_pos")).alias("positives"),
        F.count_if(F.col("_pos") & F.col("_test")).alias("test_positives"),
        F.count_if(~F.col("_pos") & F.col("_test")).alias("test_negatives"),
        F.sum("_rate").alias("rate_units"), F.count("_rate").alias("rate_rows"),
        F.sum("_mark").alias("mark_units"), F.count("_mark").alias("mark_rows"),
        *[F.coalesce(F.sum(f"_{k}"), F.lit(0)).cast("long").alias(k) for k in sums]]
    every = [F.col(c) for c in facets]
    cuts = {"score": [*every, F.col("unit")], "step": [*every, F.col("step")], **{f: [F.col(f)] for f in facets}}
    columns = [*every, F.col("unit"), F.col("step")]
    grouped = rows.groupingSets(list(cuts.values()), *columns)
    # a bit per column that is not part of the set, the first column's highest
    names = [*facets, "unit", "step"]
    cut = F.lit(None).cast("string")
    for name, cols in cuts.items():
        inside = {*facets, "unit"} if name == "score" else {*facets, "step"} if name == "step" else {name}
        bits = sum(1 << (len(names) - 1 - i) for i, c in enumerate(names) if c not in inside)
        cut = F.when(F.grouping_id() == bits, F.lit(name)).otherwise(cut)
    return grouped.agg(cut.alias("cut"), *measures).select("cut", *names, *[c for c in (
        "rows", "positives", "test_positives", "test_negatives", "rate_units", "rate_rows", "mark_units", "mark_rows",
        *sums)])


def cube_filter(isin: dict[str, Sequence], min_step: int | None = None) -> Column:
    """The page's filter as a condition on the cube's ``step`` rows."""
    cond = F.col("cut") == "step"
    for c, values in isin.items():
        cond = cond & F.col(c).isin(list(values))
    return cond if min_step is None else cond & (F.col("step") >= min_step)


def cube_kpis(cube: DataFrame, names: dict[str, str], digits: int = 4, scale: int = 100) -> DataFrame:
    """The KPI row: population, positives, mean score, mean rate, mean mark and
    the held-out AUC of the published score."""
    per = cube.where("cut = 'score'").groupBy("unit").agg(*[
        F.sum(c).alias(c) for c in ("rows", "positives", "test_positives", "test_negatives", "rate_units", "rate_rows",
                                    "mark_units", "mark_rows")])
    has = F.col("unit").isNotNull()
    negatives = F.when(has, F.col("test_negatives")).otherwise(0).cast("decimal(19,0)")
    positives = F.when(has, F.col("test_positives")).otherwise(0).cast("decimal(19,0)")
    # at most one row a score unit
    below = F.coalesce(F.sum(negatives).over(Window.orderBy(F.col("unit").asc_nulls_first())
                                             .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("decimal(19,0)")
    per = per.withColumns({"_below": below, "_tn": negatives, "_tp": positives})
    auc = F.try_divide(F.sum(F.col("_tp") * (F.col("_below") + F.col("_below") + F.col("_tn"))).cast("double"),
                       (F.sum("_tp").cast("decimal(19,0)") * F.sum("_tn").cast("decimal(19,0)")).cast("double") * 2)
    one = 10 ** digits
    return per.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias(names["rows"]),
        F.coalesce(F.sum("positives"), F.lit(0)).cast("long").alias(names["positives"]),
        ratio_half_up(F.sum(F.col("unit") * F.col("rows")), F.sum(F.when(has, F.col("rows"))) * F.lit(one), digits)
        .alias(names["score"]),
        ratio_half_up(F.sum("rate_units"), F.sum("rate_rows") * F.lit(one), digits).alias(names["rate"]),
        ratio_half_up(F.sum("mark_units"), F.sum("mark_rows") * F.lit(scale), 2).alias(names["mark"]),
        round_half_up(auc, digits).alias(names["auc"]))


def cube_counts(cube: DataFrame, by: str, digits: int = 4) -> DataFrame:
    """``by, <score>, rows``: rows per published score and facet, for the histogram and the box."""
    return (cube.where("cut = 'score'").groupBy(by, "unit").agg(F.sum("rows").alias("rows"))
            .select(by, (F.col("unit") / F.lit(float(10 ** digits))).alias("risk"), "rows"))


def cube_facets(cube: DataFrame, facets: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """``facet, position, value``: the ordered values of each facet."""
    value = F.coalesce(*[F.when(F.col("cut") == f, F.col(f).cast("string")) for f in facets])
    found = cube.where(F.col("cut").isin(list(facets))).select(F.col("cut").alias("facet"), value.alias("value"))
    down = F.col("facet").isin(list(descending)) if descending else F.lit(False)
    w = Window.partitionBy("facet").orderBy(F.when(~down, F.col("value")).asc_nulls_last(),
                                            F.when(down, F.col("value")).desc_nulls_last())
    return found.select("facet", F.row_number().over(w).cast("long").alias("position"), "value")


def cube_sums(cube: DataFrame, cond: Column, sums: Sequence[str]) -> DataFrame:
    """One row: all rows, rows that pass the filter, and the sums over those."""
    step = F.col("cut") == "step"
    return cube.agg(F.coalesce(F.sum(F.when(step, F.col("rows"))), F.lit(0)).cast("long").alias("n_total"),
                    F.coalesce(F.sum(F.when(cond, F.col("rows"))), F.lit(0)).cast("long").alias("n_filtered"),
                    *[F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long").alias(c) for c in sums])
