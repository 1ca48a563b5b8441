"""Exploration tables: filters, search, top-N, histogram, box, facets, detail.

These are the data behind the original application's interactive page,
expressed as DataFrame operators returning small frames.  Every ordering
has a key tie-break, every limit is the feature itself (a top-N), and the
only global windows run on bounded aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import (percent_text, ratio, ratio_half_up, round_half_up, scaled_long,
                                 thousands_text)


# ------------------------------------------------------------------ filters
def extract_predicate(isin: dict[str, Sequence] | None = None,
                      at_least: dict[str, float] | None = None) -> Column:
    """Conjunction of set-membership and ``>=`` range predicates."""
    cond = F.lit(True)
    for c, values in (isin or {}).items():
        cond = cond & F.col(c).isin(list(values))
    for c, lo in (at_least or {}).items():
        cond = cond & (F.col(c) >= F.lit(lo))
    return cond


def search_predicate(text: str, name_col: str, id_col: str, regex: bool = False) -> Column:
    """Lower-cased name contains the trimmed, lower-cased query, or the id
    rendered as text equals it.

    ``regex=False`` (default) matches the query literally, so characters
    such as ``(`` need no escaping; ``regex=True`` treats it as a Java
    regular expression (partial match), as the original page did.  An
    empty query matches everything.
    """
    q = text.strip().lower()
    if not q:
        return F.lit(True)
    name = F.lower(F.col(name_col))
    hit = name.rlike(q) if regex else name.contains(F.lit(q))
    return hit | (F.col(id_col).cast("string") == F.lit(q))


def search(df: DataFrame, text: str, name_col: str, id_col: str,
           regex: bool = False) -> DataFrame:
    return df.where(search_predicate(text, name_col, id_col, regex))


def filter_share(df: DataFrame, cond: Column, digits: int = 4) -> DataFrame:
    """One row: rows before / after a filter, their share and its text.

    Both counts come from one aggregate pass (``count`` and ``count_if``).
    The text is ``'-'`` when there are no rows at all.
    """
    both = df.agg(F.count(F.lit(1)).alias("n_total"),
                  F.count_if(F.coalesce(cond, F.lit(False))).cast("long").alias("n_filtered"))
    share = ratio(F.col("n_filtered"), F.col("n_total"))
    return both.select(
        "n_total", "n_filtered",
        ratio_half_up("n_filtered", "n_total", digits).alias("filter_share"),
        F.when(F.col("n_total") == 0, F.lit("-")).otherwise(percent_text(share, 1))
        .alias("share_text"))


def volume_cards(filtered: DataFrame, cond: Column, generated: DataFrame, field: str,
                 sums: dict[str, Column]) -> DataFrame:
    """The page's volume cards, one row: filtered rows, sums over them, the
    generated population (``field`` of a one-row manifest; the rows at hand
    where it is absent) and the share of it that passes the filter, as text.
    """
    hit = F.coalesce(cond, F.lit(False))
    here = filtered.agg(F.count(F.lit(1)).alias("_rows"), F.count_if(hit).alias("n_filtered"),
                        *[F.coalesce(F.sum(F.when(hit, c)), F.lit(0)).cast("long").alias(k)
                          for k, c in sums.items()])
    made = generated.agg(F.max(field).cast("long")).scalar()
    both = here.withColumn("_n", F.coalesce(made, F.col("_rows")))
    n = F.col("_n")
    return both.select(
        n.alias("population"), "n_filtered", *sums,
        thousands_text(n).alias("population_text"), thousands_text("n_filtered").alias("filtered_text"),
        *[thousands_text(k).alias(f"{k}_text") for k in sums],
        F.when(n == 0, F.lit("-")).otherwise(percent_text(ratio(F.col("n_filtered"), n), 1)).alias("share_text"))


#: Largest adaptive list length.
TOP_MOST = 200


def adaptive_params(df: DataFrame, count_col: str | None = None) -> DataFrame:
    """One row: population ``n``, ``top_n = min(200, max(20, n div 25))`` and
    ``bins = min(40, max(20, n div 100))``.

    ``count_col`` reads ``n`` from a one-row frame (e.g. a run manifest)
    instead of counting ``df``.
    """
    base = (df.select(F.col(count_col).cast("long").alias("n")) if count_col
            else df.agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    return base.select(
        n.alias("entities"),
        F.least(F.lit(TOP_MOST), F.greatest(F.lit(20), F.call_function("div", n, F.lit(25))))
        .cast("long").alias("top_n"),
        F.least(F.lit(40), F.greatest(F.lit(20), F.call_function("div", n, F.lit(100))))
        .cast("long").alias("bins"))


# ------------------------------------------------------------------- top-N
def top_n_of(df: DataFrame, by: str, n: Column, most: int, key: str) -> DataFrame:
    """First ``n`` rows by ``by`` (desc, ties by ``key``) where ``n`` is a
    scalar subquery of at most ``most``: the top ``most`` are taken first
    (TakeOrderedAndProject), numbered, and cut at ``n``."""
    order = [F.col(by).desc_nulls_last(), F.col(key).asc()]
    rows = df.orderBy(*order).limit(int(most))
    return (rows.withColumn("_rank", F.row_number().over(Window.partitionBy().orderBy(*order)))
            .where(F.col("_rank") <= n).drop("_rank"))


def top_n(df: DataFrame, by: str, n: int, key: str, ascending: bool = False) -> DataFrame:
    """First ``n`` rows by ``by`` (desc by default), ties broken by ``key``.

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those reach the final merge — no global sort of the input.
    """
    order = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(order, F.col(key).asc()).limit(int(n))


# ------------------------------------------------------------------- charts
def histogram(df: DataFrame, value: str, bins: Column | int, by: str | None = None,
              digits: int = 4, out: str = "entities") -> DataFrame:
    """Equal-width histogram of a published score in [0, 1] (1 falls in the
    last bin), optionally split by ``by``: ``bin, [by,] bin_lo, bin_hi, n``.

    The score is taken in integer units of ``10^-digits``, so a value that
    lies on a bin's edge always falls into the bin above it.  ``bins`` may be
    a column that is the same in every row.
    """
    scale = 10 ** digits
    bins = F.lit(bins) if isinstance(bins, int) else bins
    h = df.where(F.col(value).isNotNull()).select(
        F.least(F.call_function("div", scaled_long(value, digits) * bins, F.lit(scale)), bins - 1)
        .cast("int").alias("bin"), *([by] if by else []), bins.cast("int").alias("_bins"))
    agg = h.groupBy("bin", *([by] if by else []), "_bins").agg(F.count(F.lit(1)).alias(out))
    return agg.select("bin", *([by] if by else []), out,
                      (F.col("bin") / F.col("_bins")).alias("bin_lo"),
                      ((F.col("bin") + 1) / F.col("_bins")).alias("bin_hi"))


def box(df: DataFrame, value: str, by: str, value_digits: int = 4,
        out_digits: int = 6) -> DataFrame:
    """Per group: n, min, q1, median, q3, max (linear interpolation).

    Exact and bounded: the value is first rounded to ``value_digits`` (the
    published precision), so each group has at most ``10^d + 1`` distinct
    values.  Rank positions are found from cumulative counts over that
    bounded histogram — no group's rows are ever collected into one task.
    Interpolated results are multiples of ``10^-d / 4`` and are rounded to
    ``out_digits`` to drop floating noise.
    """
    v = round_half_up(F.col(value), value_digits)
    h = (df.where(F.col(value).isNotNull())
         .groupBy(by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    cum = Window.partitionBy(by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    h = (h.withColumn("_cum", F.sum("_n").over(cum))
          .withColumn("_tot", F.sum("_n").over(Window.partitionBy(by))))

    def at_rank(rank: Column) -> Column:
        # value at 0-based rank r = smallest value whose cumulative count > r
        return F.min(F.when(F.col("_cum") > rank, F.col("_v")))

    aggs = [F.max("_tot").cast("long").alias("n"), F.min("_v").alias("min"),
            F.max("_v").alias("max")]
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        pos = (F.col("_tot") - 1) * F.lit(p)
        aggs += [at_rank(F.floor(pos)).alias(f"_{name}_lo"),
                 at_rank(F.ceil(pos)).alias(f"_{name}_hi")]
    g = h.groupBy(by).agg(*aggs)
    cols = [by, "n", "min"]
    for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        pos = (F.col("n") - 1) * F.lit(p)
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append(round_half_up(lo + frac * (hi - lo), out_digits).alias(name))
    return g.select(*cols, "max")


def score_counts(df: DataFrame, value: str, by: str, digits: int = 4) -> DataFrame:
    """``by, value, rows, below, total``: rows per published value (at most
    ``10^digits + 1`` a group for a score in [0, 1]), and the rows of the group
    below it and in all."""
    h = (df.where(F.col(value).isNotNull()).groupBy(by, round_half_up(F.col(value), digits).alias("value"))
         .agg(F.count(F.lit(1)).alias("rows")))
    group = Window.partitionBy(by)
    running = F.sum("rows").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    return h.select(by, "value", "rows", (running - F.col("rows")).alias("below"), F.sum("rows").over(group).alias("total"))


def box_drawn(counts: DataFrame, by: str, digits: int = 6) -> DataFrame:
    """The box as the page's chart draws it, one row per group of ``score_counts``.

    Quartiles lie at the 0-based place ``p·n − 1/2``, between the two values
    around it; the fences are 1.5 interquartile ranges from the box; a whisker
    ends at the outermost value inside its fence, and values beyond are
    outliers.  ``notch_lo`` and ``notch_hi`` are the median ± 1.57
    interquartile ranges over √n.
    """
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("below") + F.col("rows") > rank, F.col("value")))

    aggs = [F.max("total").cast("long").alias("n"), F.min("value").alias("min"), F.max("value").alias("max")]
    for name, p in names.items():
        place = F.greatest(F.lit(0.0), F.least(F.col("total") * F.lit(p) - 0.5, F.col("total") - F.lit(1.0)))
        aggs += [at_rank(F.floor(place)).alias(f"_{name}_lo"), at_rank(F.ceil(place)).alias(f"_{name}_hi")]
    g = counts.groupBy(by).agg(*aggs)
    for name, p in names.items():
        place = F.greatest(F.lit(0.0), F.least(F.col("n") * F.lit(p) - 0.5, F.col("n") - F.lit(1.0)))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        g = g.withColumn(name, round_half_up(lo + (place - F.floor(place)) * (hi - lo), digits))
    spread = F.col("q3") - F.col("q1")
    notch = F.lit(1.57) * spread / F.sqrt(F.col("n").cast("double"))
    box = g.select(by, "n", "min", "q1", "median", "q3", "max",
                   round_half_up(F.col("q1") - 1.5 * spread, digits).alias("fence_lo"),
                   round_half_up(F.col("q3") + 1.5 * spread, digits).alias("fence_hi"),
                   round_half_up(F.col("median") - notch, digits).alias("notch_lo"),
                   round_half_up(F.col("median") + notch, digits).alias("notch_hi"))
    v, rows = F.col("value"), F.col("rows")
    ends = (counts.join(box.select(F.col(by).alias("_by"), "fence_lo", "fence_hi", "q1", "q3"),
                        F.col(by).eqNullSafe(F.col("_by")))
            .groupBy("_by").agg(
                F.least(F.min(F.when(v >= F.col("fence_lo"), v)), F.first("q1")).alias("whisker_lo"),
                F.greatest(F.max(F.when(v <= F.col("fence_hi"), v)), F.first("q3")).alias("whisker_hi"),
                F.coalesce(F.sum(F.when(v < F.col("fence_lo"), rows)), F.lit(0)).cast("long").alias("outliers_lo"),
                F.coalesce(F.sum(F.when(v > F.col("fence_hi"), rows)), F.lit(0)).cast("long").alias("outliers_hi")))
    return box.join(ends, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def box_outliers(counts: DataFrame, box: DataFrame, by: str) -> DataFrame:
    """``by, value, rows``: the points drawn beyond the whiskers."""
    fences = box.select(F.col(by).alias("_by"), "fence_lo", "fence_hi")
    joined = counts.join(fences, F.col(by).eqNullSafe(F.col("_by")))
    return (joined.where((F.col("value") < F.col("fence_lo")) | (F.col("value") > F.col("fence_hi")))
            .select(by, "value", "rows"))


def weighted_histogram(per: DataFrame, value: str, weight: str, by: str, digits: int = 4,
                       out: str = "entities") -> DataFrame:
    """``histogram`` with adaptive bins from ``(value, by, weight)`` rows, one
    per published value and group, so at most ``10^digits + 1`` per group;
    the population is their sum."""
    n = F.sum(weight).over(Window.partitionBy())
    bins = F.least(F.lit(40), F.greatest(F.lit(20), F.call_function("div", n, F.lit(100))))
    h = per.withColumn("_bins", bins).where(F.col(value).isNotNull())
    at = F.least(F.call_function("div", scaled_long(value, digits) * F.col("_bins"), F.lit(10 ** digits)),
                 F.col("_bins") - 1).cast("int")
    return (h.groupBy(at.alias("bin"), by, "_bins").agg(F.sum(weight).cast("long").alias(out))
            .select("bin", by, out, (F.col("bin") / F.col("_bins")).alias("bin_lo"),
                    ((F.col("bin") + 1) / F.col("_bins")).alias("bin_hi")))


def place(group: str | None, order: Column, key: str) -> Column:
    """Place (from 1) of a row in a list ordered by ``order``, ties by ``key``;
    for lists that are bounded by one entity or by a top-N."""
    w = Window.partitionBy(*([group] if group else [])).orderBy(order, F.col(key).asc())
    return F.row_number().over(w).cast("long")


def facets(df: DataFrame, cols: Sequence[str], descending: Sequence[str] = ()) -> DataFrame:
    """Distinct values of each column as ``(facet, position, value)`` rows.

    One pass over ``df``: every row is turned into one ``(facet, value)``
    pair per column (``inline`` of an array of structs) and a single
    ``distinct`` removes duplicates — map-side first, so each task ships at
    most its own distinct pairs.  ``position`` (from 1) is the place of the
    value in its list: ascending, or descending for the facets named so.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    found = df.select(F.inline(pairs)).distinct()
    down = F.col("facet").isin(list(descending)) if descending else F.lit(False)
    w = Window.partitionBy("facet").orderBy(F.when(~down, F.col("value")).asc_nulls_last(),
                                            F.when(down, F.col("value")).desc_nulls_last())
    return found.select("facet", F.row_number().over(w).cast("long").alias("position"), "value")


# ------------------------------------------------------------------- detail
def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup (pushed to the scan as an equality filter)."""
    return df.where(F.col(key) == F.lit(value))


def lookup_counts(tables: dict[str, DataFrame], one: DataFrame, key: str) -> DataFrame:
    """``table_name, key, rows`` of the entity in the one-row frame ``one``."""
    parts = [df.join(F.broadcast(one), key).groupBy().agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn(key, one.select(key).scalar())


def detail_by(facts: DataFrame, group_key: str, aggs: Sequence[Column],
              dim: DataFrame | None = None, dim_key: str | None = None) -> DataFrame:
    """Aggregate one entity's facts per ``group_key``, then left join names."""
    out = facts.groupBy(group_key).agg(*aggs)
    if dim is None:
        return out
    if dim_key is None or dim_key == group_key:
        return out.join(dim, group_key, "left")
    return out.join(dim, out[group_key] == dim[dim_key], "left").drop(dim[dim_key])

