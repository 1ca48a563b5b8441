"""Per-key aggregates of fact tables (rates, sums, averages, counts).

All of them are plain ``groupBy().agg()`` plans, which Spark executes as a
partial (map-side) hash aggregate, a shuffle of one row per key per task,
and a final aggregate — a hot key costs one row per task, not a third of
the table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import ratio, ratio_half_up, round_half_up

Keys = str | Sequence[str]


def _keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def rate_by(df: DataFrame, keys: Keys, num: str, den: str, *, num_total: str | None = None,
            den_total: str | None = None, rate: str = "rate",
            digits: int | None = None) -> DataFrame:
    """``keys, den_total, num_total, rate`` with ``rate = Σnum / Σden``.

    The rate is NULL when the denominator total is 0.  ``digits=None`` keeps
    it unrounded; otherwise it is the exact half-up rounding of the
    fraction of integer totals (``ratio_half_up``).
    """
    k = _keys(keys)
    nt, dt = num_total or f"{num}_total", den_total or f"{den}_total"
    out = df.groupBy(*k).agg(
        F.sum(den).cast("long").alias(dt),
        F.sum(num).cast("long").alias(nt),
    )
    r = ratio(nt, dt) if digits is None else ratio_half_up(nt, dt, digits)
    return out.withColumn(rate, r)


def rate_by_dim(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                dim_attr: str, num: str, den: str, *, num_total: str | None = None,
                den_total: str | None = None, rate: str = "rate",
                digits: int | None = 4) -> DataFrame:
    """Rate per dimension attribute: facts ⨝ dim on key, then ``rate_by(attr)``.

    The sums are decomposable, so the facts are first reduced to one row per
    ``fact_key`` (partial aggregation before the shuffle), and only that
    reduced table meets the dimension.  The join therefore scales with the
    number of distinct keys, not with the fact rows, and needs no broadcast
    of a dimension whose size is unknown.  AQE turns the join into a
    broadcast at run time when the dimension side proves small.
    """
    nt, dt = num_total or f"{num}_total", den_total or f"{den}_total"
    per_key = facts.groupBy(F.col(fact_key).alias(dim_key)).agg(
        F.sum(num).cast("long").alias("_num"), F.sum(den).cast("long").alias("_den"))
    joined = per_key.join(dim.select(dim_key, dim_attr), dim_key, "inner")
    return rate_by(joined, dim_attr, "_num", "_den", num_total=nt, den_total=dt,
                   rate=rate, digits=digits)


def sum_by(df: DataFrame, keys: Keys, cols: Sequence[str] | dict[str, str],
           cast: str | None = "long") -> DataFrame:
    """Sum each column per key.  ``cols`` may map source → output name."""
    mapping = dict(cols) if isinstance(cols, dict) else {c: f"{c}_total" for c in cols}
    aggs = []
    for src, dst in mapping.items():
        s = F.sum(src)
        aggs.append((s.cast(cast) if cast else s).alias(dst))
    return df.groupBy(*_keys(keys)).agg(*aggs)


def avg_by(df: DataFrame, keys: Keys, *, value: str | Column | None = None,
           sum_col: str | None = None, count_col: str | None = None, out: str = "avg",
           digits: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Mean per key, from raw values or from pre-aggregated (sum, count) pairs.

    Pre-aggregated input lets a caller reduce facts to one row per finer key
    first (e.g. per order) and still obtain the exact mean per coarser key:
    ``Σsum / Σcount``.  ``extra`` adds further aggregate columns.
    """
    if value is not None:
        v = F.col(value) if isinstance(value, str) else value
        s, n = F.sum(v), F.count(v)
    elif sum_col and count_col:
        s, n = F.sum(sum_col), F.sum(count_col)
    else:
        raise ValueError("give value= or both sum_col= and count_col=")
    mean = ratio(s, n)
    if digits is not None:
        mean = round_half_up(mean, digits)
    return df.groupBy(*_keys(keys)).agg(mean.alias(out), *extra)


def count_by(df: DataFrame, keys: Keys, out: str = "count") -> DataFrame:
    """Rows per key (``count(*)``)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(out))

