"""Data-quality reports from declared constraints (PK, NOT NULL, FK).

Violations are reported as rows, never raised, so a job can publish them.
Every check is a partial-aggregate + shuffle plan:

* primary key — ``groupBy(pk).count() > 1`` (a hot key is combined map-side);
* NOT NULL    — one ``count_if(c IS NULL)`` pass per table, unpivoted;
* foreign key — child keys are first reduced to ``(key, rows)`` and only
                 the distinct keys meet the parent in a left-anti join, so a
                 child key holding a third of the rows is a single row there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.sources.schemas import ForeignKey, TableSpec


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once: ``keys..., rows``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def pk_summary(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """``table_name, dup_keys, dup_rows`` for every table with a declared PK."""
    parts = []
    for name, df in tables.items():
        pk = specs[name].primary_key
        if not pk:
            continue
        v = pk_violations(df, pk)
        parts.append(v.agg(F.count(F.lit(1)).alias("dup_keys"),
                           F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("dup_rows"))
                     .select(F.lit(name).alias("table_name"), "dup_keys", "dup_rows"))
    return _union(parts)


def null_counts(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """``table_name, column_name, nulls`` — one aggregate pass, then unpivot."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    long = wide.unpivot([], list(cols), "column_name", "nulls")
    return long.select(F.lit(table).alias("table_name"), "column_name", "nulls")


def null_summary(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> DataFrame:
    """NULL counts of every declared NOT NULL column (PK columns included)."""
    return _union([null_counts(df, specs[n].not_null, n) for n, df in tables.items()
                   if specs[n].not_null])


def fk_orphans(child: DataFrame, fk: ForeignKey, parent: DataFrame) -> DataFrame:
    """Child key values with no parent row: ``fk columns..., rows``.

    NULL keys are not violations (SQL foreign-key semantics).
    """
    cols = list(fk.columns)
    nn = F.lit(True)
    for c in cols:
        nn = nn & F.col(c).isNotNull()
    keys = child.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
    # distinct: a key that a third of the parent's rows share is one row in the join
    pkeys = parent.select(*[F.col(p).alias(c) for p, c in zip(fk.parent_columns, cols)]).distinct()
    return keys.join(pkeys, cols, "left_anti")


def fk_summary(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec],
               extra: Sequence[tuple[str, str, ForeignKey]] = ()) -> DataFrame:
    """``constraint_name, child_table, orphan_keys, orphan_rows`` per declared FK.

    ``extra`` adds ``(name, child_table, fk)`` checks that are not declared
    in the schema (e.g. "every order has at least one line").  A check whose
    parent table is not among ``tables`` is an error, never skipped.
    """
    checks = [(fk.name, name, fk) for name in tables for fk in specs[name].foreign_keys]
    checks += list(extra)
    absent = sorted({f"{cname} ({fk.parent})" for cname, _, fk in checks if fk.parent not in tables})
    if absent:
        raise ValueError(f"foreign keys without their parent table: {', '.join(absent)}")
    if not checks:
        raise ValueError("no foreign key to check")
    parts = []
    for cname, child_name, fk in checks:
        o = fk_orphans(tables[child_name], fk, tables[fk.parent])
        parts.append(o.agg(F.count(F.lit(1)).alias("orphan_keys"),
                           F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows"))
                     .select(F.lit(cname).alias("constraint_name"),
                             F.lit(child_name).alias("child_table"), "orphan_keys", "orphan_rows"))
    return _union(parts)


def cardinality_report(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """``frame, keys, rows`` per frame declared to have one row per key: the
    keys with more, and their rows (null keys join nothing and do not count)."""
    parts = []
    for name, df in frames.items():
        v = pk_violations(df.where(F.col(key).isNotNull()).select(key), [key])
        parts.append(v.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
                     .select(F.lit(name).alias("frame"), "keys", "rows"))
    return _union(parts)
