"""Datasets whose stored order counts: a proof of it, and lists read in it.

A sorted write leaves part files whose names ascend with the order and whose
rows stand in it.  Nothing in the files promises that, so it is checked from
the files: every row carries its file and its place there (``_metadata``), and
the order holds if no row comes before its predecessor inside a file and no
file begins before the last row of the one before.

Rows are compared in stretches of ``STRETCH`` places, each a group of its own;
stretches and files then meet by their first and last rows only, so a large
file or a million files take no task more than a row a stretch or a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Places that one task compares at a time.
STRETCH = 1 << 16


def read_placed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The dataset with ``_file`` (part file, folders included) and ``_row``
    (place in it, from 0)."""
    stored = spark.read.schema(schema).parquet(path)
    return stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _breaks(rows: DataFrame, group: Sequence[str], at: str, first: str, last: str) -> Column:
    """Whether a row's ``first`` comes before the ``last`` of the one before it."""
    w = Window.partitionBy(*group).orderBy(at)
    return F.coalesce(F.col(first) < F.lag(last).over(w), F.lit(False)).cast("long")


def order_proof(placed: DataFrame, order: Column) -> DataFrame:
    """One row: ``files, rows, breaks_inside, breaks_between``.

    ``order`` is an expression (a struct for several columns) that must not
    fall from one row to the next, in file-name order; ``breaks_inside`` counts
    the rows that come too early in their file, ``breaks_between`` the files
    that begin too early.  Null sorts first, as it does in a struct.
    """
    keyed = placed.select("_file", "_row", order.alias("k"))
    keyed = keyed.withColumn("stretch", F.call_function("div", F.col("_row"), F.lit(STRETCH)))
    inside = keyed.withColumn("broken", _breaks(keyed, ["_file", "stretch"], "_row", "k", "k"))
    stretches = inside.groupBy("_file", "stretch").agg(
        F.min_by("k", "_row").alias("first"), F.max_by("k", "_row").alias("last"),
        F.count(F.lit(1)).alias("rows"), F.sum("broken").alias("broken"))
    joined = stretches.withColumn("late", _breaks(stretches, ["_file"], "stretch", "first", "last"))
    files = joined.groupBy("_file").agg(
        F.min_by("first", "stretch").alias("first"), F.max_by("last", "stretch").alias("last"),
        F.sum("rows").alias("rows"), F.sum(F.col("broken") + F.col("late")).alias("broken"))
    # one row a file
    between = files.withColumn("late", _breaks(files, [], "_file", "first", "last"))
    zero = F.lit(0)
    return between.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), zero).cast("long").alias("rows"),
                       F.coalesce(F.sum("broken"), zero).cast("long").alias("breaks_inside"),
                       F.coalesce(F.sum("late"), zero).cast("long").alias("breaks_between"))


def first_in_file_order(placed: DataFrame, n: int | Column, cond: Column | None = None,
                        most: int | None = None) -> DataFrame:
    """The first ``n`` rows that pass ``cond`` in stored order, with ``position``
    (from 1); nothing is sorted but those rows.

    Passing rows are counted per file; only files with fewer than ``n`` of them
    before are read again, and in each only the first rows are kept
    (TakeOrderedAndProject).  ``n`` may be a scalar subquery of at most ``most``.
    """
    if isinstance(n, int):
        most, n = n, F.lit(n)
    if most is None:
        raise ValueError("a column needs a bound: most")
    rows = placed if cond is None else placed.where(cond)
    per_file = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))
    # one row a file
    before = F.coalesce(F.sum("rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    early = [r._file for r in per_file.withColumn("before", before).where(F.col("before") < most)
             .select("_file").orderBy("_file").limit(most).collect()]
    some = rows.where(F.col("_file").isin(early)).orderBy("_file", "_row").limit(most)
    place = F.row_number().over(Window.orderBy("_file", "_row")).cast("long")
    return some.withColumn("position", place).where(F.col("position") <= n).drop("_file", "_row")
