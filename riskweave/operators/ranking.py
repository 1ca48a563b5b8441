"""Places in a global order, without a window over all rows.

``numbered`` gives every row its place (from 0) in the order of some columns,
within groups if asked.  Rows are dealt out by range and sorted inside each
partition; the rows of each partition and group are counted, a running sum
over that small table gives what lies before, and a row's place is that plus
its place in the partition.  A group of a third of all rows spans as many
partitions as it needs.

``running_sums`` does the same for sums of integer columns.

Both results read a folder in the shared place; ``session.release`` of the
result removes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import spill

#: Low bits of ``monotonically_increasing_id``: the row's number in its partition.
_ROW_BITS = (1 << 33) - 1


def range_sorted(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and sorted, with ``_part`` (number of
    the range) and ``_at`` (place in it), written to the shared folder.

    Rows that compare equal share a range; add a column that tells them apart
    where there may be very many of them.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # both numbers belong to this sort, so they are written with it
    placed = dealt.withColumns({"_part": F.spark_partition_id(),
                                "_at": F.monotonically_increasing_id().bitwiseAND(_ROW_BITS)})
    return spill(placed, "ranges")


def _before(per_part: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Running sums over the ranges before, per group; one row a range and group."""
    w = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.withColumns({s: F.coalesce(F.sum(s).over(w), F.lit(0)).cast("long") for s in sums})


def numbered(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), out: str = "place",
             partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: the row's place (long, from 0) by ``order`` within
    its group (columns without nulls; they sort first), and ``out_rows``, the
    rows of the group.  An empty frame stays empty."""
    group = list(group)
    rows = range_sorted(df, [*map(F.col, group), *order], partitions)
    per_part = rows.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    total = F.sum("_rows").over(Window.partitionBy(*group)).cast("long").alias(f"{out}_rows")
    # a row a range and group: at most as many as ranges and groups together
    offsets = _before(per_part.select(*group, "_part", "_first", "_rows", total), group, ["_rows"])
    joined = rows.join(offsets, [*group, "_part"])
    placed = (joined.withColumn(out, F.col("_at") - F.col("_first") + F.col("_rows"))
              .drop("_part", "_at", "_first", "_rows"))
    placed._spilled = rows._spilled
    return placed


def running_sums(df: DataFrame, order: Sequence[Column], sums: Sequence[str], suffix: str = "_below",
                 partitions: int | None = None) -> DataFrame:
    """``df`` with ``<sum><suffix>`` for each integer column of ``sums``: its sum
    over all rows before this one in the order, which must tell rows apart."""
    rows = range_sorted(df, order, partitions)
    per_part = rows.groupBy("_part").agg(*[F.sum(s).cast("long").alias(f"_{s}") for s in sums])
    offsets = _before(per_part, [], [f"_{s}" for s in sums])
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumns({f"{s}{suffix}": F.coalesce(F.sum(s).over(w), F.lit(0)) for s in sums})
    joined = inside.join(offsets, "_part")
    out = joined.select(*df.columns, *[(F.col(f"{s}{suffix}") + F.col(f"_{s}")).cast("long").alias(f"{s}{suffix}")
                                       for s in sums])
    out._spilled = rows._spilled
    return out
