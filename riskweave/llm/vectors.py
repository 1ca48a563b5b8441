"""Vectors in blocks: many rows of a vector table as one row with a matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id long, v array<double>``: rows with an id and a vector that is
    neither null nor empty and has only finite components."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False))))


def lengths_of(df: DataFrame) -> list[int]:
    """The lengths that vectors of two ids or more have."""
    ids = df.groupBy(F.size("v").alias("n")).agg(F.min("vec_id").alias("a"), F.max("vec_id").alias("b"))
    return sorted(r.n for r in ids.where("a < b").collect())


def block_count(df: DataFrame, rows: int) -> int:
    """Blocks needed so that one holds about ``rows`` rows."""
    return max(1, -(-df.count() // rows))


def block_of(blocks: int, salt: int = 0) -> Column:
    """Block of a row, by the hash of its id."""
    return F.pmod(F.xxhash64(F.col("vec_id"), F.lit(salt)), F.lit(blocks)).cast("int")
