"""Stored order: proved from files, and lists read in it."""

import random

import pytest
from pyspark.sql import functions as F

from riskweave.sources import ordered

SCHEMA = "k long, risk double"


def write(spark, path, files):
    """One part file per list, in this order of names."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(path)
    for i, rows in enumerate(files):
        pq.write_table(pa.table({"k": pa.array([r[0] for r in rows], pa.int64()),
                                 "risk": pa.array([r[1] for r in rows], pa.float64())}), f"{path}/part-{i:05d}.parquet")
    return ordered.read_placed(spark, path, spark.createDataFrame([], SCHEMA).schema)


def order():
    return F.struct(F.col("risk").isNull(), -F.col("risk"), "k")


def proof(placed):
    return ordered.order_proof(placed, order()).first()


@pytest.mark.parametrize("stretch", [1 << 16, 4])
def test_proof(spark, scratch, monkeypatch, stretch):
    monkeypatch.setattr(ordered, "STRETCH", stretch)
    rows = sorted(((k, random.Random(k).randrange(9) / 10) for k in range(60)), key=lambda r: (-r[1], r[0])) + [(99, None)]
    cuts = [rows[:20], rows[20:21], rows[21:50], [], rows[50:]]
    p = proof(write(spark, f"{scratch}/good", cuts))
    assert (p.rows, p.breaks_inside, p.breaks_between) == (61, 0, 0) and p.files == 4
    p = proof(write(spark, f"{scratch}/files", [cuts[2], cuts[0], cuts[4]]))
    assert (p.breaks_inside, p.breaks_between) == (0, 1)
    swapped = rows[:]
    swapped[7], swapped[8] = swapped[8], swapped[7]  # inside a stretch of 4: places 4 to 7 | 8 to 11
    assert proof(write(spark, f"{scratch}/one", [swapped])).breaks_inside == 1
    assert proof(write(spark, f"{scratch}/none", [[]])).rows == 0


def test_sorted_publish_is_in_order_and_unsorted_is_not(spark, scratch):
    from riskweave.sources import io

    df = spark.range(3000).select(F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("risk"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sort = [F.col("risk").desc_nulls_last(), F.col("k")]
        a = io.publish(df, scratch, "gold", "a", sort_by=sort)["parquet"]
        b = io.publish(df, scratch, "gold", "b")["parquet"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    p = proof(ordered.read_placed(spark, a, df.schema))
    assert (p.rows, p.breaks_inside, p.breaks_between) == (3000, 0, 0) and p.files > 1
    assert proof(ordered.read_placed(spark, b, df.schema)).breaks_inside > 0


def test_first_rows_in_file_order(spark, scratch):
    rng = random.Random(2)
    files = [[(rng.randrange(1000), rng.random()) for _ in range(n)] for n in (5, 0, 40, 3, 200)]
    placed = write(spark, f"{scratch}/t", files)
    everything = [r for f in files for r in f]
    for n in (1, 5, 6, 47, 500):
        got = sorted((r.position, r.k, r.risk) for r in ordered.first_in_file_order(placed, n).collect())
        assert got == [(i + 1, *r) for i, r in enumerate(everything[:n])]
    some = [r for r in everything if r[0] % 2]
    cond = F.col("k") % 2 == 1
    got = sorted((r.position, r.k) for r in ordered.first_in_file_order(placed, 60, cond).collect())
    assert got == [(i + 1, r[0]) for i, r in enumerate(some[:60])]
    n = spark.range(1).select((F.col("id") + 7).alias("n")).select("n").scalar()
    assert ordered.first_in_file_order(placed, n, cond, most=20).count() == 7
    assert ordered.first_in_file_order(placed, 5, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        ordered.first_in_file_order(placed, n)


def test_later_files_are_not_read_again(spark, scratch):
    placed = write(spark, f"{scratch}/t", [[(i, 0.5)] * 10 for i in range(6)])
    plan = ordered.first_in_file_order(placed, 15)._jdf.queryExecution().optimizedPlan().toString()
    assert "part-00001" in plan and "part-00002" not in plan
