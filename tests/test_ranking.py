"""Places and running sums in a global order."""

import random

from pyspark.sql import functions as F

from riskweave.operators.ranking import numbered, running_sums
from riskweave.session import ensure_checkpoint_dir, release


def test_numbered_within_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), rng.randrange(50), i) for i in range(700)]
    out = numbered(spark.createDataFrame(rows, "g string, x int, i int").repartition(5), [F.col("x"), F.col("i")], ["g"],
                   partitions=9)
    got = {(r.g, r.x, r.i): (r.place, r.place_rows) for r in out.collect()}
    for g in "ab":
        mine = sorted(r for r in rows if r[0] == g)
        assert [got[r] for r in mine] == [(k, len(mine)) for k in range(len(mine))]


def test_numbered_without_groups_and_empty(spark):
    out = numbered(spark.range(100).select((F.lit(0) - F.col("id")).alias("x")), [F.col("x")], partitions=4)
    assert sorted((r.x, r.place) for r in out.collect()) == [(k - 99, k) for k in range(100)]
    assert numbered(spark.range(0), [F.col("id")]).count() == 0


def test_equal_rows_get_different_places(spark):
    same = spark.range(60).select(F.lit(1).alias("x"))
    assert sorted(r.place for r in numbered(same, [F.col("x")], partitions=4).collect()) == list(range(60))


def test_running_sums(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("x"), (F.col("id") % 5).alias("v"))
    by = {r.x: r.v for r in df.collect()}
    want, total = {}, 0
    for x in sorted(by):
        want[x] = total
        total += by[x]
    for parts in (1, 6):
        got = {r.x: r.v_below for r in running_sums(df, [F.col("x")], ["v"], partitions=parts).collect()}
        assert got == want


def test_windows_are_by_range_or_over_ranges(spark):
    """Without a partition there is only the window over one row a range."""
    df = spark.range(500).select(F.col("id").alias("x"), F.lit(1).cast("long").alias("v"))
    plan = running_sums(df, [F.col("x")], ["v"], partitions=6)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "windowspecdefinition" in x and "Window [" in x]
    assert len(windows) == 2
    assert sum("[_part#" in x.split("AS")[-1] or "windowspecdefinition(_part#" in x for x in windows) == 2
    assert sum("_at#" in x for x in windows) == 1  # rows are ordered inside their range only


def test_release_removes_the_ranges(spark):
    import os

    top = ensure_checkpoint_dir(spark).removeprefix("file://")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    out = numbered(spark.range(10), [F.col("id")])
    assert set(os.listdir(top)) - before
    release(out)
    assert set(os.listdir(top)) == before
