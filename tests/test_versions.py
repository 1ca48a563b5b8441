"""Refreshes are seen whole or not at all."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from riskweave.sources import io, versions

SF = "/root/testdata/sf0.001"


def writer(n, dies=False, before=None):
    def write(folder):
        df = io.read_table  # noqa: F841
        spark = write.spark
        rows = io.write_counted(spark.range(n), folder, "gold", "a")["rows"]
        if before:
            before()
        if dies:
            raise RuntimeError("died")
        return {"a": rows}
    return write


def run(spark, root, *args, **kw):
    w = writer(*args, **kw)
    w.spark = spark
    return versions.refresh(spark, root, w)


def count(spark, root):
    return io.read_dataset(spark, versions.resolve(spark, root), "gold", "a").count()


def test_a_run_that_dies_leaves_the_old_version(spark, scratch):
    with pytest.raises(FileNotFoundError):
        versions.current(spark, scratch)
    assert versions.resolve(spark, scratch) == scratch
    first = run(spark, scratch, 5)
    assert first.number == 1 and count(spark, scratch) == 5
    with pytest.raises(RuntimeError, match="died"):
        run(spark, scratch, 9, dies=True, before=lambda: None)
    assert count(spark, scratch) == 5 and versions.current(spark, scratch).facts == {"a": 5}
    assert len([x for x in os.listdir(scratch) if x.startswith("version-")]) == 1  # what it wrote is gone
    assert run(spark, scratch, 7).number == 2 and count(spark, scratch) == 7
    assert [v.facts["a"] for v in versions.commits(spark, scratch)] == [5, 7]


def test_old_version_is_readable_while_the_next_is_written(spark, scratch):
    run(spark, scratch, 3)
    seen = []
    run(spark, scratch, 8, before=lambda: seen.append(count(spark, scratch)))
    assert seen == [3] and count(spark, scratch) == 8


def test_a_driver_that_dies_leaves_an_unseen_folder(spark, scratch):
    run(spark, scratch, 3)
    os.makedirs(f"{scratch}/version-00000002-dead/gold")
    open(f"{scratch}/_commits/.version-00000002-dead", "w").close()  # it had drafted its commit
    assert count(spark, scratch) == 3
    assert run(spark, scratch, 4).number == 2 and count(spark, scratch) == 4
    assert versions.vacuum(spark, scratch, keep=1)  # the first version and the dead folder
    assert [v.number for v in versions.commits(spark, scratch)] == [2] and count(spark, scratch) == 4
    assert len([x for x in os.listdir(scratch) if x.startswith("version-")]) == 1
    with pytest.raises(ValueError):
        versions.vacuum(spark, scratch, keep=0)


def test_two_runs_at_once(spark, scratch):
    """Both begin after version 1; the second to commit fails and changes nothing."""
    run(spark, scratch, 3)
    with pytest.raises(versions.Conflict):
        run(spark, scratch, 5, before=lambda: run(spark, scratch, 6))
    assert count(spark, scratch) == 6 and versions.current(spark, scratch).number == 2
    errors = []

    def go(n):
        try:
            run(spark, scratch, n)
        except versions.Conflict:
            errors.append(n)

    threads = [threading.Thread(target=go, args=(n,)) for n in (11, 12, 13)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    done = versions.commits(spark, scratch)
    assert len(done) == 2 + 3 - len(errors) and [v.number for v in done] == list(range(1, len(done) + 1))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_pipeline_refresh(spark, scratch):
    from riskweave.plans import pipeline

    v = pipeline.refresh(spark, SF, scratch, csv=True)
    counts = {f"{r.dataset}.{r.format}": r.rows for r in pipeline.published_counts(spark, scratch).collect()}
    assert counts == v.facts and len(counts) == 12
    one = io.read_dataset(spark, v.path, "gold", "entity_detail").agg(F.min("entity_id")).first()[0]
    assert pipeline.entity_detail(spark, scratch, one).count() > 0


def test_counted_writes(spark, scratch):
    got = io.write_counted(spark.range(10), scratch, "bronze", "t", {"even": F.count_if(F.col("id") % 2 == 0), "sum": F.sum("id")})
    assert got == {"rows": 10, "even": 5, "sum": 45}
    wide = spark.range(1000).repartition(7).join(spark.range(1000).withColumnRenamed("id", "o"), F.col("id") == F.col("o"))
    assert io.write_counted(wide, scratch, "bronze", "w")["rows"] == 1000
    assert io.write_counted(spark.range(10).where("id > 20"), scratch, "bronze", "t") == {"rows": 0}
    assert not io.exists(spark, io.dataset_path(scratch, "bronze", "t", "parquet"))  # nothing of the earlier run either
    empty = spark.createDataFrame([], "x long")
    assert io.write_counted(empty, scratch, "bronze", "e", {"sum": F.sum("x")}, skip_empty=False) == {"rows": 0, "sum": 0}
    assert io.read_dataset(spark, scratch, "bronze", "e").count() == 0


def test_manifest_reads_each_table_once(spark, monkeypatch):
    """One scan of lineitem in all plans that the manifest runs."""
    from riskweave.plans import queries as Q

    plans, write = [], io.write_counted

    def counted(df, *args, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *args, **kw)

    monkeypatch.setattr(io, "write_counted", counted)
    Q.q_run_manifest(spark, SF).collect()
    text = "\n".join(plans)
    for table, scans in (("lineitem", 1), ("orders", 1), ("events", 1), ("customer", 1)):
        assert text.count(f"/{table}.parquet") == scans
