import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources import io

SCH = T.StructType([T.StructField("student_id", T.LongType()),
                    T.StructField("dropout_date", T.DateType()),
                    T.StructField("dropout_reason", T.StringType())])


def test_csv_declared_schema_empty_is_null(spark, scratch):
    p = os.path.join(scratch, "enr.csv")
    with open(p, "w") as f:
        f.write("student_id,dropout_date,dropout_reason\n1,,\n2,2026-08-03,Trabalho\n")
    df = io.read_table(spark, scratch, "enr", fmt="csv", schema=SCH)
    rows = {r["student_id"]: r for r in df.collect()}
    assert rows[1]["dropout_date"] is None and rows[1]["dropout_reason"] is None
    assert str(rows[2]["dropout_date"]) == "2026-08-03"


def test_missing_optional_and_required(spark, scratch):
    empty = io.read_table(spark, scratch, "interventions", fmt="csv", on_missing="empty")
    assert empty.count() == 0 and "intervention_id" in empty.columns
    with pytest.raises(AnalysisException):
        io.read_table(spark, scratch, "students", fmt="csv")


def test_publish_parquet_and_csv_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], SCH)
    paths = io.publish(df, scratch, "gold", "t", formats=("parquet", "csv"), single_csv_file=True)
    assert set(paths) == {"parquet", "csv"}
    io.publish(df, scratch, "gold", "t", formats=("parquet", "csv"))  # overwrite, no duplicates
    back = io.read_dataset(spark, scratch, "gold", "t")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    csv = io.read_dataset(spark, scratch, "gold", "t", fmt="csv", schema=SCH)
    assert csv.count() == 2 and csv.where(F.col("dropout_reason").isNull()).count() == 1
    with pytest.raises(AnalysisException):
        io.read_dataset(spark, scratch, "gold", "missing")


def test_publish_skips_empty(spark, scratch):
    full = spark.createDataFrame([(1, None, "x")], SCH)
    io.publish(full, scratch, "bronze", "none", formats=("parquet", "csv"))
    df = spark.createDataFrame([], SCH)
    assert io.publish(df, scratch, "bronze", "none", formats=("parquet", "csv"), skip_empty=True) == {}
    # nothing of the earlier run stays readable
    assert io.read_dataset(spark, scratch, "bronze", "none").count() == 0
    assert io.read_dataset(spark, scratch, "bronze", "none", fmt="csv", schema=SCH).count() == 0


def test_csv_alone_leaves_no_parquet(spark, scratch):
    df = spark.createDataFrame([(1, None, "x")], SCH)
    io.publish(df, scratch, "gold", "only", formats=("csv",))
    assert not os.path.exists(io.dataset_path(scratch, "gold", "only", "parquet"))
    assert io.read_dataset(spark, scratch, "gold", "only", fmt="csv", schema=SCH).count() == 1
    with pytest.raises(ValueError):
        io.read_dataset(spark, scratch, "gold", "only", fmt="csv")


def test_partition_column_stays_in_place(spark, scratch):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "k long, band string, v double")
    io.publish(df, scratch, "gold", "p", formats=("parquet", "csv"), partition_by=["band"], sort_by=["band", "k"])
    csv = io.read_dataset(spark, scratch, "gold", "p", fmt="csv", schema=df.schema)
    assert csv.columns == df.columns and sorted(map(tuple, csv.collect())) == sorted(map(tuple, df.collect()))
    back = io.read_dataset(spark, scratch, "gold", "p", schema=df.schema)
    assert back.columns == df.columns


def test_missing_parquet_column_is_an_error(spark, scratch):
    spark.range(3).withColumnRenamed("id", "other").write.parquet(io.table_path(scratch, "t"))
    with pytest.raises(ValueError, match="student_id"):
        io.read_table(spark, scratch, "t", schema=SCH)


@pytest.mark.parametrize("parts", [2, io.DRIVER_FOOTERS + 6])
@pytest.mark.parametrize("odd", ["first", "last"])
def test_one_odd_part_file_is_an_error(spark, scratch, parts, odd):
    """Whichever file lacks a column, and whoever reads the footers."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = io.table_path(scratch, "t")
    os.makedirs(path)
    at = 0 if odd == "first" else parts - 1
    for k in range(parts):
        row = {"student_id": [k], "dropout_date": pa.array([None], pa.date32()), "dropout_reason": ["x"]}
        if k == at:
            del row["dropout_reason"]
        pq.write_table(pa.table(row), f"{path}/part-{k:05d}.parquet")
    with pytest.raises(ValueError, match=f"part-{at:05d}.parquet has no column dropout_reason"):
        io.read_table(spark, scratch, "t", schema=SCH)
    sound = T.StructType(SCH.fields[:2])
    assert io.read_table(spark, scratch, "t", schema=sound).count() == parts
    with pytest.raises(ValueError, match="dropout_reason"):
        io.read_table(spark, scratch, "t", schema=SCH, path=f"{path}/*.parquet")


def test_many_part_files_with_a_folder_column(spark, scratch):
    n = io.DRIVER_FOOTERS + 6
    df = spark.range(n).select("id", F.col("id").cast("string").alias("band"))
    io.publish(df, scratch, "gold", "p", partition_by=["band"])
    assert io.read_dataset(spark, scratch, "gold", "p", schema=df.schema).count() == n


def test_reading_takes_no_job(spark, scratch):
    """Schemas come from the declaration and footers from the driver."""
    spark.range(3).select(F.col("id").alias("student_id"), F.lit(None).cast("date").alias("dropout_date"),
                          F.lit("x").alias("dropout_reason")).write.parquet(io.table_path(scratch, "t"))
    spark.sparkContext.setJobGroup("reading", "reading")
    try:
        io.read_table(spark, scratch, "t", schema=SCH)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("reading")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_corrupt_csv_row_is_an_error(spark, scratch):
    p = os.path.join(scratch, "bad.csv")
    with open(p, "w") as f:
        f.write("student_id,dropout_date,dropout_reason\nnot a number,,x\n")
    with pytest.raises(Exception):
        io.read_csv(spark, p, SCH).collect()


def test_manifest_roundtrip_missing_and_corrupt(spark, scratch):
    a = spark.range(5)
    b = spark.range(3)
    m = io.run_manifest({"a": a, "b": b}, {"entities_count": "a", "activity_rows": "b"}, seed=7)
    r = m.first()
    assert (r["entities_count"], r["activity_rows"], r["seed"]) == (5, 3, 7)
    assert r["generated_at"].endswith("Z") or "+" in r["generated_at"]
    path = io.write_manifest(m, os.path.join(scratch, "manifest"))
    back = io.read_manifest(spark, path).first()
    assert back["entities_count"] == 5 and back["seed"] == 7 and back["marks_rows"] is None
    assert io.read_manifest(spark, os.path.join(scratch, "nope")).count() == 0
    bad = os.path.join(scratch, "bad.json")
    with open(bad, "w") as f:
        f.write("{not json")
    assert io.read_manifest(spark, bad).count() == 0
    ok = os.path.join(scratch, "ok.json")
    with open(ok, "w") as f:
        f.write(json.dumps({"seed": 2026}))
    got = io.read_manifest(spark, ok)
    # an absent field falls back to a default supplied by the caller
    n = got.select(F.coalesce("entities_count", F.lit(42)).alias("n")).first()["n"]
    assert n == 42


def test_table_counts(spark):
    got = {r["table_name"]: r["rows"] for r in
           io.table_counts({"x": spark.range(4), "y": spark.range(0)}).collect()}
    assert got == {"x": 4, "y": 0}


def test_csv_header_must_match_declared_columns(spark, scratch):
    p = os.path.join(scratch, "swapped.csv")
    with open(p, "w") as f:
        f.write("dropout_reason,dropout_date,student_id\nTrabalho,2026-08-03,1\n")
    with pytest.raises(Exception):
        io.read_table(spark, scratch, "swapped", fmt="csv", schema=SCH).collect()
