import os

from pyspark.sql import types as T

from riskweave.streaming import refresh_on_new_files

SCH = T.StructType([T.StructField("k", T.LongType())])


def test_refresh_runs_once_per_new_files(spark, tmp_path):
    watch, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    os.makedirs(watch)
    calls = []
    spark.createDataFrame([(1,), (2,)], SCH).write.mode("append").parquet(watch)
    assert refresh_on_new_files(spark, watch, SCH, ck, lambda: calls.append(1)) == 2
    assert refresh_on_new_files(spark, watch, SCH, ck, lambda: calls.append(1)) == 0
    spark.createDataFrame([(3,)], SCH).write.mode("append").parquet(watch)
    assert refresh_on_new_files(spark, watch, SCH, ck, lambda: calls.append(1)) == 1
    assert len(calls) == 2


def test_refresh_on_csv_bronze(spark, tmp_path):
    watch, ck = str(tmp_path / "csv"), str(tmp_path / "ck-csv")
    os.makedirs(watch)
    with open(os.path.join(watch, "a.csv"), "w") as f:
        f.write("k\n1\n2\n3\n")
    calls = []
    assert refresh_on_new_files(spark, watch, SCH, ck, lambda: calls.append(1), fmt="csv") == 3
    with open(os.path.join(watch, "b.csv"), "w") as f:
        f.write("k\n4\n")
    assert refresh_on_new_files(spark, watch, SCH, ck, lambda: calls.append(1), fmt="csv") == 1
    assert len(calls) == 2
