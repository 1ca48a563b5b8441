"""Bad CSV rows go aside with file and reason; the rest loads."""

import os

import pytest
from pyspark.sql import types as T

from riskweave.sources.quarantine import TooManyBadRows, load_csv

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()),
                       T.StructField("score", T.DoubleType()), T.StructField("name", T.StringType())])
GOOD = ["1,2026-01-02,0.5,a", "2,,,", '3,2026-02-03,1e-3,"with, comma"', ",,,only name"]
BAD = {"x,2026-01-02,0.5,a": "id is no bigint", "5,02/01/2026,0.5,a": "day is no date", "6,2026-01-02,half,a": "score is no double",
       "7,2026-01-02,0.5,a,more": "more fields than columns", "8,2026-01-02": "fewer fields than columns",
       "9999999999999999999999,2026-01-02,1,a": "id is no bigint"}


def files(scratch, *parts, header=True):
    path = f"{scratch}/in"
    os.makedirs(path)
    for i, lines in enumerate(parts):
        with open(f"{path}/{i}.csv", "w") as f:
            f.write("\n".join((["id,day,score,name"] if header else []) + lines) + "\n")
    return path


@pytest.mark.parametrize("header", [True, False])
def test_load(spark, scratch, header):
    bad = list(BAD)
    path = files(scratch, GOOD[:2] + bad[:3], bad[3:] + GOOD[2:], [], header=header)
    out = load_csv(spark, path, SCHEMA, f"{scratch}/out", header=header)
    assert (out.n_good, out.n_bad) == (4, 6)
    assert {tuple(map(str, r)) for r in out.good.collect()} == {
        ("1", "2026-01-02", "0.5", "a"), ("2", "None", "None", "None"), ("3", "2026-02-03", "0.001", "with, comma"),
        ("None", "None", "None", "only name")}
    got = {r.raw: (r.reason, os.path.basename(r.file)) for r in out.bad.collect()}
    assert got == {raw: (why, "0.csv" if raw in bad[:3] else "1.csv") for raw, why in BAD.items()}
    again = load_csv(spark, path, SCHEMA, f"{scratch}/out", header=header)  # overwrites, adds nothing
    assert again.good.count() == 4 and again.bad.count() == 6


def test_limit(spark, scratch):
    path = files(scratch, GOOD + list(BAD)[:2])
    assert load_csv(spark, path, SCHEMA, f"{scratch}/out", max_bad=2).n_bad == 2
    with pytest.raises(TooManyBadRows, match="2 rows of .* 1 are allowed.*id is no bigint"):
        load_csv(spark, path, SCHEMA, f"{scratch}/out2", max_bad=1)


def test_no_bad_rows_and_no_rows(spark, scratch):
    out = load_csv(spark, files(scratch, GOOD), SCHEMA, f"{scratch}/out", max_bad=0)
    assert out.n_bad == 0 and out.bad.count() == 0 and out.good.count() == 4
    os.makedirs(f"{scratch}/b")
    out = load_csv(spark, files(f"{scratch}/b", []), SCHEMA, f"{scratch}/b/out")
    assert (out.n_good, out.good.count(), out.bad.count()) == (0, 0, 0)


def test_another_header_is_an_error(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/0.csv", "w") as f:
        f.write("day,id,score,name\n2026-01-01,1,0.5,a\n")
    with pytest.raises(Exception):
        load_csv(spark, f"{scratch}/in", SCHEMA, f"{scratch}/out")
