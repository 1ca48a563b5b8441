"""Golden comparison: every registered query vs its SQL in DuckDB (sf0.001)."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from riskweave.plans.oracle import NO_ORACLE, SQL
from riskweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (1, "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v)))
    return (2, str(v))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert rows == drows


def test_every_query_has_an_oracle_or_is_documented():
    assert set(QUERIES) == set(SQL) | set(NO_ORACLE)


def test_new_part_files_are_seen_in_the_same_session(spark, tmp_path):
    # a fresh copy of the tables, customer and orders as folders of part files
    root = str(tmp_path / "sf")
    os.makedirs(root)
    customer, orders = f"{root}/customer.parquet", f"{root}/orders.parquet"
    for t in "region nation customer supplier part orders lineitem events".split():
        target = f"{root}/{t}.parquet"
        if target in (customer, orders):
            os.makedirs(target)
            target += "/part-0.parquet"
        duckdb.sql(f"SELECT * FROM '{SF}/{t}.parquet'").write_parquet(target)
    names = ("q_left_fill", "q_profile_left", "q_scored_left")
    before = {n: QUERIES[n](spark, root).count() for n in names}
    extra = duckdb.sql(f"SELECT * REPLACE (c_custkey + 1000000 AS c_custkey) FROM '{customer}/part-0.parquet' LIMIT 20")
    extra.write_parquet(f"{customer}/part-1.parquet")
    duckdb.sql(f"SELECT * REPLACE (o_custkey + 1000000 AS o_custkey, o_orderkey + 100000000 AS o_orderkey) "
               f"FROM '{orders}/part-0.parquet' WHERE o_custkey IN (SELECT c_custkey - 1000000 FROM "
               f"'{customer}/part-1.parquet')").write_parquet(f"{orders}/part-1.parquet")
    grown = duckdb.sql(f"SELECT count(DISTINCT o_custkey) FROM '{orders}/part-1.parquet'").fetchall()[0][0]
    assert QUERIES["q_left_fill"](spark, root).count() == before["q_left_fill"] + 20
    for n in names[1:]:
        assert QUERIES[n](spark, root).count() == before[n] + grown > before[n]


def test_queries_leave_no_files(spark):
    from riskweave.session import ensure_checkpoint_dir

    top = ensure_checkpoint_dir(spark).removeprefix("file://")

    def folders():
        return {x for x in os.listdir(top) if not os.path.isdir(f"{top}/{x}") or "-" in x and any(
            x.startswith(p) for p in ("extract", "csv-round", "parquet-round", "publish", "manifest"))}

    before = folders()
    for n in ("q_filtered_extract", "q_csv_roundtrip", "q_parquet_roundtrip", "q_publish_run", "q_run_manifest"):
        QUERIES[n](spark, SF).count()
    assert folders() == before


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["area", "entities", "lapsed", "avg_risk", "lapsed_rate"]
