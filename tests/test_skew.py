"""A key holding a third of all rows: results stay whole and exact, and the
plans aggregate partially before every shuffle."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from riskweave.operators import quality as Q
from riskweave.operators.aggregates import rate_by, rate_by_dim
from riskweave.operators.profile import build_profile
from riskweave.sources.schemas import ForeignKey


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def skewed(spark, n=30000):
    # key 0 holds a third of the rows; the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        (F.col("id") % 7 == 0).cast("int").alias("num"), F.lit(1).alias("den"))


def test_rate_by_hot_key_exact(spark):
    df = skewed(spark)
    got = {r["k"]: r for r in rate_by(df, "k", "num", "den").collect()}
    hot = [i for i in range(30000) if i % 3 == 0]
    assert got[0]["den_total"] == len(hot)
    assert got[0]["num_total"] == sum(1 for i in hot if i % 7 == 0)
    assert sum(r["den_total"] for r in got.values()) == 30000
    text = plan(rate_by(df, "k", "num", "den"))
    # a partial (map-side) aggregate feeds the exchange: the hot key ships
    # one row per task, not a third of the table.  Formatted plans number
    # operators bottom-up, so the partial aggregate's id is below the shuffle's.
    blocks = re.findall(r"\n\((\d+)\) (\w+)([^\n]*\n(?:(?!\n\(\d+\) ).)*)", text, re.S)
    partial = [int(i) for i, op, body in blocks if op == "HashAggregate" and "partial_sum" in body]
    shuffles = [int(i) for i, op, _ in blocks if op == "Exchange"]
    assert partial and shuffles and min(partial) < min(shuffles)


def test_rate_by_dim_hot_key(spark):
    df = skewed(spark)
    dim = spark.range(0, 1001).select(F.col("id").alias("k"),
                                      (F.col("id") % 2).cast("string").alias("attr"))
    got = {r["attr"]: r["den_total"] for r in rate_by_dim(df, dim, "k", "k", "attr", "num", "den").collect()}
    assert sum(got.values()) == 30000


def test_profile_joins_stay_one_to_one_under_skew(spark):
    facts = skewed(spark)
    ent = spark.range(0, 1001).select(F.col("id").alias("k"))
    per = rate_by(facts, "k", "num", "den")
    prof = build_profile(ent, "k", facts=[per])
    assert prof.count() == 1001  # aggregated first: no fan-out on the hot key


def test_fk_orphans_hot_key(spark):
    child = skewed(spark)
    parent = spark.range(1, 1001).select(F.col("id").alias("k"))  # key 0 has no parent
    o = Q.fk_orphans(child, ForeignKey(("k",), "p", ("k",)), parent).collect()
    assert [(r["k"], r["rows"]) for r in o] == [(0, 10000)]
