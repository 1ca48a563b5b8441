"""Property tests: engine-independent number rules vs exact decimal arithmetic."""

import math
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave import functions as RF

pairs = st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=200)


@settings(max_examples=6, deadline=None)
@given(pairs)
def test_ratio_half_up_is_decimal_half_up(spark, rows):
    rows = [(min(n, d * 3), d) for n, d in rows]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", RF.ratio_half_up("n", "d", 4).alias("r")).collect()
    for r in got:
        exact = Fraction(r["n"], r["d"])
        want = math.floor(exact * 10000 + Fraction(1, 2)) / 10000  # true half-up
        assert r["r"] == want, (r["n"], r["d"], r["r"], want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 10000), min_size=1, max_size=200))
def test_percent_texts_match_decimal_formatting(spark, units):
    # inputs already rounded to 4 places, as published risks are
    df = spark.createDataFrame([(u / 10000,) for u in units], "x double")
    got = df.select("x", RF.percent_text("x", 1).alias("p1"),
                    RF.short_percent_text("x").alias("p2")).collect()
    for r in got:
        d = Decimal(repr(r["x"])) * 100
        assert r["p1"] == f"{d.quantize(Decimal('0.1'), ROUND_HALF_UP)}%"
        short = d.quantize(Decimal("0.01"), ROUND_HALF_UP).normalize()
        text = format(short, "f")
        if "." not in text:
            text += ".0"
        assert r["p2"] == text + "%"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=100), st.integers(20, 40))
def test_histogram_bins_cover_unit_interval(spark, units, bins):
    from riskweave.operators.explore import histogram
    df = spark.createDataFrame([(u / 10_000,) for u in units], "r double")
    h = histogram(df, "r", bins).collect()
    assert sum(r["entities"] for r in h) == len(units)
    for r in h:
        # the bin's edges as exact fractions
        lo, hi = Fraction(r["bin"], bins), Fraction(r["bin"] + 1, bins)
        members = [u for u in units if lo <= Fraction(u, 10_000) < hi or (u == 10_000 and r["bin"] == bins - 1)]
        assert len(members) == r["entities"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 10000)),
                min_size=1, max_size=150))
def test_box_matches_numpy_percentiles(spark, rows):
    import numpy as np
    from riskweave.operators.explore import box
    df = spark.createDataFrame([(g, u / 10000) for g, u in rows], "g string, v double")
    got = {r["g"]: r for r in box(df, "v", "g").collect()}
    for g in {g for g, _ in rows}:
        vals = [u / 10000 for gg, u in rows if gg == g]
        for name, p in (("q1", 25), ("median", 50), ("q3", 75)):
            assert abs(got[g][name] - float(np.percentile(vals, p))) < 1e-9, (g, name)
        assert got[g]["n"] == len(vals) and got[g]["min"] == min(vals)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 1)), min_size=2, max_size=200))
def test_auc_exact_matches_pairwise_on_random_data(spark, rows):
    from riskweave.operators.risk import auc_exact
    pairs = [(s / 50, y) for s, y in rows]
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    df = spark.createDataFrame(pairs, "s double, y int")
    got = auc_exact(df, "s", "y").first()["auc"]
    if not pos or not neg:
        assert got is None
        return
    want = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    assert abs(got - want / (len(pos) * len(neg))) < 1e-12
