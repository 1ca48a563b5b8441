import math

import pytest
from pyspark.sql import functions as F

from riskweave.operators import explore as X
from riskweave.operators import quality as Q
from riskweave.operators.aggregates import avg_by, count_by, rate_by, rate_by_dim, sum_by
from riskweave.operators.profile import FlagRule, add_flags, build_profile, label
from riskweave.sources.schemas import ForeignKey


def test_rate_by_zero_offered_is_null(spark):
    df = spark.createDataFrame([(1, 10, 1), (1, 10, 0), (2, 0, 0)], "k long, den int, num int")
    got = {r["k"]: r for r in rate_by(df, "k", "num", "den").collect()}
    assert got[1]["num_total"] == 1 and got[1]["den_total"] == 20 and got[1]["rate"] == 0.05
    assert got[2]["rate"] is None


def test_rate_by_dim_matches_brute_force(spark):
    facts = spark.createDataFrame([(i % 7, i % 3, 5) for i in range(200)], "fk long, num int, den int")
    dim = spark.createDataFrame([(k, "even" if k % 2 == 0 else "odd") for k in range(7)],
                                "k long, attr string")
    got = {r["attr"]: r for r in rate_by_dim(facts, dim, "fk", "k", "attr", "num", "den").collect()}
    for attr in ("even", "odd"):
        rows = [(i % 7, i % 3, 5) for i in range(200) if ((i % 7) % 2 == 0) == (attr == "even")]
        n, d = sum(r[1] for r in rows), sum(r[2] for r in rows)
        assert got[attr]["num_total"] == n and got[attr]["den_total"] == d
        assert got[attr]["rate"] == math.floor(n / d * 10000 + 0.5) / 10000 or \
            abs(got[attr]["rate"] - n / d) < 1e-4


def test_avg_by_preaggregated_equals_raw(spark):
    raw = spark.createDataFrame([(1, 3.0), (1, 4.0), (1, 8.0), (2, 5.0)], "k long, v double")
    a = {r["k"]: r["avg"] for r in avg_by(raw, "k", value="v").collect()}
    pre = raw.groupBy("k", (F.col("v") > 4).alias("g")).agg(F.sum("v").alias("s"),
                                                            F.count("v").alias("n"))
    b = {r["k"]: r["avg"] for r in avg_by(pre, "k", sum_col="s", count_col="n").collect()}
    assert a == b == {1: 5.0, 2: 5.0}


def test_sum_and_count_by(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 4, 5), (2, 1, 1)], "k long, a int, b int")
    s = {r["k"]: (r["a_total"], r["b_total"]) for r in sum_by(df, "k", ["a", "b"]).collect()}
    assert s == {1: (6, 8), 2: (1, 1)}
    c = {r["k"]: r["count"] for r in count_by(df, "k").collect()}
    assert c == {1: 2, 2: 1}


def test_profile_inner_drops_missing_facts_left_keeps(spark):
    ent = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "id long, d long")
    attr = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, status string")
    dim = spark.createDataFrame([(10, "X"), (20, "Y")], "d long, dname string")
    fact = spark.createDataFrame([(1, 5), (3, 7)], "id long, total long")
    sparse = spark.createDataFrame([(1, 2)], "id long, n long")
    inner = build_profile(ent, "id", attributes=[attr], dimension=(dim, "d"), facts=[fact],
                          sparse=[sparse], fill={"n": 0})
    assert sorted((r["id"], r["n"]) for r in inner.collect()) == [(1, 2), (3, 0)]
    left = build_profile(ent, "id", attributes=[attr], dimension=(dim, "d"), facts=[fact],
                         how="left", sparse=[sparse], fill={"n": 0})
    got = {r["id"]: (r["total"], r["n"]) for r in left.collect()}
    assert got == {1: (5, 2), 2: (None, 0), 3: (7, 0)}


def test_profile_fans_out_on_duplicate_attribute(spark):
    ent = spark.createDataFrame([(1,)], "id long")
    enr = spark.createDataFrame([(1, "x"), (1, "y")], "id long, e string")
    assert build_profile(ent, "id", attributes=[enr]).count() == 2


def test_flags_and_label(spark):
    df = spark.createDataFrame([("Evadido", 2200.0, 3), (None, 100.0, 0)],
                               "status string, income double, works int")
    out = add_flags(label(df, "status", "Evadido", "y"),
                    [FlagRule("income", "lt", 2200, "low"), FlagRule("works", "double", None, "w")])
    rows = out.collect()
    assert [(r["y"], r["low"], r["w"]) for r in rows] == [(1.0, 0.0, 3.0), (0.0, 1.0, 0.0)]


def test_search_literal_and_regex(spark):
    df = spark.createDataFrame([(1, "Joana (Filha)"), (2, "Júlia Souza"), (12, "Ana")],
                               "id long, name string")
    assert [r["id"] for r in X.search(df, " (FILHA ", "name", "id").collect()] == [1]
    assert [r["id"] for r in X.search(df, "júlia", "name", "id").collect()] == [2]
    assert [r["id"] for r in X.search(df, "12", "name", "id").collect()] == [12]
    assert sorted(r["id"] for r in X.search(df, "^j", "name", "id", regex=True).collect()) == [1, 2]
    assert X.search(df, "   ", "name", "id").count() == 3


def test_top_n_ties_broken_by_key(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.9), (4, 0.1)], "id long, r double")
    assert [r["id"] for r in X.top_n(df, "r", 3, "id").collect()] == [2, 1, 3]


def test_histogram_upper_edge_in_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.999,), (1.0,)], "r double")
    got = {r["bin"]: r["entities"] for r in X.histogram(df, "r", 20).collect()}
    assert got == {0: 1, 1: 1, 19: 2}


def test_box_matches_linear_interpolation(spark):
    import numpy as np
    vals = [0.1, 0.2, 0.2, 0.35, 0.5, 0.9, 0.91]
    df = spark.createDataFrame([("a", v) for v in vals] + [("b", 0.3)], "g string, v double")
    got = {r["g"]: r for r in X.box(df, "v", "g").collect()}
    for name, p in (("q1", 25), ("median", 50), ("q3", 75)):
        assert got["a"][name] == pytest.approx(float(np.percentile(vals, p)), abs=1e-9)
    assert (got["a"]["min"], got["a"]["max"], got["a"]["n"]) == (0.1, 0.91, 7)
    assert got["b"]["median"] == 0.3 and got["b"]["q1"] == 0.3


def test_filter_share_and_empty(spark):
    df = spark.createDataFrame([(0.05,), (0.10,), (0.2,)], "rate double")
    r = X.filter_share(df, X.extract_predicate(at_least={"rate": 0.10})).first()
    assert (r["n_total"], r["n_filtered"], r["filter_share"], r["share_text"]) == (3, 2, 0.6667, "66.7%")
    e = X.filter_share(df.limit(0), F.lit(True)).first()
    assert (e["n_total"], e["filter_share"], e["share_text"]) == (0, None, "-")


def test_adaptive_params(spark):
    for n, top, bins in ((10, 20, 20), (2500, 100, 25), (100000, 200, 40)):
        r = X.adaptive_params(spark.range(n)).first()
        assert (r["entities"], r["top_n"], r["bins"]) == (n, top, bins)


def test_facets(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "x"), ("A", "y")], "band string, s string")
    got = sorted(tuple(r) for r in X.facets(df, ["band", "s"], descending=["band"]).collect())
    assert got == [("band", 1, "B"), ("band", 2, "A"), ("s", 1, "x"), ("s", 2, "y")]


def test_quality_planted_violations(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, 3), (13, None)], "id long, k long")
    d = Q.pk_violations(parent, ["k"]).collect()
    assert [(r["k"], r["rows"]) for r in d] == [(2, 2)]
    nulls = {r["column_name"]: r["nulls"] for r in Q.null_counts(parent, ["k", "v"], "p").collect()}
    assert nulls == {"k": 1, "v": 0}
    o = Q.fk_orphans(child, ForeignKey(("k",), "p", ("k",)), parent).collect()
    assert [(r["k"], r["rows"]) for r in o] == [(3, 2)]


def test_fk_summary_without_a_parent_is_an_error(spark):
    child = spark.createDataFrame([(1,)], "k long")
    from riskweave.sources.schemas import DRIVER
    with pytest.raises(ValueError, match="orders"):
        Q.fk_summary({"lineitem": child}, DRIVER)


def test_histogram_edges_fall_into_the_upper_bin(spark):
    df = spark.range(10_001).select((F.col("id") / 10_000).alias("v"))
    for bins in (20, 26, 40):
        got = {r["bin"]: r["entities"] for r in X.histogram(df, "v", bins).collect()}
        want = {}
        for u in range(10_001):
            b = min(u * bins // 10_000, bins - 1)
            want[b] = want.get(b, 0) + 1
        assert got == want
        edge = X.histogram(df.where("v in (0.15, 0.3, 0.7)"), "v", bins).collect()
        assert sum(r["entities"] for r in edge if r["bin_lo"] <= 0.7 < r["bin_hi"]) >= 1


def test_auc_of_large_populations(spark):
    from riskweave.operators import risk as R
    big = 3_000_000_000
    h = spark.createDataFrame([(0.2, 0, big), (0.7, big, 0)], "score_value double, pos long, neg long")
    orig = R.score_histogram
    R.score_histogram = lambda *a, **k: h
    try:
        assert R.auc_exact(h, "score_value", "pos").first()["auc"] == 1.0
    finally:
        R.score_histogram = orig


def _plotted(values):
    """Quartiles, whisker ends and outliers of sorted values, place by place."""
    v, n = sorted(values), len(values)

    def at(p):
        k = p * n - 0.5
        if k < 0 or k > n - 1:
            return v[0] if k < 0 else v[-1]
        lo, hi = v[math.floor(k)], v[math.ceil(k)]
        return lo + (k - math.floor(k)) * (hi - lo)

    q1, q3 = at(0.25), at(0.75)
    lo, hi = round(q1 - 1.5 * (q3 - q1), 6), round(q3 + 1.5 * (q3 - q1), 6)
    return (round(q1, 6), round(at(0.5), 6), round(q3, 6), min(q1, min(x for x in v if x >= lo)),
            max(q3, max(x for x in v if x <= hi)), sorted(x for x in v if x < lo or x > hi))


@pytest.mark.parametrize("values", [
    [0.5], [0.1, 0.9], [0.2] * 7, [0.0, 0.0001, 1.0], [k / 100 for k in range(40, 60)] + [0.0, 0.01, 0.99, 0.99, 1.0],
    [0.3, 0.3, 0.3, 0.31, 0.32, 0.9]])
def test_box_drawn(spark, values):
    rows = [("g", x) for x in values] + [(None, 0.4), ("g", None)]
    counts = X.score_counts(spark.createDataFrame(rows, "band string, risk double"), "risk", "band")
    box = X.box_drawn(counts, "band")
    got = {r.band: r for r in box.collect()}
    q1, median, q3, lo, hi, out = _plotted(values)
    g = got["g"]
    assert (g.q1, g.median, g.q3, g.n) == (q1, median, q3, len(values))
    assert (round(g.whisker_lo, 6), round(g.whisker_hi, 6)) == (round(lo, 6), round(hi, 6))
    assert g.outliers_lo + g.outliers_hi == len(out)
    points = [r.value for r in X.box_outliers(counts, box, "band").collect() for _ in range(r.rows)]
    assert sorted(points) == out
    assert got[None].n == 1 and got[None].whisker_lo == got[None].whisker_hi == 0.4
