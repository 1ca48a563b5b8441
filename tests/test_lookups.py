"""Lookups and searches that read little, one-row joins, and the page's cube."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from riskweave.operators import cube, trigrams
from riskweave.operators import explore as X
from riskweave.operators.profile import build_profile, one_row_per
from riskweave.operators.quality import cardinality_report
from riskweave.sources import io, scan


# ------------------------------------------------------------------- scans
def test_clustered_lookup_reads_pages_not_the_table(spark, scratch):
    df = spark.range(60_000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"))
    path = io.publish(df, scratch, "gold", "t", sort_by=["k", "v"], page_rows=512)["parquet"]
    hits, read = scan.run_and_count(spark.read.parquet(path).where("k = 1234"))
    assert hits.count() == 20 and 20 <= read <= 4 * 512
    everything, read = scan.run_and_count(spark.read.parquet(path).where("v % 2 = 0"))
    assert everything.count() == 30_000 and read == 60_000
    none, read = scan.run_and_count(spark.read.parquet(path).where("k = 99999"))
    assert none.count() == 0 and read == 0


def test_scan_rows_through_a_shuffle(spark, scratch):
    path = io.publish(spark.range(5000), scratch, "gold", "t")["parquet"]
    _, read = scan.run_and_count(spark.read.parquet(path).groupBy((F.col("id") % 7).alias("g")).count())
    assert read == 5000


# ---------------------------------------------------------------- trigrams
NAMES = ["Anna Maria", "ANNABEL", "anna", "an", "", "Ölmann", "a(b)c.*", "xxxx", "xxx", "Joanna  May", "ann a", None]


@pytest.mark.parametrize("text", ["anna", "ANN", " xxx ", "b)c", ".*", "nn", "", "ölm", "zzz", "anna  m", "annam", "a ma"])
def test_index_equals_a_full_search(spark, scratch, text):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)] + [(None, "anna")], "key long, name string")
    trigrams.publish_index(df, scratch, "names", "name", "key")
    got = sorted(r.key for r in trigrams.search_index(spark, scratch, "names", text, df.where("key is not null")).collect())
    t = text.strip().lower()
    assert got == [i for i, n in enumerate(NAMES) if n is not None and t in n.lower()]


def test_short_text_needs_the_names(spark, scratch):
    df = spark.createDataFrame([(1, "anna")], "key long, name string")
    trigrams.publish_index(df, scratch, "names", "name", "key")
    with pytest.raises(ValueError):
        trigrams.search_index(spark, scratch, "names", "an")


def test_search_reads_the_rarest_run_only(spark, scratch):
    df = spark.range(20_000).select(F.col("id").alias("key"), F.concat(F.lit("customer "), F.md5(F.col("id").cast("string")))
                                    .alias("name"))
    trigrams.publish_index(df, scratch, "names", "name", "key")
    text = df.where("key = 777").first().name[5:15]  # begins with a run that every name holds
    found, read = scan.run_and_count(trigrams.search_index(spark, scratch, "names", text))
    assert 777 in {r.key for r in found.collect()}
    _, names = trigrams.rarest(spark, scratch, "names", text)
    assert names < 2000 and read <= names + 4 * trigrams.PAGE_ROWS


# ------------------------------------------------------------- guarded joins
def frames(spark):
    entity = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, name string")
    status = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (None, "p"), (None, "q")], "k long, status string")
    facts = spark.createDataFrame([(1, 5), (3, 7)], "k long, n int")
    return entity, status, facts


@pytest.mark.parametrize("group", ["entity", "attributes", "dimension", "facts", "sparse"])
def test_a_second_row_is_an_error(spark, group):
    entity, status, facts = frames(spark)
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, area int")
    sparse = spark.createDataFrame([(2, 1)], "k long, actions int")
    parts = {"entity": entity, "attributes": [status], "dimension": (dim, "name"), "facts": [facts], "sparse": [sparse]}

    def build(p, **kw):
        return build_profile(p["entity"], "k", attributes=p["attributes"], dimension=p["dimension"], facts=p["facts"],
                             sparse=p["sparse"], how="left", **kw)

    every = ("entity", "attributes", "dimension", "facts", "sparse")
    good = sorted((r.k, r.status, r.area, r.n, r.actions) for r in build(parts, check=every).collect())
    assert [g[0] for g in good] == [1, 2, 3] and good[1] == (2, "y", 2, None, 1)
    twice = {"entity": lambda p: p.unionByName(p.where("k = 2")), "attributes": lambda p: [p[0].unionByName(p[0].where("k = 2"))],
             "dimension": lambda p: (p[0].unionByName(p[0].where("area = 2")), p[1]),
             "facts": lambda p: [p[0].unionByName(p[0].where("k = 3"))], "sparse": lambda p: [p[0].unionByName(p[0])]}
    bad = {**parts, group: twice[group](parts[group])}
    with pytest.raises(PySparkException, match="has 2 rows for"):
        build(bad, check=every).collect()
    assert build(bad, check=[g for g in every if g != group]).count() == build(bad).count() == 4
    with pytest.raises(ValueError):
        build(parts, check=["other"])


def test_one_row_per_keeps_rows_and_types(spark):
    _, status, _ = frames(spark)
    out = one_row_per(status, "k", "status")
    assert out.dtypes == status.dtypes
    assert {(r.k, r.status) for r in out.where("k is not null").collect()} == {(1, "x"), (2, "y"), (3, None)}
    assert one_row_per(status.select("k").where("k = 1"), "k", "keys").collect()[0].k == 1


def test_the_check_adds_no_shuffle_to_a_sort_merge_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).withColumnRenamed("id", "k")
        b = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("s"))
        plans = [a.join(x, "k")._jdf.queryExecution().executedPlan().toString() for x in (b, one_row_per(b, "k", "b"))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 2]


def test_cardinality_report(spark):
    entity, status, facts = frames(spark)
    got = {r.frame: (r.keys, r.rows) for r in cardinality_report(
        {"status": status, "facts": facts.unionByName(facts).unionByName(facts.where("k = 1"))}, "k").collect()}
    assert got == {"status": (0, 0), "facts": (2, 5)}


# -------------------------------------------------------------------- cube
def scored(spark, n=2000, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["Alto", "Baixo", None]), rng.choice("NSEW"), rng.choice(["p", "q"]),
             None if rng.random() < 0.05 else round(rng.random(), 4), None if rng.random() < 0.05 else round(rng.random(), 4),
             round(rng.random() * 10, 2), rng.choice(["lapsed", "active"]), rng.choice(["train", "test"]), rng.randrange(9))
            for _ in range(n)]
    return spark.createDataFrame(rows, "band string, region string, segment string, risk double, rate double, mark double, "
                                       "status string, split string, actions long")


FACETS = ("band", "region", "segment")


def made(s):
    return cube.page_cube(s, FACETS, "risk", "rate", "mark", F.col("status") == "lapsed", F.col("split") == "test",
                          {"actions": F.col("actions")}).cache()


def test_cube_answers_any_filter(spark):
    s = scored(spark)
    c = made(s)
    rng = random.Random(5)
    for _ in range(4):
        isin = {"band": rng.sample(["Alto", "Baixo"], rng.choice([1, 2])), "region": rng.sample("NSEW", 2)}
        step = rng.randrange(100)
        got = cube.cube_sums(c, cube.cube_filter(isin, step), ["actions"]).first()
        cond = X.extract_predicate(isin=isin, at_least={"rate": step / 100})
        want = s.agg(F.count(F.lit(1)).alias("n"), F.count_if(cond).alias("f"), F.sum(F.when(cond, F.col("actions"))).alias("a")).first()
        assert (got.n_total, got.n_filtered, got.actions) == (want.n, want.f, want.a or 0)


def test_cube_equals_the_direct_operators(spark):
    s = scored(spark)
    c = made(s)
    direct = s.groupBy("risk", "band").agg(F.count(F.lit(1)).alias("rows"))
    a = X.weighted_histogram(cube.cube_counts(c, "band"), "risk", "rows", by="band")
    b = X.weighted_histogram(direct, "risk", "rows", by="band")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    a = cube.cube_facets(c, FACETS, descending=["band"])
    assert sorted(map(str, a.collect())) == sorted(map(str, X.facets(s, FACETS, descending=["band"]).collect()))
    k = cube.cube_kpis(c, {"rows": "n", "positives": "p", "score": "r", "rate": "m", "mark": "g", "auc": "a"}).first()
    want = s.agg(F.count(F.lit(1)), F.count_if(F.col("status") == "lapsed"), F.avg("risk"), F.avg("rate"), F.avg("mark")).first()
    assert (k.n, k.p) == tuple(want[:2])
    assert abs(k.r - want[2]) <= 6e-5 and abs(k.m - want[3]) <= 6e-5 and abs(k.g - want[4]) <= 6e-3
    rows = [(r.risk, r.status == "lapsed") for r in s.where("split = 'test' and risk is not null").collect()]
    pos, neg = [r for r, y in rows if y], [r for r, y in rows if not y]
    assert abs(k.a - sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))) <= 6e-5


def test_cube_of_no_rows(spark):
    c = made(scored(spark).limit(0))
    assert cube.cube_kpis(c, {"rows": "n", "positives": "p", "score": "r", "rate": "m", "mark": "g", "auc": "a"}).first().n == 0
    assert cube.cube_sums(c, cube.cube_filter({"band": ["Alto"]}), ["actions"]).first().n_filtered == 0
    assert cube.cube_facets(c, FACETS).count() == 0


def test_cube_size_does_not_depend_on_the_rows(spark):
    small, large = made(scored(spark, 500)), made(scored(spark, 500).unionByName(scored(spark, 500)).unionByName(scored(spark, 500)))
    assert small.count() == large.count()
