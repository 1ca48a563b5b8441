import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import risk as R


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = 0.0
    for p in pos:
        for n in neg:
            tot += 1.0 if p > n else 0.5 if p == n else 0.0
    return tot / (len(pos) * len(neg))


def test_auc_exact_matches_pairwise(spark):
    pairs = [(round((i * 37 % 101) / 100, 2), 1 if (i * 7) % 5 < 2 else 0) for i in range(120)]
    df = spark.createDataFrame(pairs, "s double, y int")
    got = R.auc_exact(df, "s", "y").first()["auc"]
    assert abs(got - brute_auc(pairs)) < 1e-12


def test_auc_exact_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert R.auc_exact(df, "s", "y").first()["auc"] is None


def test_rule_score_formula(spark):
    df = spark.createDataFrame([(0.2, 1.0)], "a double, b double")
    got = R.rule_score(df, -1.0, [("a", 2.0), (F.col("b"), -0.5)], out="p").first()["p"]
    assert abs(got - 1 / (1 + math.exp(-(-1.0 + 0.4 - 0.5)))) < 1e-15


def test_hash_split_independent_of_partitioning(spark):
    base = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in R.hash_split(base.repartition(1), "k").collect()}
    b = {r["k"]: r["split"] for r in R.hash_split(base.repartition(7), "k").collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.75 < share < 0.85


def test_model_fit_and_score(spark):
    rows = [(i, float(i % 10) / 10, float((i * 3) % 7), 1.0 if (i % 10) >= 6 else 0.0)
            for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y double")
    data = R.assemble(R.hash_split(df, "id"), ["x1", "x2"])
    model = R.fit_logistic(data.where(F.col("split") == "train"), label="y", max_iter=50)
    pred = R.score_model(model, data, out="p")
    assert pred.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    auc = R.auc_evaluator(pred.where(F.col("split") == "test"), label="y")
    assert auc > 0.9
    assert R.null_feature_counts(df, ["x1", "x2"]) == {"x1": 0, "x2": 0}


def test_model_scores_are_logistic_of_coefficients(spark):
    rows = [(i, float(i % 7) / 7, float((i * 5) % 11), 1.0 if (i * 3) % 10 >= 6 else 0.0)
            for i in range(150)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y double")
    data = R.assemble(df, ["x1", "x2"])
    model = R.fit_logistic(data, label="y", max_iter=50)
    w, b = model.coefficients.toArray(), model.intercept
    for r in R.score_model(model, data, out="p").select("x1", "x2", "p").collect():
        z = b + w[0] * r["x1"] + w[1] * r["x2"]
        assert abs(r["p"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_degenerate_evaluation_gives_null_auc(spark):
    from riskweave.operators import indicators as IND
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)], "id long, x double, y double")
    data = R.assemble(df, ["x"])
    two = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 1.0)], "id long, x double, y double")
    model = R.fit_logistic(R.assemble(two, ["x"]), label="y", max_iter=5)
    pred = R.score_model(model, data, out="p")
    assert math.isnan(R.auc_evaluator(pred, label="y"))              # one class only
    assert math.isnan(R.auc_evaluator(pred.limit(0), label="y"))     # no rows
    scored = spark.createDataFrame([("a", 0.5, 0.1, 6.0)], "status string, risk double, "
                                   "miss_rate double, avg_mark double")
    k = IND.kpis(scored, "status", "a", auc=float("nan")).first()
    assert k["model_auc"] is None


@pytest.mark.parametrize("seed, ties", [(0, False), (1, True), (2, True)])
def test_auc_ranked_equals_pair_counting(spark, seed, ties):
    rng = random.Random(seed)
    rows = [(round(rng.random(), 1) if ties else rng.random(), int(rng.random() < 0.4)) for _ in range(300)]
    rows += [(0.5, int(i % 3 == 0)) for i in range(400)]  # one score holds more than half of all rows
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame([*rows, (None, 1), (0.3, None)], "score double, y int")
    for parts in (1, 7):
        assert R.auc_ranked(df, "score", "y", partitions=parts).first().auc == expected


def test_auc_ranked_needs_both_classes(spark):
    for rows in ([], [(0.1, 1), (0.2, 1)], [(0.1, 0)]):
        assert R.auc_ranked(spark.createDataFrame(rows, "score double, y int"), "score", "y").first().auc is None


def test_auc_ranked_equals_the_evaluator(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.random(), float(rng.random() < 0.3)) for _ in range(900)], "score double, label double")
    assert abs(R.auc_ranked(df, "score", "label").first().auc - R.auc_evaluator(df, raw="score")) < 1e-9


def test_a_model_scores_after_a_metric_was_observed(spark, scratch):
    from riskweave.sources import io

    io.write_counted(spark.range(5), scratch, "bronze", "t")
    rng = random.Random(6)
    df = spark.createDataFrame([(rng.random(), float(rng.random() < 0.4)) for _ in range(200)], "x double, label double")
    data = R.assemble(df, ["x"])
    scored = R.score_model(R.fit_logistic(data), data)
    assert scored.where("risk between 0 and 1").count() == 200 and 0 <= R.auc_evaluator(scored) <= 1
