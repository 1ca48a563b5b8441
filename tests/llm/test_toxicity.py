import random

import numpy as np
from tests.llm.data import docs

from riskweave.llm.toxicity import in_fold, toxicity, train_nnpu


def sample(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        w = [f"plain{rng.randrange(300)}" for _ in range(rng.randrange(5, 80))]
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Vileness", "nasty!", "grubby"]))
        rows.append((i, " ".join(w)))
        if rng.random() < 0.7:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_edge_rows(spark):
    rows, labels = sample(900)
    extra = [(5000, None), (5001, ""), (None, "nasty vileness grubby"), (None, None), rows[0]]
    lab = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity(docs(spark, rows + extra), lab).collect()
    assert len(got) == len(rows) + len(extra)
    toxic = {i for i, _, t in labels if t}
    known = {i for i, _, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in known]
    right = sum((r.doc_id in toxic) == (r.predicted == 1) for r in held)
    assert len(held) > 50 and right / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    clean = [r for r in got if r.doc_id in (5000, 5001)]
    assert [r.predicted for r in clean] == [0, 0]
    assert {r.predicted for r in got if r.doc_id is None} == {0, 1}


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows, labels = sample(200, 2)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn(
        "out", in_fold("doc_id", 5, 0))
    flipped = lab.selectExpr("doc_id", "quality", "if(out, 1 - toxic, toxic) as toxic")
    a, b = (sorted(map(tuple, toxicity(docs(spark, rows), x).collect())) for x in (lab, flipped))
    assert a == b


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(docs(spark, []), none).count() == 0
    assert [r.predicted for r in toxicity(docs(spark, [(1, "x")]), none).collect()] == [0]


def test_negative_risk_is_corrected():
    # unlabelled texts hold the positives' feature as often as the prior says
    pos = [np.array([1, 2], np.int32)] * 40
    unl = [np.array([1, 2], np.int32)] * 40 + [np.array([3], np.int32)] * 160
    w = train_nnpu(pos, unl, 0.2, 0)
    assert w[1] + w[2] + w[-1] > 0 > w[3] + w[-1]
