import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import explore as X
from riskweave.plans import school_views as D
from riskweave.plans import school
from riskweave.sources import io

from .school_fixture import tables, write


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    # drop the zero-offered student: a NULL rate would stop the model fit
    bronze = write(str(tmp_path_factory.mktemp("bronze")), tables(drop_students=(4,)))
    root = str(tmp_path_factory.mktemp("lake"))
    school.run(spark, bronze, root, seed=2026)
    return bronze, root


def test_gold_and_manifest(spark, lake):
    bronze, root = lake
    g = D.load_gold(spark, root)
    assert set(g) == set(D.GOLD)
    pop = D.population(spark, g["student_risk_scores"], f"{root}/run_metadata").first()
    assert pop["students"] == io.read_table(spark, bronze, "students", fmt="csv").count()
    params = D.page_params(D.population(spark, g["student_risk_scores"],
                                        f"{root}/run_metadata")).first()
    assert (params["top_n"], params["bins"]) == (20, 20)
    missing = D.population(spark, g["student_risk_scores"], f"{root}/none").first()
    assert missing["students"] == g["student_risk_scores"].count()
    m = io.read_manifest(spark, f"{root}/run_metadata", school.MANIFEST_SCHEMA).first()
    assert m["seed"] == 2026 and m["grades_rows"] > 0


def test_filters_search_and_tables(spark, lake):
    _, root = lake
    g = D.load_gold(spark, root)
    s = g["student_risk_scores"]
    all_rows = D.filtered(s, min_absence=0.0)
    assert all_rows.count() == s.count()
    f = D.filtered(s, bands=["Alto", "Medio"], min_absence=0.10)
    assert f.where(~F.col("risk_band").isin("Alto", "Medio") | (F.col("absence_rate") < 0.10)).count() == 0
    assert [r["student_id"] for r in D.filtered(s, min_absence=0, search=" (filha").collect()] == [2]
    hits = D.filtered(s, min_absence=0, search="5").collect()
    assert hits and all(r["student_id"] == 5 or "5" in r["name"] for r in hits)
    n = D.population(spark, s, None).first()["students"]
    top = X.adaptive_params(s).first()["top_n"]
    p = D.priority_table(D.filtered(s, min_absence=0), top).collect()
    assert len(p) == min(top, n) and p[0]["dropout_risk"].endswith("%")
    sc = D.scatter(D.filtered(s, min_absence=0)).collect()
    risks = [r["dropout_risk"] for r in sc]
    assert risks == sorted(risks, reverse=True)
    cards = D.kpi_cards(g["kpis"]).first()
    assert cards["mean_risk"].endswith("%") and len(cards["model_auc"].split(".")[1]) == 3
    hist = D.risk_histogram(s, 20).agg(F.sum("students")).first()[0]
    assert hist == s.count()
    box = {r["risk_band"]: r for r in D.risk_box(s).collect()}
    for band, r in box.items():
        vals = [x["dropout_risk"] for x in s.where(F.col("risk_band") == band).collect()]
        assert r["median"] == pytest.approx(float(np.percentile(vals, 50)), abs=1e-9)
    shares = D.reason_shares(g["dropout_reasons"]).agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1.0, abs=1e-3)
    assert D.top_subjects(g["subject_absences"]).count() == 2
    assert D.top_neighborhoods(g["dropout_by_neighborhood"]).count() <= 20
    facets = {r["facet"] for r in D.facet_options(s).collect()}
    assert facets == {"risk_band", "shift", "grade_level"}


def test_student_detail(spark, lake):
    bronze, root = lake
    s = D.load_gold(spark, root)["student_risk_scores"]
    d = D.student_detail(s, D.load_bronze(spark, bronze), 2)
    assert d["score"].count() == 1 and d["student"].first()["name"].startswith("Joana")
    att = d["absences_by_subject"].collect()
    assert {r["subject_name"] for r in att} == {"Matematica", "Portugues"}
    assert [r["total_absences"] for r in att] == sorted((r["total_absences"] for r in att), reverse=True)
    grd = d["grades_by_subject"].collect()
    assert all(r["avg_grade"] == 4.5 for r in grd)
    assert os.path.isdir(io.dataset_path(root, "gold", "kpis", "csv"))


def test_pretty_printed_manifest(spark, tmp_path):
    import json
    path = tmp_path / "run_metadata.json"
    path.write_text(json.dumps({"students_count": 2500, "seed": 2026,
                                "generated_at": "2026-01-01T00:00:00+00:00",
                                "attendance_rows": 200000, "grades_rows": 80000}, indent=2))
    m = io.read_manifest(spark, str(path), school.MANIFEST_SCHEMA).first()
    assert (m["students_count"], m["grades_rows"]) == (2500, 80000)
    scores = spark.createDataFrame([(1,), (2,)], "student_id long")
    assert D.population(spark, scores, str(path)).first()["students"] == 2500


def test_student_detail_from_published_table_equals_bronze(spark, lake):
    bronze, root = lake
    s = D.load_gold(spark, root)["student_risk_scores"]
    detail = io.read_dataset(spark, root, "gold", D.DETAIL)
    b = D.load_bronze(spark, bronze)
    for sid in (1, 2, 100, 159):
        a = D.student_detail(s, b, sid)
        g = D.student_detail(s, b, sid, detail=detail)
        for part in ("absences_by_subject", "grades_by_subject"):
            cols = a[part].columns
            assert [tuple(r) for r in a[part].collect()] == \
                   [tuple(r) for r in g[part].select(*cols).collect()], (sid, part)
