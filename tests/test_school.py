import os

import pytest
from pyspark.sql import functions as F

from riskweave.operators import quality as Q
from riskweave.plans import school
from riskweave.sources import io
from riskweave.sources.schemas import SCHOOL, ForeignKey

from .school_fixture import tables, write


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    return write(str(tmp_path_factory.mktemp("bronze")))


def test_profile_edges(spark, bronze):
    b = school.read_bronze(spark, bronze)
    prof = {r["student_id"]: r for r in school.student_profile(b).collect()}
    assert 3 not in prof                                   # no grades → dropped (inner)
    assert prof[1]["low_income"] == 0.0 and prof[1]["high_distance"] == 0.0   # on thresholds
    assert prof[2]["low_income"] == 1.0 and prof[2]["high_distance"] == 1.0
    assert prof[1]["intervention_count"] == 0              # no interventions → 0
    assert prof[4]["absence_rate"] is None                 # zero classes offered
    assert prof[1]["dropout_date"] is None and prof[1]["dropout_reason"] is None
    assert prof[2]["dropout_label"] == 1.0 and str(prof[2]["dropout_date"]) == "2026-08-10"
    assert isinstance(prof[1]["food_insecurity_score"], float)
    assert prof[6]["status"] is None and prof[6]["dropout_label"] == 0.0   # NULL status
    assert sum(1 for r in school.student_profile(b).collect() if r["student_id"] == 5) == 2
    left = {r["student_id"] for r in school.student_profile(b, how="left").collect()}
    assert 3 in left


def test_subject_absences(spark, bronze):
    b = school.read_bronze(spark, bronze)
    got = {r["subject_name"]: r for r in school.subject_absences(b["attendance"], b["subjects"]).collect()}
    att = b["attendance"].groupBy("subject_id").agg(F.sum("absences").alias("a"),
                                                    F.sum("classes_offered").alias("o")).collect()
    tot = {r["subject_id"]: (r["a"], r["o"]) for r in att}
    assert got["Matematica"]["absences_total"] == tot[1][0]
    assert got["Matematica"]["classes_offered_total"] == tot[1][1]


def test_null_feature_is_reported_before_fit(spark, bronze):
    b = school.read_bronze(spark, bronze)
    with pytest.raises(ValueError, match="absence_rate"):
        school.score(school.student_profile(b))            # student 4 has a NULL rate


def test_full_run_publishes_all_datasets(spark, bronze, tmp_path):
    root = str(tmp_path / "out")
    # drop the zero-offered student so the model input has no NULL
    clean = write(str(tmp_path / "clean"), tables(drop_students=(4,)))
    res = school.run(spark, clean, root)
    assert 0.0 <= res["auc"] <= 1.0
    for layer, name in [("silver", "student_profile"), ("gold", "student_risk_scores"),
                        ("gold", "dropout_by_neighborhood"), ("gold", "subject_absences"),
                        ("gold", "dropout_reasons"), ("gold", "kpis")]:
        for fmt in ("parquet", "csv"):
            assert os.path.isdir(io.dataset_path(root, layer, name, fmt)), (layer, name, fmt)
    scores = io.read_dataset(spark, root, "gold", "student_risk_scores")
    assert scores.columns == list(school.SCORE_COLUMNS)
    k = io.read_dataset(spark, root, "gold", "kpis").first()
    hood = io.read_dataset(spark, root, "gold", "dropout_by_neighborhood")
    assert hood.agg(F.sum("students")).first()[0] == k["total_students"] == scores.count()
    assert hood.agg(F.sum("dropouts")).first()[0] == k["dropouts"]
    bands = {r["risk_band"] for r in scores.select("risk_band").distinct().collect()}
    assert bands <= {"Alto", "Medio", "Baixo"}
    reasons = io.read_dataset(spark, root, "gold", "dropout_reasons")
    assert reasons.agg(F.sum("students")).first()[0] == k["dropouts"]


def test_constraints_on_planted_violations(spark, bronze, tmp_path):
    b = school.read_bronze(spark, bronze)
    dup = b["students"].unionByName(b["students"].where(F.col("student_id") == 1))
    nul = b["socioeconomic"].withColumn(
        "household_size", F.when(F.col("student_id") == 2, None).otherwise(F.col("household_size")))
    orphan = b["grades"].unionByName(b["grades"].limit(1).withColumn("student_id", F.lit(999)))
    tables = {"students": dup, "socioeconomic": nul, "grades": orphan,
              "subjects": b["subjects"], "enrollments": b["enrollments"], "classes": b["classes"]}
    pk = {r["table_name"]: r for r in Q.pk_summary(tables, SCHOOL).collect()}
    assert pk["students"]["dup_keys"] == 1 and pk["students"]["dup_rows"] == 2
    assert pk["enrollments"]["dup_keys"] == 0
    nulls = {(r["table_name"], r["column_name"]): r["nulls"]
             for r in Q.null_summary(tables, SCHOOL).collect()}
    assert nulls[("socioeconomic", "household_size")] == 1
    assert nulls[("enrollments", "status")] == 1            # the planted NULL status
    assert ("enrollments", "dropout_reason") not in nulls   # nullable by declaration
    fk = {r["constraint_name"]: r for r in Q.fk_summary(tables, SCHOOL).collect()
          if r["child_table"] == "grades"}
    assert fk["student_id->students"]["orphan_rows"] == 1
    assert fk["subject_id->subjects"]["orphan_rows"] == 0
    assert isinstance(ForeignKey(("a",), "b", ("c",)).name, str)


def test_school_year_filter(spark, bronze):
    b = school.read_bronze(spark, bronze)
    assert school.student_profile(b, school_year=2026).count() == school.student_profile(b).count()
    assert school.student_profile(b, school_year=2025).count() == 0


def test_rule_risk_matches_original_formula(spark, bronze):
    b = school.read_bronze(spark, bronze)
    prof = school.rule_risk(school.student_profile(b)).where(F.col("absence_rate").isNotNull())
    weights = {"absence": 3.0, "deficit": 1.6, "works": 0.9, "offline": 0.8, "far": 0.6,
               "no_bus": 0.7, "hunger": 0.5, "engaged": -0.8}
    for r in prof.collect():
        x = {
            "absence": r["absence_rate"],
            "deficit": max(0.0, 6.0 - r["avg_grade"]) / 6.0,
            "works": float(r["works_after_school"] == 1),
            "offline": float(r["internet_access"] == 0),
            "far": float(r["distance_km"] > 8),
            "no_bus": float(r["transport_access"] == 0),
            "hunger": float(r["food_insecurity_score"] >= 4),
            "engaged": min(1.0, max(0.0, (r["platform_logins_total"] / 160.0
                                          + r["homework_submitted_total"] / 210.0) / 2.0)),
        }
        z = -3.1 + sum(w * x[k] for k, w in weights.items())
        assert abs(r["rule_risk"] - 1.0 / (1.0 + 2.71828 ** (-z))) < 1e-12


def test_targeting_rule(spark, bronze):
    b = school.read_bronze(spark, bronze)
    prof = school.rule_risk(school.student_profile(b))
    got = {r["student_id"] for r in school.targeted(prof).collect()}
    want = {r["student_id"] for r in prof.collect()
            if (r["rule_risk"] is not None and r["rule_risk"] > 0.35)
            or (r["absence_rate"] is not None and r["absence_rate"] > 0.22)
            or r["avg_grade"] < 5.8}
    assert got == want and 2 in got


def test_quality_report_all_tables(spark, bronze):
    rep = school.quality_report(spark, bronze)
    pk = {r["table_name"]: r["dup_keys"] for r in rep["pk"].collect()}
    assert set(pk) == set(school.ALL_TABLES) and pk["enrollments"] == 0
    fk = {(r["child_table"], r["constraint_name"]): r["orphan_rows"] for r in rep["fk"].collect()}
    assert fk[("attendance", "student_id->students")] == 0
    nulls = {(r["table_name"], r["column_name"]): r["nulls"] for r in rep["nulls"].collect()}
    assert nulls[("enrollments", "status")] == 1


G1_COLUMNS = [
    "student_id", "class_id", "name", "birth_date", "gender", "race_ethnicity", "neighborhood",
    "distance_km", "transport_access", "special_needs", "family_income_brl", "household_size",
    "internet_access", "receives_social_benefit", "works_after_school", "food_insecurity_score",
    "enrollment_id", "enrollment_date", "status", "dropout_date", "dropout_reason", "grade_level",
    "shift", "room", "school_year", "classes_offered_total", "absences_total", "absence_rate",
    "avg_grade", "recovery_exams", "platform_logins_total", "homework_submitted_total",
    "messages_to_teacher_total", "intervention_count", "dropout_label", "low_income",
    "high_distance", "no_transport", "no_internet", "works_flag", "benefit_flag"]


def test_dataset_columns_match_original_layout(spark, bronze, tmp_path):
    b = school.read_bronze(spark, bronze)
    assert school.student_profile(b).columns == G1_COLUMNS
    clean = write(str(tmp_path / "clean"), tables(drop_students=(4,)))
    root = str(tmp_path / "lake")
    school.run(spark, clean, root)
    expect = {
        "student_risk_scores": list(school.SCORE_COLUMNS),
        "dropout_by_neighborhood": ["neighborhood", "students", "dropouts", "avg_risk",
                                    "dropout_rate"],
        "subject_absences": ["subject_name", "classes_offered_total", "absences_total",
                             "absence_rate"],
        "dropout_reasons": ["dropout_reason", "students"],
        "kpis": ["total_students", "dropouts", "avg_dropout_risk", "avg_absence_rate",
                 "school_avg_grade", "model_auc"],
    }
    for name, cols in expect.items():
        assert io.read_dataset(spark, root, "gold", name).columns == cols, name
    assert len(school.SCORE_COLUMNS) == 21


def test_sql_over_registered_views(spark, bronze):
    views = school.register_views(spark, bronze, prefix="t_")
    assert "t_students" in views and "t_guardians" in views
    row = spark.sql("""
        SELECT count(DISTINCT s.student_id) AS n, sum(a.absences) AS absences
        FROM t_students s JOIN t_attendance a ON a.student_id = s.student_id
        WHERE s.neighborhood = 'Norte'""").first()
    b = school.read_bronze(spark, bronze)
    ids = [r["student_id"] for r in b["students"].where(F.col("neighborhood") == "Norte").collect()]
    want = b["attendance"].where(F.col("student_id").isin(ids)).agg(F.sum("absences")).first()[0]
    assert row["n"] == len(ids) and row["absences"] == want
    assert spark.sql("SELECT count(*) FROM t_guardians").first()[0] == 0   # absent → empty
