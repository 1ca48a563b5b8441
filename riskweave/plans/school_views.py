"""The exploration tables of the original application's page, on the school gold tables.

Each function returns a small DataFrame (or a dict of them); nothing is
rendered.  Inputs are the published datasets of ``plans.school.run``:

* ``load_gold``            the five gold tables (missing → AnalysisException)
* ``load_bronze``          optional bronze tables for the detail panel
* ``population``           students generated: manifest count, else score rows
* ``page_params``          default top-N and histogram bins from that count
* ``filtered``             band / shift / grade sets, min absence rate, search
* ``kpi_cards``            headline numbers as display text
* ``risk_histogram`` / ``risk_box``   unfiltered score distribution by band
* ``top_neighborhoods`` / ``top_subjects`` / ``reason_shares``   chart data
* ``scatter`` / ``priority_table``    first rows of the filtered scores
* ``student_detail``       one student: score row, bronze rows, absences and
                           mean grade per subject
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import percent_text, short_percent_text, thousands_text
from riskweave.operators import explore as X
from riskweave.operators import indicators as IND
from riskweave.plans import school
from riskweave.sources import io, versions

# Fixed values of the original page: datasets read, columns shown, defaults.
GOLD = ("student_risk_scores", "dropout_by_neighborhood", "subject_absences",
        "dropout_reasons", "kpis")
DETAIL = "student_subject_detail"   # published by ``school.run(detail=True)``
DETAIL_BRONZE = ("students", "socioeconomic", "attendance", "grades", "subjects")
PRIORITY_COLUMNS = ("student_id", "name", "grade_level", "shift", "neighborhood",
                    "dropout_risk", "risk_band", "absence_rate", "avg_grade", "distance_km",
                    "internet_access", "works_after_school", "intervention_count")
DEFAULT_MIN_ABSENCE = 0.10
TOP_NEIGHBORHOODS, TOP_SUBJECTS, SCATTER_ROWS = 20, 15, 1000


def load_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The gold datasets; of the current version, where ``root`` holds versions."""
    root = versions.resolve(spark, root)
    return {n: io.read_dataset(spark, root, "gold", n) for n in GOLD}


def load_bronze(spark: SparkSession, bronze: str) -> dict[str, DataFrame]:
    return {n: io.read_table(spark, bronze, n, fmt="csv", on_missing="empty")
            for n in DETAIL_BRONZE}


def population(spark: SparkSession, scores: DataFrame, manifest_path: str | None) -> DataFrame:
    """One row ``students``: the manifest's count, or the score rows when the
    manifest is missing, corrupt or lacks the field."""
    m = (io.read_manifest(spark, manifest_path, school.MANIFEST_SCHEMA) if manifest_path
         else spark.createDataFrame([], school.MANIFEST_SCHEMA))
    # one aggregate over the union: score rows count 1 each, the manifest row
    # (if any) contributes its stated count
    rows = scores.select(F.lit(1).alias("_one"), F.lit(None).cast("long").alias("_stated"))
    stated = m.select(F.lit(0).alias("_one"), F.col("students_count").alias("_stated"))
    agg = rows.unionByName(stated).agg(F.count_if(F.col("_one") == 1).alias("_rows"),
                                       F.max("_stated").alias("_stated"))
    return agg.select(F.coalesce("_stated", "_rows").alias("students"))


def page_params(pop: DataFrame) -> DataFrame:
    """Default top-N and histogram bins from the population (``population``)."""
    return X.adaptive_params(pop, count_col="students")


def filtered(scores: DataFrame, bands: Sequence[str] | None = None,
             shifts: Sequence[str] | None = None, grades: Sequence[str] | None = None,
             min_absence: float = DEFAULT_MIN_ABSENCE, search: str = "",
             regex: bool = False) -> DataFrame:
    """The page's global filter; ``None`` for a set means "all values"."""
    isin = {c: v for c, v in (("risk_band", bands), ("shift", shifts), ("grade_level", grades))
            if v is not None}
    cond = X.extract_predicate(isin, {"absence_rate": min_absence})
    cond = cond & X.search_predicate(search, "name", "student_id", regex)
    return scores.where(cond)


def facet_options(scores: DataFrame) -> DataFrame:
    return X.facets(scores, ["risk_band", "shift", "grade_level"], descending=["risk_band"])


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """Monitored, dropouts (thousands text), mean risk (``.1%``), AUC (``.3f``)."""
    return kpis.select(
        thousands_text("total_students").alias("monitored"),
        thousands_text("dropouts").alias("dropouts"),
        percent_text("avg_dropout_risk", 1).alias("mean_risk"),
        F.format_string("%.3f", F.col("model_auc")).alias("model_auc"))


def risk_histogram(scores: DataFrame, bins: int) -> DataFrame:
    return X.histogram(scores, "dropout_risk", bins, by="risk_band", out="students")


def risk_box(scores: DataFrame) -> DataFrame:
    return X.box(scores, "dropout_risk", "risk_band")


def top_neighborhoods(by_hood: DataFrame, n: int = TOP_NEIGHBORHOODS) -> DataFrame:
    return X.top_n(by_hood, "dropout_rate", n, "neighborhood")


def top_subjects(subjects: DataFrame, n: int = TOP_SUBJECTS) -> DataFrame:
    return X.top_n(subjects, "absence_rate", n, "subject_name")


def reason_shares(reasons: DataFrame) -> DataFrame:
    return IND.reason_share(reasons, count_col="students")


def scatter(filt: DataFrame, n: int = SCATTER_ROWS) -> DataFrame:
    return X.top_n(filt, "dropout_risk", n, "student_id").select(
        "student_id", "name", "grade_level", "shift", "neighborhood", "absence_rate",
        "avg_grade", "risk_band", "dropout_risk")


def priority_table(filt: DataFrame, top_n: int) -> DataFrame:
    rows = X.top_n(filt, "dropout_risk", top_n, "student_id").select(*PRIORITY_COLUMNS)
    return rows.withColumns({"dropout_risk": short_percent_text("dropout_risk"),
                             "absence_rate": short_percent_text("absence_rate")})


def student_detail(scores: DataFrame, bronze: dict[str, DataFrame], student_id: int,
                   detail: DataFrame | None = None) -> dict[str, DataFrame]:
    """Score row, bronze rows, absences per subject (desc), mean grade per subject (asc).

    With ``detail`` (the published ``student_subject_detail``, clustered by
    student) the per-subject charts read one slice of it; without, they are
    aggregated from the bronze facts as the original page did.
    """
    if detail is not None:
        mine = X.lookup(detail, "student_id", student_id)
        att = mine.where(F.col("total_absences").isNotNull()).select(
            "subject_id", "total_absences", "subject_name")
        grd = mine.where(F.col("avg_grade").isNotNull()).select(
            "subject_id", "avg_grade", "subject_name")
    else:
        subjects = bronze["subjects"].select("subject_id", "subject_name")
        att = X.detail_by(X.lookup(bronze["attendance"], "student_id", student_id), "subject_id",
                          [F.sum("absences").cast("long").alias("total_absences")], subjects)
        grd = X.detail_by(X.lookup(bronze["grades"], "student_id", student_id), "subject_id",
                          [F.avg("grade").alias("avg_grade")], subjects)
    return {
        "score": X.lookup(scores, "student_id", student_id),
        "student": X.lookup(bronze["students"], "student_id", student_id),
        "socioeconomic": X.lookup(bronze["socioeconomic"], "student_id", student_id),
        "absences_by_subject": att.orderBy(F.desc("total_absences"), "subject_id"),
        "grades_by_subject": grd.orderBy(F.asc("avg_grade"), "subject_id"),
    }
