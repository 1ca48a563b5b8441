"""End-to-end batch run: bronze roles → silver profile → gold tables.

The silver profile is written to storage and read back before anything
else uses it: the model fit, its evaluation, scoring and every gold table
then start from the stored copy instead of re-running the joins (the
original pipeline recomputed the whole profile for each of its actions),
and a lost executor costs a re-read of files, not a re-run of the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import indicators as IND
from riskweave.operators import risk as R
from riskweave.operators.aggregates import rate_by_dim
from riskweave.plans import adapters as A
from riskweave.plans import flows
from riskweave.session import configure
from riskweave.sources import io, versions

SCORED_SCHEMA = T.StructType([
    T.StructField("entity_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("segment", T.StringType()), T.StructField("region", T.StringType()),
    T.StructField("area", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()), T.StructField("risk", T.DoubleType()),
    T.StructField("risk_band", T.StringType()), T.StructField("miss_rate", T.DoubleType()),
    T.StructField("avg_mark", T.DoubleType()), T.StructField("low_marks", T.LongType()),
    T.StructField("views", T.LongType()), T.StructField("purchases", T.LongType()),
    T.StructField("clicks", T.LongType()), T.StructField("balance", T.DoubleType()),
    T.StructField("action_count", T.LongType()),
])


#: Rows of a page of the entity-clustered table: what a lookup reads at least.
LOOKUP_PAGE_ROWS = 1024


def fit_model(prof: DataFrame, features=flows.MODEL_FEATURES, label: str = "lapsed_label",
              train_pct: int = 80, max_iter: int = 50, tol: float = 1e-6, key: str = flows.KEY):
    """Assembled rows with their split, and the logistic model of the train rows.

    A NULL feature is an error, reported before the fit (the assembler's own
    check is lazy and fires late).
    """
    prof = R.materialize(prof)
    nulls = {c: n for c, n in R.null_feature_counts(prof, features).items() if n}
    if nulls:
        raise ValueError(f"NULL model features (rows per column): {nulls}")
    data = R.assemble(R.hash_split(prof, key, train_pct), features)
    model = R.fit_logistic(data.where(F.col("split") == "train"), label=label, max_iter=max_iter, tol=tol)
    return data, model


def fit_and_score(prof: DataFrame, features=flows.MODEL_FEATURES, label: str = "lapsed_label",
                  train_pct: int = 80, max_iter: int = 50,
                  thresholds=flows.RULE_THRESHOLDS) -> tuple[DataFrame, float]:
    """Fit logistic regression on the train split, score everyone, evaluate on test.

    Returns the scored table (with ``split`` and the label) and the held-out
    AUC from Spark ML's evaluator.
    """
    data, model = fit_model(prof, features, label, train_pct, max_iter)
    pred = R.score_model(model, data, out="risk_raw")
    auc = R.auc_evaluator(pred.where(F.col("split") == "test"), label=label)
    out = flows.scored(pred, "risk_raw", thresholds, extra=("split", label))
    return out, auc


def run(spark: SparkSession, sf_dir: str, out_root: str, method: str = "rule",
        csv: bool = True) -> dict[str, str]:
    """Publish silver ``profile`` and gold ``scores``, ``by_area``,
    ``rate_by_dim``, ``reasons``, ``kpis`` and ``entity_detail`` under
    ``out_root``.

    ``entity_detail`` (per entity and part) is written globally sorted by
    ``(entity_id, l_partkey)``: the sort range-partitions it, so every file
    holds a disjoint, ordered slice of entities and parquet's row-group
    min/max statistics let a lookup (``entity_detail``) skip all data of
    other entities instead of scanning lineitem.
    """
    configure(spark)
    t = A.tables(spark, sf_dir)
    written = io.publish(flows.profile(t), out_root, "silver", "profile")
    prof = io.read_dataset(spark, out_root, "silver", "profile")

    auc = None
    if method == "model":
        scored, auc = fit_and_score(prof)
    else:
        scored = flows.scored(flows.with_rule_score(prof))
    fmts = ("parquet", "csv") if csv else ("parquet",)
    # partitioned by band (3 values): a band filter reads only its directories
    io.publish(scored, out_root, "gold", "scores", formats=fmts, partition_by=["risk_band"],
               sort_by=[F.col("risk_band"), F.col("risk").desc(), F.col("entity_id")])
    scored = io.read_dataset(spark, out_root, "gold", "scores").select(*scored.columns)
    if auc is None:
        test = R.hash_split(scored, "entity_id").where(F.col("split") == "test").withColumn(
            "lapsed_label", F.when(F.col("status") == A.LAPSED, 1).otherwise(0))
        auc = R.auc_exact(test, "risk", "lapsed_label").first()["auc"]
        auc = float("nan") if auc is None else auc  # keep the column; NULL value

    small = dict(formats=fmts, single_csv_file=True)
    by_area = IND.by_group(scored, "area", "status", A.LAPSED, positive_name="lapsed",
                           rate_name="lapsed_rate")
    io.publish(by_area, out_root, "gold", "by_area",
               sort_by=[F.col("lapsed_rate").desc(), F.col("area")], **small)
    dim = rate_by_dim(A.lines_by_part(t), A.part_dim(t), "l_partkey", "part_key", "part_type",
                      "missed", "offered", num_total="missed_total", den_total="offered_total",
                      rate="miss_rate")
    io.publish(dim, out_root, "gold", "rate_by_dim",
               sort_by=[F.col("miss_rate").desc(), F.col("part_type")], **small)
    reasons = IND.reasons(scored, "status", A.LAPSED, "reason")
    io.publish(reasons, out_root, "gold", "reasons",
               sort_by=[F.col("entities").desc(), F.col("reason")], **small)
    k = IND.kpis(scored, "status", A.LAPSED, auc=auc, names={"positives": "lapsed"})
    io.publish(k, out_root, "gold", "kpis", **small)
    io.publish(flows.entity_detail(t), out_root, "gold", "entity_detail",
               sort_by=[F.col("entity_id"), F.col("l_partkey")], page_rows=LOOKUP_PAGE_ROWS)
    written.update({"gold": f"{out_root}/gold"})
    return written


def refresh(spark: SparkSession, sf_dir: str, root: str, method: str = "rule", csv: bool = True) -> versions.Version:
    """``run`` as a new version of ``root``: readers see all of it or none of it."""

    def write(folder: str) -> dict:
        run(spark, sf_dir, folder, method, csv)
        return {f"{r.dataset}.{r.format}": r.rows for r in published_counts(spark, folder).collect()}  # 12 rows

    return versions.refresh(spark, root, write)


#: Published datasets: layer, name, formats.
DATASETS = (("silver", "profile", ("parquet",)), ("gold", "scores", ("parquet", "csv")),
            ("gold", "by_area", ("parquet", "csv")), ("gold", "rate_by_dim", ("parquet", "csv")),
            ("gold", "reasons", ("parquet", "csv")), ("gold", "kpis", ("parquet", "csv")),
            ("gold", "entity_detail", ("parquet",)))


def published_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """``dataset, format, rows`` of everything ``run`` published, read back
    (CSV with the schema of its parquet copy, malformed rows an error); of the
    current version, where ``out_root`` holds versions."""
    out_root = versions.resolve(spark, out_root)
    parts = []
    for layer, name, formats in DATASETS:
        stored = io.read_dataset(spark, out_root, layer, name)
        # partition columns come last in the stored schema but not in the CSV
        columns = SCORED_SCHEMA if name == "scores" else stored.schema
        for fmt in formats:
            df = io.read_dataset(spark, out_root, layer, name, fmt, schema=columns) if fmt == "csv" else stored
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("dataset"), F.lit(fmt).alias("format"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def entity_detail(spark: SparkSession, out_root: str, entity_id: int) -> DataFrame:
    """One entity's detail rows from the published, entity-clustered table.

    The equality filter is pushed to the parquet reader, which skips every
    row group whose ``entity_id`` range excludes the key.
    """
    d = io.read_dataset(spark, versions.resolve(spark, out_root), "gold", "entity_detail")
    return d.where(F.col("entity_id") == F.lit(entity_id))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """profile → rule score → band → per-area indicators (lazy)."""
    configure(spark)
    s = flows.rule_scored(A.tables(spark, sf_dir))
    return IND.by_group(s, "area", "status", A.LAPSED, positive_name="lapsed",
                        rate_name="lapsed_rate")


__all__ = ["SCORED_SCHEMA", "fit_model", "fit_and_score", "run", "refresh", "published_counts", "flagship",
           "entity_detail"]
