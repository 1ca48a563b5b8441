"""Risk scoring: additive logistic rule, banding, split, model, AUC.

* ``rule_score``   deterministic logistic score ``1/(1+e^-(b0 + Σ wᵢxᵢ))``
* ``band``         ordered threshold banding on the *unrounded* score
* ``hash_split``   md5-bucket train/test split, independent of partitioning
* ``fit_logistic`` / ``score_model``  ``pyspark.ml`` logistic regression
* ``auc_exact``    exact ROC AUC of a score with bounded resolution, as one
                   bounded aggregate (no global sort of the population)
* ``auc_ranked``   exact ROC AUC of an unrounded score, by a distributed rank
* ``auc_evaluator`` Spark ML's ``BinaryClassificationEvaluator``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import band as band_expr
from riskweave.functions import hash_bucket, logistic, round_half_up
from riskweave.operators.ranking import running_sums
from riskweave.session import release

Term = tuple[Column | str, float]

# Fixed values of the original application's banding.
DEFAULT_THRESHOLDS = (0.70, 0.40)
DEFAULT_BANDS = ("Alto", "Medio", "Baixo")


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def rule_score(df: DataFrame, intercept: float, terms: Sequence[Term], out: str = "risk",
               score_col: str | None = None, base: float | None = None) -> DataFrame:
    """Append ``out = logistic(intercept + Σ weight * term)``.

    ``score_col`` optionally keeps the linear score as well; ``base``
    replaces e in the logistic (the original rule used 2.71828).
    """
    s = F.lit(float(intercept))
    for term, w in terms:
        s = s + F.lit(float(w)) * _c(term)
    out_df = df.withColumn(out, logistic(s, base))
    return out_df.withColumn(score_col, s) if score_col else out_df


def band(df: DataFrame, col: str, thresholds: Sequence[float] = DEFAULT_THRESHOLDS,
         names: Sequence[str] = DEFAULT_BANDS, out: str = "risk_band") -> DataFrame:
    return df.withColumn(out, band_expr(col, thresholds, names))


def hash_split(df: DataFrame, key: str, train_pct: int = 80, out: str = "split") -> DataFrame:
    """``out = 'train'`` for md5 buckets below ``train_pct`` (of 100), else ``'test'``.

    Stable under any partitioning, AQE setting or re-run, unlike
    ``randomSplit`` whose per-partition sampling depends on the plan.
    """
    train = hash_bucket(key, 100) < F.lit(train_pct)
    return df.withColumn(out, F.when(train, F.lit("train")).otherwise(F.lit("test")))


# -------------------------------------------------------------------- model
def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint directory.

    The model path reads its input several times (null check, fit
    iterations, scoring, evaluation).  A reliable checkpoint — written to
    the cluster's ``spark.checkpoint.dir``, never to executor-local disk —
    computes the profile joins once and cuts the lineage, so a lost
    executor costs a re-read of files, not a re-run of the joins.
    """
    from riskweave.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def null_feature_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """NULL count per feature column, in one aggregate pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def fit_logistic(train: DataFrame, features: str = "features", label: str = "label",
                 max_iter: int = 50, reg_param: float = 0.0, tol: float = 1e-6):
    """Fit ``pyspark.ml`` logistic regression (no regularisation by default).

    The estimator persists its input internally for the iterations.  The
    model gives up its training summary: that holds the session, which cannot
    be sent to the executors once it has observed a metric.
    """
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg_param, tol=tol)
    model = lr.fit(train)
    model._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return model


def score_model(model, df: DataFrame, out: str = "risk") -> DataFrame:
    """Apply a fitted classifier; ``out`` = probability of the positive class."""
    from pyspark.ml.functions import vector_to_array
    pred = model.transform(df)
    return pred.withColumn(out, vector_to_array(F.col("probability")).getItem(1))


def score_equations(model, train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``equation, value`` of the conditions an unregularised logistic fit with
    an intercept meets on its training rows: the mean probability (4 digits;
    it equals the positive share), and per feature ``x`` the residual moment
    ``Σ x·(y − p) / Σ |x|`` (3 digits; 0)."""
    p = F.col("_p")
    scored = score_model(model, train, out="_p")
    wide = scored.agg(
        F.avg(p).alias("mean_probability"),
        *[F.try_divide(F.sum(F.col(c) * (F.col(label) - p)), F.sum(F.abs(F.col(c)))).alias(f"residual {c}")
          for c in features])
    digits = {c: 4 if c == "mean_probability" else 3 for c in wide.columns}
    # adding 0.0 turns a rounded -0.0 into 0.0
    wide = wide.select(*[(F.round(F.coalesce(F.col(f"`{c}`"), F.lit(0.0)), d) + F.lit(0.0)).alias(c)
                         for c, d in digits.items()])
    return wide.unpivot([], wide.columns, "equation", "value")


def auc_evaluator(pred: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    """Spark ML's area under ROC; NaN when the rows hold fewer than two classes."""
    classes = pred.select(label).distinct().limit(2).count()  # bounded probe
    if classes < 2:
        return float("nan")
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw,
                                       metricName="areaUnderROC")
    return float(ev.evaluate(pred))


# ---------------------------------------------------------------- exact AUC
def score_histogram(df: DataFrame, score: str, label: str, digits: int = 4) -> DataFrame:
    """Positives and negatives per score rounded to ``digits``.

    For a score in [0, 1] this has at most ``10^digits + 1`` rows whatever
    the population size, so later global windows over it are bounded.
    """
    s = round_half_up(F.col(score), digits)
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(s.alias("score_value"))
            .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))


def auc_exact(df: DataFrame, score: str, label: str, digits: int = 4,
              out: str = "auc") -> DataFrame:
    """One-row ROC AUC = P(s⁺ > s⁻) + ½·P(s⁺ = s⁻) over the rounded score.

    Computed on ``score_histogram`` (bounded), with a running sum of
    negatives below each score value:
    ``AUC = Σ pos·(2·neg_below + neg) / (2·P·N)`` — integer sums, one
    division, so the value is exact and engine-independent.  NULL when
    either class is empty.
    """
    h = score_histogram(df, score, label, digits)
    w = Window.orderBy("score_value").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("neg_below", F.coalesce(F.sum("neg").over(w), F.lit(0)).cast("long"))
    return _auc_of(h, out)


def _auc_of(h: DataFrame, out: str) -> DataFrame:
    """One row from ``pos, neg, neg_below`` per distinct score."""
    # products of two counts may pass 64 bits
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("pos", "neg", "neg_below")}
    agg = h.agg(
        F.sum(wide["pos"] * (wide["neg_below"] + wide["neg_below"] + wide["neg"])).alias("_num"),
        F.sum("pos").cast("decimal(19,0)").alias("_p"), F.sum("neg").cast("decimal(19,0)").alias("_n"))
    return agg.select(
        F.try_divide(F.col("_num").cast("double"),
                     (F.col("_p") * F.col("_n")).cast("double") * 2).alias(out))


def auc_ranked(df: DataFrame, score: str, label: str, out: str = "auc", partitions: int | None = None) -> DataFrame:
    """One-row ROC AUC over the score as it is, however many values it has.

    Rows are reduced to positives and negatives per distinct score (map-side
    first), so a tie is one row and cannot straddle two ranges, and a score
    that a third of all rows share is small.  Those rows are ranked in two
    passes (``ranking.running_sums``): dealt by range of the score, negatives
    summed per range, and a running sum over the ranges; only that table, one
    row a range, is in one task.  NULL scores and labels take no part; NULL
    when either class is empty.
    """
    h = (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
         .groupBy(F.col(score).alias("score_value"))
         .agg(F.count_if(F.col(label) == 1).cast("long").alias("pos"),
              F.count_if(F.col(label) != 1).cast("long").alias("neg")))
    ranked = running_sums(h, [F.col("score_value")], ["neg"], partitions=partitions)
    one = materialize(_auc_of(ranked, out))
    release(ranked)
    return one
