"""What a scan really read, from Spark's own metrics of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskweave.operators.risk import materialize


def run_and_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Compute ``df`` once (a reliable checkpoint) and return it with the rows
    that its file scans gave to the plan: after files, row groups and pages
    that the pushed filters rule out, before the filters themselves."""
    out = materialize(df)
    return out, sum(_scan_rows(df._jdf.queryExecution().executedPlan()))


def _scan_rows(plan) -> list[int]:
    """Output rows of the file scans under a physical plan node, as run."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _scan_rows(plan.executedPlan())
    if "QueryStage" in name:
        return _scan_rows(plan.plan())
    if name.startswith("Scan parquet"):
        return [int(plan.metrics().apply("numOutputRows").value())]
    children = plan.children()
    return [n for i in range(children.size()) for n in _scan_rows(children.apply(i))]
