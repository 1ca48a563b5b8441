"""Plan properties that matter at scale, checked on the formatted plans."""

import contextlib
import io
import os
import re

import pytest

from riskweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

EAGER = {"q_ml_scores", "q_ml_auc", "q_ml_split", "q_ml_calibration"}  # fit a model while building the plan


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def scans(text: str, table: str) -> list[str]:
    """The formatted 'Scan parquet' detail blocks that read ``table``."""
    blocks = re.split(r"\n\(\d+\) ", text)
    return [b for b in blocks if b.startswith("Scan parquet") and f"/{table}.parquet" in b]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_no_products(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text, f"{name}: {bad} in plan"


def _read_cols(block: str) -> list[str]:
    schema = re.search(r"ReadSchema: struct<([^>]*)>", block).group(1)
    return sorted(c.split(":")[0] for c in schema.split(","))


@pytest.mark.parametrize("name", ["q_profile", "q_profile_left"])
def test_profile_reads_each_table_once_with_pruning(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for table in ("lineitem", "orders", "customer", "events"):
        assert len(scans(text, table)) == 1, table
    assert _read_cols(scans(text, "lineitem")[0]) == ["l_orderkey", "l_quantity", "l_returnflag"]
    assert _read_cols(scans(text, "orders")[0]) == \
        ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"]


def test_no_cut_where_nothing_is_predicted(spark):
    for name in ("q_rate_by_entity", "q_marks", "q_rate_by_dim", "q_left_fill", "q_entity_detail_all"):
        assert "o_orderdate" not in plan(QUERIES[name](spark, SF)), name


def test_kpis_and_histogram_read_lineitem_once(spark):
    for name in ("q_kpis", "q_hist"):
        assert len(scans(plan(QUERIES[name](spark, SF)), "lineitem")) == 1, name


def test_facets_single_pass(spark):
    text = plan(QUERIES["q_facets"](spark, SF))
    assert len(scans(text, "lineitem")) == 1


def test_top_n_is_take_ordered(spark):
    for name in ("q_top_area", "q_top_dim", "q_top_n"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF)), name


def test_lists_in_stored_order_are_take_ordered(spark, monkeypatch):
    """What q_scatter and q_priority_list compute before they give their folder back."""
    from riskweave.plans import queries as Q

    plans, back = [], Q._read_back
    monkeypatch.setattr(Q, "_read_back", lambda path, df: (plans.append(plan(df)), back(path, df))[1])
    for name in ("q_scatter", "q_priority_list"):
        QUERIES[name](spark, SF)
        assert "TakeOrderedAndProject" in plans[-1], name
