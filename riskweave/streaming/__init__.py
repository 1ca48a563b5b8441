"""Incremental refresh.

The original application is batch only (no stream source, no state, no late
data).  What it does have is a *full refresh*: re-read bronze, rebuild
silver and gold.  ``refresh_on_new_files`` re-expresses that refresh on
Structured Streaming's file source with an ``availableNow`` trigger: each
run picks up the bronze files that arrived since the last run (tracked in
the checkpoint), and re-publishes the layered datasets once, with the same
batch plan.  No streaming aggregation state is kept — the gold tables are
recomputed from the stored bronze, exactly as a batch refresh would.
"""

from riskweave.streaming.refresh import refresh_on_new_files

__all__ = ["refresh_on_new_files"]
