"""Substring search by an index of trigrams.

The index holds one row per distinct three-character run of a lower-cased name,
with the key and the name, sorted by run; and the number of names per run.  A
text can only occur in a name that holds all runs of the text, so a search
takes the rarest of them, reads its stretch of the index, which the pushed
filter cuts out of the files, and applies the exact test to the names there.

A text shorter than three characters has no run and is tested on all names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources import io

GRAM = 3
#: Rows of a page of the index, the least that a lookup reads of a file.
PAGE_ROWS = 1024


def grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` characters."""
    n = F.length(text)
    places = F.when(n >= GRAM, F.sequence(F.lit(1), n - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))


def publish_index(df: DataFrame, root: str, name: str, name_col: str, id_col: str) -> None:
    """Write the index of ``name_col`` under ``<root>/index``; rows with a null
    name or key are in no result and not indexed."""
    base = (df.select(F.col(id_col).alias("key"), F.lower(F.col(name_col)).alias("name"))
            .where("key is not null and name is not null"))
    postings = base.select(F.explode(grams(F.col("name"))).alias("gram"), "key", "name")
    # sorted by run and key, so a run that most names hold is many files' work
    io.publish(postings, root, "index", name, sort_by=["gram", "key"], page_rows=PAGE_ROWS)
    stored = io.read_dataset(df.sparkSession, root, "index", name, schema=postings.schema)
    counts = stored.groupBy("gram").agg(F.count(F.lit(1)).alias("names"))
    io.publish(counts, root, "index", f"{name}_counts", sort_by=["gram"], page_rows=PAGE_ROWS)


def rarest(spark: SparkSession, root: str, name: str, text: str) -> tuple[str, int] | None:
    """The run of the text that the fewest names hold, and their number; None
    if the text is too short to have one."""
    mine = {text[i:i + GRAM] for i in range(len(text) - GRAM + 1)}
    if not mine:
        return None
    counts = io.read_dataset(spark, root, "index", f"{name}_counts")
    found = {r.gram: r.names for r in counts.where(F.col("gram").isin(sorted(mine))).collect()}  # the text's runs at most
    return min(((found.get(g, 0), g) for g in mine), default=None)[::-1]


def search_index(spark: SparkSession, root: str, name: str, text: str, names: DataFrame | None = None) -> DataFrame:
    """``key`` of the names that contain the trimmed, lower-cased text.

    ``names`` (``key, name``) is read instead where the text is too short."""
    text = text.strip().lower()
    found = rarest(spark, root, name, text)
    if found is None:
        if names is None:
            raise ValueError(f"a text of fewer than {GRAM} characters needs the names")
        return names.where(F.lower("name").contains(F.lit(text))).select("key")
    postings = io.read_dataset(spark, root, "index", name)
    return postings.where((F.col("gram") == F.lit(found[0])) & F.col("name").contains(F.lit(text))).select("key")
