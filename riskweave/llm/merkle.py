"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups,
and a proof for every row.

Nodes of one level lie in runs of ``FANOUT``.  A window per run, in the order
of the slots, supplies each node's siblings by lag and lead columns of fixed
offsets; a lag counts only where the slot is large enough, a lead only where
the run is long enough (the last run of a level may be shorter).  The node in
slot 0 has the whole run before it and hashes the parent, so the rows of the
next level are the first children of this one.

Windows are partitioned by run, never by group: a group of a third of all rows
is as many windows as it has runs.  On the way down each level joins its
parents' paths by run, which is the partitioning its window already has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import carried, materialize, release, restored, union_all
from riskweave.operators.ranking import numbered

#: Nodes of a run.
FANOUT = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts: Column) -> Column:
    """Lower-case hex sha256 of the concatenated texts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """One value of a leaf: ``-`` if null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return h(*[field(v) for v in values])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole(places: Column) -> Column:
    """Places in runs."""
    return F.call_function("div", places, F.lit(FANOUT))


def siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, place, n, hash) with ``run``, ``slot`` and the
    concatenated hashes of the ``left`` and ``right`` siblings of each node."""
    at = nodes.withColumns({"run": whole(F.col("place")), "slot": (F.col("place") % FANOUT).cast("int")})
    w = Window.partitionBy("tree", "run").orderBy("slot")
    length = F.least(F.lit(FANOUT), F.col("n") - F.col("run") * FANOUT)
    none = F.lit("")
    left = [F.when(F.col("slot") >= k, F.lag("hash", k).over(w)).otherwise(none) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < length, F.lead("hash", k).over(w)).otherwise(none) for k in range(1, FANOUT)]
    return at.withColumns({"left": F.concat(*left), "right": F.concat(*right)})


def parents(nodes: DataFrame) -> DataFrame:
    """The next level: each run's first child hashes the run."""
    return siblings(nodes).where("slot = 0").select(
        "tree", F.col("run").alias("place"), whole(F.col("n") + (FANOUT - 1)).alias("n"),
        h(F.col("hash"), F.col("right")).alias("hash"))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels of all trees, each written once; the last holds single nodes
    only.  ``nodes`` is ``tree, place, n, hash`` with ``n`` the nodes of the
    tree, already on disk; a tree of one node has no further level."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(materialize(parents(out[-1].where("n > 1")), "merkle-level"))
        most = -(-most // FANOUT)
    return out


def tops(tree_levels: Sequence[DataFrame]) -> DataFrame:
    """``tree, hash``: the last node of each tree."""
    return union_all(x.where("n = 1").select("tree", "hash") for x in tree_levels)


def paths(tree_levels: Sequence[DataFrame], above: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The lowest level's nodes with their ``path``: the siblings at each step
    up to the top of the tree, then the path of ``above`` (tree, path and the
    columns ``keep``), one row a tree."""
    done = None
    for nodes in reversed(tree_levels):
        extra = [c for c in nodes.columns if c not in ("tree", "place", "n")]
        single = nodes.where("n = 1").join(above, "tree").select("tree", "place", *extra, "path", *keep)
        if done is None:
            done = single
            continue
        up = done.select("tree", F.col("place").alias("run"), F.col("path").alias("rest"), *keep)
        more = siblings(nodes.where("n > 1")).join(up, ["tree", "run"])
        done = more.select("tree", "place", *extra, F.concat(F.array(F.struct("left", "right")), "rest").alias("path"),
                           *keep).unionByName(single)
    return done


def folded(path: Column, leaf: Column) -> Column:
    """Root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, step: h(step["left"], acc, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return h(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(df: DataFrame, group: str, order: str, fields: Sequence[str], altered: dict[str, Column] | None = None,
             carry: Sequence[str] = ()) -> DataFrame:
    """Hash tree over all rows, with a proof for each.

    A leaf is the hash of ``fields`` (see ``field``).  Per value of ``group``
    (null is one) leaves ascend by ``order`` (nulls first; ties by the leaf,
    so equal rows are interchangeable); every run of ``FANOUT`` nodes becomes
    their hash until one is left, the subroot.  Subroots, ordered by group
    (null first, then by UTF-8 bytes), give the root in the same way.

    ``altered`` replaces columns in a second leaf, ``tampered``.
    Returns one row per row of ``df``: ``order``, ``leaf``, ``tampered``,
    ``subroot``, ``root``, ``path`` (array of left and right siblings) and the
    columns named in ``carry``.  Repeated rows each have a leaf; an empty
    table gives no row.  Names of other columns do not matter.
    """
    second = [(altered or {}).get(f, F.col(f)) for f in fields]
    rows = df.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("tree"),
        F.col(order).alias("key"), leaf_hash([F.col(f) for f in fields]).alias("hash"),
        leaf_hash(second).alias("tampered"), *carried(carry))
    # texts are read once; from here on a row is its hashes
    rows = materialize(rows.withColumn("salt", F.monotonically_increasing_id()), "merkle-leaves")
    by = [F.col("key").asc_nulls_first(), F.col("hash"), F.col("salt")]
    placed = numbered(rows, by, ["tree"])
    leaves = materialize(placed.withColumnRenamed("place_rows", "n").drop("salt"), "merkle-order")
    release(rows, placed)
    low = levels(leaves)
    subroots = tops([low[0].select("tree", "place", "n", "hash"), *low[1:]])
    named = subroots.select(F.lit(0).alias("all"), F.col("tree").alias("name"), F.col("hash"))
    ordered = materialize(numbered(named, [F.col("name")], ["all"]).select(
        F.col("all").cast("string").alias("tree"), "place", F.col("place_rows").alias("n"), "hash", "name"),
        "merkle-subroots")
    high = levels(ordered)
    top = tops([high[0].select("tree", "place", "n", "hash"), *high[1:]])
    empty = F.array().cast("array<struct<left:string,right:string>>")
    whole = top.select("tree", F.col("hash").alias("root"), empty.alias("path"))
    above = paths(high, whole, ["root"]).select(
        F.col("name").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    found = paths(low, materialize(above, "merkle-groups"), ["subroot", "root"])
    return found.select(F.col("key").alias(order), F.col("hash").alias("leaf"), "tampered", "subroot", "root", "path",
                        *restored(carry))
