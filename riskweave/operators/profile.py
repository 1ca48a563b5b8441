"""Wide per-entity profile: entity ⨝ 1:1 attributes ⨝ dimension ⨝ facts.

Join order is fixed left-deep as in the original pipeline — entity first,
then 1:1 attribute tables, the (small) dimension, the pre-aggregated fact
tables, and finally the sparse ones with a left join and a fill.  Every fact
table is aggregated to one row per entity *before* the join, so all joins
are 1:1 (or n:1 for the dimension) and no join key can fan out or skew; frames
that are not aggregates can be checked for that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import flag


@dataclass(frozen=True)
class FlagRule:
    """``name = 1.0 if column <op> threshold else 0.0``; op ``double`` casts."""
    column: str
    op: str
    threshold: object = None
    name: str | None = None

    @property
    def out(self) -> str:
        return self.name or self.column


def add_flags(df: DataFrame, rules: Sequence[FlagRule]) -> DataFrame:
    """Append (or replace) 0.0/1.0 flag columns and double casts."""
    cols = {}
    for r in rules:
        if r.op == "double":
            cols[r.out] = F.col(r.column).cast("double")
        else:
            cols[r.out] = flag(r.column, r.op, r.threshold)
    return df.withColumns(cols)


def label(df: DataFrame, column: str, positive: str, out: str = "label") -> DataFrame:
    """``out = 1.0`` when ``column == positive`` else 0.0 (NULL → 0.0)."""
    return df.withColumn(out, flag(column, "eq", positive))


def one_row_per(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df``, or an error as soon as a task meets a key with a second row.

    The rows are grouped by the key, which deals them out as the join that
    follows needs them, so the check adds no shuffle to a sort-merge join.
    Null keys join nothing and may repeat.
    """
    rest = [c for c in df.columns if c != key]
    said = F.concat(F.lit(f"{what} has "), F.col("_rows").cast("string"), F.lit(f" rows for {key} "),
                    F.col(key).cast("string"), F.lit(", one is declared"))
    single = F.when(F.col(key).isNotNull() & (F.col("_rows") > 1), F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"),
                                  *([F.first(F.struct(*rest)).alias("_row")] if rest else []))
    return grouped.where(single).select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])


#: Frames of a profile that are declared to have one row per key.
ONE_ROW = ("entity", "attributes", "dimension", "facts", "sparse")


def build_profile(entity: DataFrame, key: str, *, attributes: Sequence[DataFrame] = (),
                  dimension: tuple[DataFrame, str] | None = None,
                  facts: Sequence[DataFrame] = (), how: str = "inner",
                  sparse: Sequence[DataFrame] = (), fill: Mapping[str, object] | None = None,
                  check: Sequence[str] = ()) -> DataFrame:
    """One row per entity.

    * ``attributes`` — 1:1 tables keyed by ``key``, inner joined (an entity
      without them vanishes, as in the original pipeline);
    * ``dimension`` — ``(dim, dim_key)`` n:1 lookup (broadcast it upstream
      when its size is known to be small);
    * ``facts`` — per-entity aggregates joined with ``how`` (``"inner"``
      drops entities with no fact rows; ``"left"`` keeps them with NULLs);
    * ``sparse`` — per-entity aggregates left joined; ``fill`` replaces the
      resulting NULLs (e.g. ``{"action_count": 0}``).

    The groups of frames named in ``check`` (of ``ONE_ROW``) are declared to
    have one row per key, and checked while they are joined (``one_row_per``):
    a second row is an error.  Without the check it doubles its entity, as it
    did in the original pipeline.  Frames that are aggregates by the key need
    no check.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if set(check) - set(ONE_ROW):
        raise ValueError(f"check names groups of frames: {', '.join(ONE_ROW)}")

    def checked(group: str, frames: Sequence[DataFrame]) -> list[DataFrame]:
        if group not in check:
            return list(frames)
        return [one_row_per(f, key, f"{group}[{i}]") for i, f in enumerate(frames)]

    entity, = checked("entity", [entity])
    attributes, facts, sparse = checked("attributes", attributes), checked("facts", facts), checked("sparse", sparse)
    if dimension is not None and "dimension" in check:
        dimension = one_row_per(dimension[0], dimension[1], "dimension"), dimension[1]
    out = entity
    for a in attributes:
        out = out.join(a, key, "inner")
    if dimension is not None:
        dim, dim_key = dimension
        out = out.join(dim, dim_key, "inner")
    for f in facts:
        out = out.join(f, key, how)
    for s in sparse:
        out = out.join(s, key, "left")
    if fill:
        out = out.fillna(dict(fill))
    return out
