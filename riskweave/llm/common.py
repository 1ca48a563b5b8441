"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ensure_checkpoint_dir, release, shuffles_removed  # noqa: F401
from riskweave.session import spill as materialize  # noqa: F401

# Odd multipliers of the polynomial hashes (any odd 64-bit numbers will do).
P_BYTE = np.uint64(0x9E3779B97F4A7C15)
P_WORD = np.uint64(0xD6E8FEB86659FD93)
#: Texts are handled in slices of about this many bytes (one document at least).
SLICE_BYTES = 1 << 20


def reader(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; the shuffle files of its query
    go as it ends."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        # a query follows the setting of the time it was made at
        return df.select("*").checkpoint()


def together(parts: Sequence[DataFrame]) -> DataFrame:
    """One frame of all rows that frames of ``materialize`` hold."""
    if len(parts) == 1:
        return parts[0]
    paths = tuple(p for x in parts for p in x._spilled)
    out = parts[0].sparkSession.read.schema(parts[0].schema).parquet(*paths)
    out._spilled = paths
    return out


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def powers(p: np.uint64, n: int) -> np.ndarray:
    """1, p, p^2, … modulo 2^64."""
    out = np.full(max(n, 1), p, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of a text column; null is the empty text.

    ``offsets`` has one entry more than the rows and starts at 0.  A slice
    holds about ``SLICE_BYTES`` bytes, so work arrays stay small however
    large the Arrow batch is.
    """
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + SLICE_BYTES, side="right")) - 1
        end = min(n, max(at + 1, end))
        yield slice(at, end), data[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def pack_texts(df: DataFrame, column: str = "text") -> DataFrame:
    """``df`` with a text column as compressed bytes, for the way through a
    shuffle; null is the empty text.  ``unpack_texts`` reads them back."""
    kinds = ", ".join(f"`{c}` {'binary' if c == column else t}" for c, t in df.dtypes)
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            packed = [b"" if not x else len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True)
                      for x in (v.as_py() for v in texts)]
            columns = list(batch.columns)
            columns[at] = pa.array(packed, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, kinds)


def unpack_texts(batch: pa.RecordBatch, column: str = "text", rows: int = 1 << 10) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with the texts as bytes again, few at a time."""
    at = batch.schema.get_field_index(column)
    for a in range(0, batch.num_rows, rows):
        part = batch.slice(a, rows)
        texts = [b"" if not x else pa.decompress(x[8:], decompressed_size=int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True)
                 for x in part.column(at).to_pylist()]
        columns = list(part.columns)
        columns[at] = pa.array(texts, pa.large_binary())
        yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes other than 0x20 and 0x09–0x0D) and the
    index of the first word of each document (one entry more than documents)."""
    keep = (data != 32) & ((data < 9) | (data > 13))
    at = np.flatnonzero(keep).astype(np.int64)
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(off), np.int64)
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = ~keep[:-1]
    first[off[:-1][off[:-1] < len(data)]] = True
    start = np.flatnonzero(first[at])
    length = np.diff(np.append(start, len(at)))
    inside = np.arange(len(at)) - np.repeat(start, length)
    h = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1))
                        * powers(P_BYTE, int(length.max()))[inside], start)
    return mix64(h), np.searchsorted(at[start], off)


def gram_hashes(words: np.ndarray, n: int, p: np.uint64 = P_WORD) -> np.ndarray:
    """Hash of every run of ``n`` words (``len(words) - n + 1`` of them)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out = out * p + words[j:j + m]
    return mix64(out)


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whether the run of ``n`` words at each place lies in one document."""
    m = total - n + 1
    if m <= 0:
        return np.empty(0, bool)
    doc = np.searchsorted(first, np.arange(total), side="right")
    return doc[:m] == doc[n - 1:]


def carried(names: Sequence[str]) -> list[Column]:
    """Columns that travel through an operator under names of its own choice,
    so theirs may clash with any of the operator's."""
    return [F.col(c).alias(f"_carry{i}") for i, c in enumerate(names)]


def restored(names: Sequence[str]) -> list[Column]:
    """The carried columns under their names."""
    return [F.col(f"_carry{i}").alias(c) for i, c in enumerate(names)]


def carried_schema(df: DataFrame, schema: str) -> str:
    """``schema`` and the carried columns of ``df``."""
    return ", ".join([schema, *(f"{c} {t}" for c, t in df.dtypes if c.startswith("_carry"))])


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    name = "_riskweave_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].cache = {}
    return sys.modules[name].cache


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Distributed union-find: ``(u, v)`` links → ``(node, root)``.

    ``root`` is the smallest node of the connected component; every node
    that occurs in a link has one row.  Large-star and small-star steps
    alternate: each is a minimum per node and a join back, so a hub with a
    third of all links is pre-aggregated before the shuffle and its join is
    a plain equi-join that AQE can split.  Each step is checkpointed in the
    shared folder; the links never reach the driver (only a count and a
    sum-like digest do).  Links with a null end are ignored.
    """
    e = (edges.select("u", "v").where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = checkpoint(e)

    def digest(df: DataFrame):
        h = F.xxhash64("u", "v")
        return df.agg(F.count(F.lit(1)), F.bit_xor(h)).first()

    seen = digest(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u moves to the smallest around u
        big = (both.where("v > u").join(low, "u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: u and its smaller neighbours move to the smallest of them
        small = big.groupBy("u").agg(F.min("v").alias("m"))
        e2 = (big.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
              .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e2 = checkpoint(e2)
        now = digest(e2)
        e, done, seen = e2, now == seen, now
        if done:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    tops = roots.select(F.col("root").alias("node"), "root").distinct()
    return roots.unionByName(tops)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
