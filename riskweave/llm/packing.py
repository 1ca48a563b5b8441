"""Sum-of-squares online packing of documents into fixed token windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tokens import byte_bpe

#: Open windows a task holds before it settles them (4 KiB of ids each).
MAX_OPEN = 4096

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


class SumOfSquares:
    """Online packer of one task.

    ``level[h]`` is the number of open windows filled up to ``h``.  A piece of
    size ``s`` goes to the level ``h`` (0: a new window) for which the sum of
    ``level[h] ** 2`` over partially filled windows grows least; ties go to
    the fullest window.  :meth:`settle` closes what stays open: pieces of the
    emptiest windows are cut to fill the fullest ones, so at most one window
    per call is left short.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.level = np.zeros(size + 1, np.int64)
        self.at: list[list[list]] = [[] for _ in range(size + 1)]
        self.open = 0

    def place(self, piece: tuple, s: int) -> list | None:
        """Add a piece; the window's pieces if that fills it."""
        n, size = self.level, self.size
        hs = np.flatnonzero(n[:size - s + 1])
        best, cost = 0, (-1 if s == size else 2 * int(n[s]) + 1)
        if len(hs):
            after = np.where(hs + s < size, n[hs + s], -1)
            # a move takes one window from h and adds one at h + s (none when full)
            grow = np.where(after >= 0, 2 * (after - n[hs]) + 2, 1 - 2 * n[hs])
            j = len(grow) - 1 - int(np.argmin(grow[::-1]))
            if grow[j] <= cost:
                best = int(hs[j])
        window = []
        if best:
            window = self.at[best].pop()
            n[best] -= 1
            self.open -= 1
        window.append(piece)
        fill = best + s
        if fill == size:
            return window
        self.at[fill].append(window)
        n[fill] += 1
        self.open += 1
        return None

    def settle(self) -> Iterator[list]:
        """Close all open windows, refilling the fullest from the emptiest."""
        todo = [w for ws in self.at for w in ws]  # emptiest first
        self.level[:] = 0
        self.at = [[] for _ in range(self.size + 1)]
        self.open = 0
        low, high = 0, len(todo) - 1
        while low <= high:
            window = todo[high]
            gap = self.size - sum(p[2] for p in window)
            while gap and low < high:
                donor = todo[low]
                if not donor:
                    low += 1
                    continue
                doc, start, length, ids, total = donor.pop()
                take = min(gap, length)
                window.append((doc, start, take, ids[:4 * take], total))
                if take < length:
                    donor.append((doc, start + take, length - take, ids[4 * take:], total))
                gap -= take
            if window:
                yield window
            high -= 1


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, size: int = 1024,
                   end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize every document and pack it into windows of ``size`` tokens.

    A document is its byte-BPE ids and then ``end_id``; null text is empty
    text, so it still gives one piece holding ``end_id``.  Whole windows are
    cut off long documents, what remains is placed by the sum-of-squares
    rule.  Each input partition is packed by itself in one pass without a
    shuffle: a task holds its level array and at most ``MAX_OPEN`` open
    windows, and a lost task is simply run again on the same file split.
    Repeated rows are packed as often as they occur, a null id stays null,
    other columns are ignored, an empty table gives no pieces.

    Returns one row per piece: ``doc_id, start, length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset``.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        bpe = byte_bpe(ranks_path, pattern)
        packer, rows, held, seq = SumOfSquares(size), [], 0, 0

        def emit(window):
            nonlocal seq, held
            offset = 0
            for doc, start, length, ids, total in window:
                rows.append((doc, start, length, ids, total, base + seq, offset))
                offset += length
            held += offset
            seq += 1

        def flush():
            nonlocal held
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in SCHEMA.split(", ")])
            rows.clear()
            held = 0
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1)
            for i, key in enumerate(keys):
                text = texts[i].as_py() or ""
                ids = bpe.ids(text) + end
                total = len(ids) // 4
                whole = total - total % size
                for start in range(0, whole, size):
                    emit([(key, start, size, ids[4 * start:4 * (start + size)], total)])
                if total > whole:
                    full = packer.place((key, whole, total - whole, ids[4 * whole:], total), total - whole)
                    if full:
                        emit(full)
                    if packer.open >= MAX_OPEN:
                        for window in packer.settle():
                            emit(window)
                if held >= 1 << 20:
                    yield flush()
        for window in packer.settle():
            emit(window)
        if rows:
            yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)
