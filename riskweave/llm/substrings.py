"""Substring deduplication by a relative Lempel-Ziv parse.

A phrase is a run of ``window`` words.  The reference is made of all documents
in the order of their ids, less what it holds already: every phrase is in it
once, at its first place in the document with the smallest id.  It is cut into
blocks of ``BLOCK_WORDS`` words of a document, and the index of its phrases
(hash → block and place in it) is dealt out by phrase hash.

A document is parsed greedily from left to right: at a phrase that the index
has in an earlier document, a factor opens and runs on for as long as the next
phrase here is the next one in that block.  A match of ``window`` words or more
can lie at one place of the reference only, that of its first phrase; so this
factor is the longest against every block, not only against one.  Shorter
matches are literals.  Where a factor ends, the phrases that begin in its last
``window - 1`` words are looked up as well: nothing that straddles the end of
a factor or of a block is missed, and factors may overlap by as much.

Few phrases repeat, so most are never sent anywhere.  Any two equal phrases
have the same lightest ``ANCHOR``-word run (their anchor) at the same place;
only phrases whose anchor occurs in two documents are looked up at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import (carried, carried_schema, gram_hashes, materialize, pack_texts, release, restored,
                                  text_slices, unpack_texts, within, word_hashes)

#: Words of an anchor.
ANCHOR = 4
#: Words of a block of the reference (a phrase belongs to the block it begins in).
BLOCK_WORDS = 4096


def anchors(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the phrases, anchor hash of each phrase, anchor hashes by word)."""
    grams = gram_hashes(words, ANCHOR)
    span = window - ANCHOR + 1
    starts = np.flatnonzero(within(first, window, len(words)))
    if not len(starts):
        return starts, np.empty(0, np.uint64), grams
    light = np.lib.stride_tricks.sliding_window_view(grams, span).min(axis=1)
    return starts, light[starts], grams


def _long(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False)


def document_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``h, doc_id``: the distinct anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for rows, data, off in text_slices(batch, "text"):
                words, first = word_hashes(data, off)
                starts, light, _ = anchors(words, first, window)
                doc = np.searchsorted(first, starts, side="right") - 1
                order = np.lexsort((light, doc))
                light, doc = light[order], doc[order]
                new = np.ones(len(doc), bool)
                new[1:] = (light[1:] != light[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays(
                    [_long(light[new]), pa.array(ids[rows][doc[new]].astype(np.int64))], names=["h", "doc_id"])

    return docs.where("doc_id is not null").mapInArrow(run, "h long, doc_id long")


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, hs``: the anchors of each document that another one has too."""
    shared = document_anchors(docs, window).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (document_anchors(docs, window).join(shared.select("h"), "h")
            .groupBy("doc_id").agg(F.collect_set("h").alias("hs")))


def repeated_phrases(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``w, doc_id, place``: hashes of the phrases whose anchor is in ``wanted``
    (``shared_anchors``).

    ``place`` is the first word of the phrase's first occurrence.  Where rows
    share an id, it lies under a checksum of the text, so that no run of places
    goes from one of them to another.
    """
    rows = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in unpack_texts(whole)):
            ids = _ids(batch)
            lists, shares = batch.column(2), batch.column(3).to_numpy(zero_copy_only=False) > 1
            for rows, data, off in text_slices(batch, "text"):
                words, first = word_hashes(data, off)
                starts, light, _ = anchors(words, first, window)
                phrases = gram_hashes(words, window)[starts]
                bounds = np.searchsorted(starts, first)
                out, of, places = [], [], []
                for i in range(rows.stop - rows.start):
                    a, b = bounds[i], bounds[i + 1]
                    hs = lists[rows.start + i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    mine = np.flatnonzero(np.isin(light[a:b], hs))
                    found, at = np.unique(phrases[a:b][mine], return_index=True)
                    text = zlib.crc32(data[off[i]:off[i + 1]]) & 0x7FFFFFFF if shares[rows.start + i] else 0
                    out.append(found)
                    places.append((starts[a:b][mine[at]] - first[i]) + (text << 32))
                    of.append(np.full(len(found), ids[rows.start + i], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [_long(np.concatenate(out)), pa.array(np.concatenate(of)),
                     pa.array(np.concatenate(places).astype(np.int64))], names=["w", "doc_id", "place"])

    texts = pack_texts(docs.where("doc_id is not null").select("doc_id", "text"))
    wanted = wanted.join(rows, "doc_id")
    return texts.join(wanted, "doc_id").select("doc_id", "text", "hs", "n_rows").mapInArrow(run, "w long, doc_id long, place long")


def parse(phrases: np.ndarray, starts: np.ndarray, index: np.ndarray, source: np.ndarray, place: np.ndarray,
          window: int) -> list[tuple[int, int, int, int]]:
    """Factors (start, length, source document, first word there) of one document.

    ``index`` (ascending) holds the phrase hashes that an earlier document
    has, ``source`` and ``place`` where.  Greedy: a factor opens at the first
    indexed phrase and takes each next phrase that is the next one of its
    block; the phrase after its last one is looked up like any other, though
    it begins inside the factor.
    """
    if not len(index) or not len(phrases):
        return []
    at = np.minimum(np.searchsorted(index, phrases), len(index) - 1)
    hit = np.flatnonzero(index[at] == phrases)
    if not len(hit):
        return []
    of, to = source[at[hit]], place[at[hit]]
    word = to & 0xFFFFFFFF
    ends = ((np.diff(starts[hit]) > 1) | (of[1:] != of[:-1]) | (np.diff(to) != 1)
            | (word[1:] // BLOCK_WORDS != word[:-1] // BLOCK_WORDS))
    first = np.append(0, np.flatnonzero(ends) + 1)
    last = np.append(first[1:], len(hit)) - 1
    return [(int(starts[hit[a]]), int(b - a) + window, int(of[a]), int(word[a])) for a, b in zip(first, last)]


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                     text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """Find and remove word runs that an earlier document holds.

    Every word covered by a ``window``-word phrase that also starts in a
    document with a smaller id is removed; phrases are judged on the input.
    Words are runs of bytes other than 0x20 and 0x09–0x0D.  Returns one row
    per input row: ``doc_id, n_words, n_removed, kept`` (kept words joined by
    one space), ``spans`` (array of start word, length, source document),
    ``places`` (the first word of each span in its source) and the columns
    named in ``carry``.  A span is a factor of the parse: its source holds all
    of its words in a row; spans may overlap.

    Null text is empty text.  A row without an id is kept whole and removes
    nothing; rows with the same id never remove each other's words, and a span
    that names such an id lies in one of them; further columns are ignored; an empty table gives an empty result.  A passage
    that a third of all documents share is reduced before the shuffle to its
    smallest document, and its join back is one that AQE can split.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # each step is written and what it was made of removed, so that no two steps' shuffles are on disk at once
    wanted = materialize(shared_anchors(base, window), "anchors")
    phrases = materialize(repeated_phrases(base, wanted, window), "phrases")
    release(wanted)
    index = materialize(phrases.groupBy("w").agg(F.min("doc_id").alias("source"), F.min_by("place", "doc_id").alias("place"),
                                                 F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("w", "source", "place"), "index")
    hits = materialize(phrases.select("w", "doc_id").join(index, "w").where("source < doc_id"), "hits")
    release(phrases, index)
    found = hits.groupBy("doc_id").agg(F.collect_list(F.struct("w", "source", "place")).alias("hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source", pa.int64())])
        for batch in (part for whole in batches for part in unpack_texts(whole)):
            hits = batch.column(2)
            for rows, data, off in text_slices(batch, "text"):
                words, first = word_hashes(data, off)
                starts = np.flatnonzero(within(first, window, len(words)))
                hashes = gram_hashes(words, window)[starts].view(np.int64)
                bounds = np.searchsorted(starts, first)
                n_words, n_removed, kept, spans, places = [], [], [], [], []
                for i in range(rows.stop - rows.start):
                    own = bytes(data[off[i]:off[i + 1]]).split()
                    factors = []
                    if hits[rows.start + i].is_valid:
                        pairs = hits[rows.start + i].values
                        w = pairs.field("w").to_numpy(zero_copy_only=False)
                        order = np.argsort(w)
                        a, b = bounds[i], bounds[i + 1]
                        factors = parse(hashes[a:b], starts[a:b] - first[i], w[order],
                                        pairs.field("source").to_numpy(zero_copy_only=False)[order],
                                        pairs.field("place").to_numpy(zero_copy_only=False)[order], window)
                    n_words.append(len(own))
                    if factors:
                        stay = np.ones(len(own), bool)
                        for start, length, *_ in factors:
                            stay[start:start + length] = False
                        own = [own[j] for j in np.flatnonzero(stay)]
                    n_removed.append(n_words[-1] - len(own))
                    kept.append(b" ".join(own).decode("utf-8", "replace"))
                    spans.append([{"start": s, "length": n, "source": d} for s, n, d, _ in factors])
                    places.append([p for *_, p in factors])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows.start, rows.stop - rows.start), pa.array(n_words, pa.int64()),
                     pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(span)),
                     pa.array(places, pa.list_(pa.int64())), *texts_of(batch, rows), *(c.slice(rows.start, rows.stop - rows.start) for c in batch.columns[4:])],
                    names=["doc_id", "n_words", "n_removed", "kept", "spans", "places", *(["_text"] if with_text else []),
                           *batch.schema.names[4:]])

    def texts_of(batch: pa.RecordBatch, rows: slice) -> list[pa.Array]:
        if not with_text:
            return []
        n = rows.stop - rows.start
        pairs = zip(batch.column(1).slice(rows.start, n).to_pylist(), batch.column(3).slice(rows.start, n).to_pylist())
        return [pa.array([None if null else text.decode() for text, null in pairs], pa.string())]

    # the text travels once, packed, also where it is to be carried
    with_text = text_col in carry
    rest = [c for c in carry if c != text_col]
    text = F.col(text_col).cast("string")
    more = pack_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                                  text.isNull().alias("_null"), *carried(rest)))
    joined = more.join(found.hint("shuffle_hash"), "doc_id", "left").select(
        "doc_id", "text", "hits", "_null", *(c for c in more.columns if c.startswith("_carry")))
    out = joined.mapInArrow(run, carried_schema(
        joined, "doc_id long, n_words long, n_removed long, kept string, "
                "spans array<struct<start:long,length:long,source:long>>, places array<long>" + (", _text string" if with_text else "")))
    names = {c: restored(rest)[i] for i, c in enumerate(rest)} | {text_col: F.col("_text").alias(text_col)}
    return out.select("doc_id", "n_words", "n_removed", "kept", "spans", "places", *[names[c] for c in carry])


def kept_sha256(kept: str = "kept"):
    """Lower-case hex digest of the kept words."""
    return F.sha2(F.col(kept).cast("binary"), 256)
