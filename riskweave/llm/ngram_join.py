"""N-gram Jaccard self-join of documents by MinHash banding.

1. Every document becomes its set of word n-gram hashes and a MinHash
   signature.  Documents with the same set are one *entity* from here on.
2. Entities that share a band hash are candidates; they are only linked to
   the smallest entity of their band bucket, and union-find turns these stars
   into candidate *groups*.
3. Each group is cut into blocks of at most ``BLOCK`` entities.  Every pair
   of blocks is one task's work: it multiplies incidence matrices to get all
   exact intersections, keeps the pairs that reach the threshold, and returns
   a count per entity and a spanning forest of the links it saw, never the
   pairs.
4. Union-find over those forests gives the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import (carried, checkpoint, components, gram_hashes, materialize, restored, text_slices,
                                  within, word_hashes)

#: Entities of one block of a candidate group.
BLOCK = 512
#: Columns of an incidence matrix that are held at a time.
COLUMNS = 8192


def banding(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows): the fewest bands of ``rows`` rows that find a pair at
    ``threshold`` with probability ``recall`` at least."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))), rows


def _signatures(docs: DataFrame, n: int, bands: int = 0, rows: int = 0, seed: int = 0,
                grams: bool = False) -> DataFrame:
    """``docs`` with ``entity`` (digest of the n-gram set; null without words)
    in place of ``text``, and with ``bands`` or ``grams`` where asked for."""
    rng = np.random.default_rng(seed)
    mult = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    keep = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["entity binary"]
                       + ["bands array<long>"] * bool(bands) + ["grams binary"] * grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sl, data, off in text_slices(batch, "text"):
                words, first = word_hashes(data, off)
                count = np.diff(first)
                value = gram_hashes(words, n)
                whole = np.flatnonzero(within(first, n, len(words)))
                doc = np.searchsorted(first, whole, side="right") - 1
                value = value[whole]
                # fewer words than n: the whole word sequence is the only gram
                for d in np.flatnonzero((count > 0) & (count < n)):
                    own = gram_hashes(words[first[d]:first[d + 1]], int(count[d]))
                    value, doc = np.append(value, own ^ np.uint64(count[d])), np.append(doc, d)
                order = np.lexsort((value, doc))
                value, doc = value[order], doc[order]
                new = np.ones(len(doc), bool)
                new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
                value, doc = value[new], doc[new]
                some, start = np.unique(doc, return_index=True)
                sig = np.empty((len(some), bands * rows), np.uint64)
                if len(some):
                    for k in range(bands * rows):
                        sig[:, k] = np.minimum.reduceat(value * mult[k] + add[k], start)
                ends = np.append(start[1:], len(value))
                m = sl.stop - sl.start
                entity, hashes, sets = [None] * m, [None] * m, [None] * m
                for j, d in enumerate(some.tolist()):
                    raw = value[start[j]:ends[j]].tobytes()
                    entity[d] = xxhash.xxh3_128_digest(raw)
                    if bands:
                        hashes[d] = [xxhash.xxh3_64_intdigest(sig[j, b * rows:(b + 1) * rows].tobytes(), b)
                                     - (1 << 63) for b in range(bands)]
                    if grams:
                        sets[d] = raw
                cols = [batch.column(batch.schema.get_field_index(c)).slice(sl.start, m) for c in keep]
                cols.append(pa.array(entity, pa.binary()))
                if bands:
                    cols.append(pa.array(hashes, pa.list_(pa.int64())))
                if grams:
                    cols.append(pa.array(sets, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    cols, names=keep + ["entity"] + ["bands"] * bool(bands) + ["grams"] * grams)

    return docs.mapInArrow(run, schema)


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections of two lists of sorted sets."""
    va, vb = np.concatenate(a), np.concatenate(b)
    ra = np.repeat(np.arange(len(a)), [len(x) for x in a])
    rb = np.repeat(np.arange(len(b)), [len(x) for x in b])
    shared = np.intersect1d(va, vb)
    ka, kb = np.searchsorted(shared, va), np.searchsorted(shared, vb)
    if len(shared):
        ina = shared[np.minimum(ka, len(shared) - 1)] == va
        inb = shared[np.minimum(kb, len(shared) - 1)] == vb
        ra, ka, rb, kb = ra[ina], ka[ina], rb[inb], kb[inb]
    out = np.zeros((len(a), len(b)), np.float32)
    for lo in range(0, len(shared), COLUMNS):
        width = min(COLUMNS, len(shared) - lo)
        ma, mb = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        pa_, pb = (ka >= lo) & (ka < lo + width), (kb >= lo) & (kb < lo + width)
        ma[ra[pa_], ka[pa_] - lo] = 1
        mb[rb[pb], kb[pb] - lo] = 1
        out += ma @ mb.T
    return out.astype(np.int64)


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest (child, root) of the graph on 0 … n-1."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in pairs:
        x, y = find(int(x)), find(int(y))
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in range(n) if find(x) != x]


def _links(part, threshold: float) -> list[tuple]:
    """Links of one pair of blocks: (entity, weighted count, root in the forest)."""
    part = part.drop_duplicates(["entity", "side"])
    left, right = part[part["side"] != 2], part[part["side"] != 1]
    a = [np.frombuffer(x, np.uint64) for x in left["grams"]]
    b = [np.frombuffer(x, np.uint64) for x in right["grams"]]
    if not a or not b:
        return []
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    both = intersections(a, b)
    linked = both >= threshold * (size_a[:, None] + size_b[None, :] - both) - 1e-9
    same = bool((part["side"] == 0).any())
    if same:  # a block with itself
        np.fill_diagonal(linked, False)
    names, other = left["entity"].tolist(), right["entity"].tolist()
    count = (linked @ right["copies"].to_numpy()).tolist()
    pairs = np.argwhere(linked)
    if not same:
        pairs[:, 1] += len(names)
        names = names + other
        count += (linked.T @ left["copies"].to_numpy()).tolist()
    root = {names[c]: names[r] for c, r in _forest(len(names), pairs)}
    return [(x, c, root.get(x)) for x, c in zip(names, count) if c]


def _verify(threshold: float):
    """One task's block pairs, one after the other."""

    def run(pdf):
        rows = [r for _, part in pdf.groupby(["root", "i", "j"], sort=False) for r in _links(part, threshold)]
        return type(pdf)(rows, columns=["entity", "links", "root"])

    return run


def ngram_jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                       id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> DataFrame:
    """Classes of documents whose word ``n``-gram sets reach a Jaccard similarity.

    Returns one row per input row: ``doc_id, class_id`` (smallest id of the
    connected class) and ``n_links`` (other rows whose set has at least
    ``threshold`` similarity with this one's, copies included).

    Words are runs of bytes other than 0x20 and 0x09–0x0D; a text of fewer
    than ``n`` words has its whole word sequence as the one gram.  Null,
    empty and blank texts have no grams: they link to nothing and are their
    own class.  Repeated rows are copies of each other.  Null ids take part;
    a class has a null ``class_id`` only if all its ids are null.  Other
    columns are ignored; an empty table gives an empty result.

    Every pair at the threshold is a candidate with probability ``recall`` at
    least; verified pairs are exact.  Copies count once in all joins, so a
    group of copies of any size is one row after a map-side aggregate, and a
    large group of near copies is spread over block pairs.
    """
    return ngram_classes(docs, n, threshold, recall, id_col, text_col, seed).drop("class_key")


def ngram_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                  id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
                  carry: Sequence[str] = ()) -> DataFrame:
    """``ngram_jaccard_join`` with ``class_key``, which names the class whatever the ids (null: a text without
    grams, alone in its class), and the columns named in ``carry``."""
    bands, rows = banding(threshold, recall)
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text)).alias("fetch"))
    entities = materialize(
        _signatures(base, n, bands, rows, seed).where("entity is not null").groupBy("entity")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.min("fetch").alias("fetch"),
             F.first("bands").alias("bands")), "ngram-entities")
    tagged = entities.select("entity", F.explode("bands").alias("band"))
    buckets = (tagged.groupBy("band").agg(F.min("entity").alias("low"), F.max("entity").alias("high"))
               .where("low < high").select("band", "low"))
    stars = tagged.join(buckets, "band").where("entity <> low").select(
        F.col("entity").alias("u"), F.col("low").alias("v"))
    groups = components(stars)
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    placed = checkpoint(
        groups.join(sizes, "root").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumnRenamed("node", "wanted")
        .join(entities.select(F.col("entity").alias("wanted"), "fetch", "copies"), "wanted")
        .select("wanted", "root", "blocks", "block", "fetch", "copies"))
    shards = max(1, placed.count() // (4 * BLOCK))
    # only texts of candidates are looked at again
    grams = _signatures(base.select("text", "fetch").join(placed, "fetch").drop("fetch"), n, grams=True).where(
        "entity = wanted")
    pairs = grams.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", "entity", "grams", "copies",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"),
        # groups of one block share tasks; a pair of blocks of a larger group has its own
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(shards))).alias("task"),
        F.when(F.col("blocks") > 1, F.col("root")).alias("own")).withColumns({
            "ti": F.when(F.col("own").isNotNull(), F.col("i")), "tj": F.when(F.col("own").isNotNull(), F.col("j"))})
    checked = checkpoint(pairs.groupBy("task", "own", "ti", "tj").applyInPandas(
        _verify(threshold), "entity binary, links long, root binary"))
    links = checked.groupBy("entity").agg(F.sum("links").alias("links"))
    classes = components(checked.where("root is not null").select(F.col("entity").alias("u"), F.col("root").alias("v")))
    named = (entities.select("entity", "copies", "first")
             .join(classes.withColumnRenamed("node", "entity"), "entity", "left").join(links, "entity", "left")
             .withColumn("root", F.coalesce("root", "entity")))
    firsts = named.groupBy("root").agg(F.min("first").alias("class_id"))
    named = named.join(firsts, "root").select(
        "entity", F.col("root").alias("class_key"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *carried(carry))
    return (_signatures(every, n).join(named, "entity", "left")
            .select("doc_id", F.when(F.col("entity").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "class_key",
                    *restored(carry)))
