"""Spelling variants: words one letter apart, found by k-d trees over letter counts.

The word table is native Spark.  A word's letter counts are kept as bits in
unary (``e`` three times sets the bits e1, e2, e3), so a box of counts is a
pair of bit sets, the smaller and the larger of each count are AND and OR, and
L1 distances are bit counts.  One inserted letter moves one count by one; one
replaced letter moves one up and one down.  So the words near a word of length
L lie within one step up and one down among those of length L, and within one
step up among those of length L + 1; no other pair of lengths can be near.

Upper splits of a k-d tree per length, from a bounded sample, cut the words
into blocks; a word goes to its own block and, as a query, to the blocks whose
boxes it may reach.  In a block a task builds the lower part of the tree over
all of its words, prunes boxes for batches of queries at once, and verifies
letter order for what is left.  Counts above the bits of a letter are cut in
the vectors only, which can make boxes wider but never loses a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import materialize, release

#: Bits of each letter a–z, and bits and number of the classes that share the other code points.
LETTER_BITS, OTHER_BITS, OTHER_CLASSES = 4, 3, 29
WORDS64 = 3
#: Words of a block, blocks of all lengths together (blocks grow beyond that many), and words sampled for the upper splits.
BLOCK, BLOCKS, SAMPLE = 1 << 14, 1 << 12, 1 << 16
#: Words of a leaf of the lower tree, and queries of a batch.
LEAF, BATCH = 24, 1 << 13

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------------- words
def word_counts(docs: DataFrame, min_length: int = 7, min_count: int = 2, drop_one_in: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all whole texts: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``
    with A–Z in lower case.

    ``drop_one_in`` plants misspellings: where it divides the crc32 ``h`` of
    ``<doc_id>:<run>``, the run loses its code point ``h % length``.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.explode(F.regexp_extract_all(
        F.col(text_col).cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{min_length},}}"), F.lit(0))).alias("run"))
    # a word that a document repeats is one row from here on
    once = (runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run")).withColumn("size", F.length("run")))
    word = F.col("run")
    if drop_one_in:
        once = once.withColumn("h", F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.col("size")).cast("int")
        word = F.when(F.col("h") % drop_one_in == 0,
                      F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("size")))).otherwise(F.col("run"))
    return (once.select(word.alias("word")).where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ----------------------------------------------------------------- vectors
def code_points(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def letter_bits() -> np.ndarray:
    """(letter, count) of each bit; letters are 0–25, classes of other code points from 26."""
    bits = [(a, k) for a in range(26) for k in range(LETTER_BITS)]
    return np.array(bits + [(26 + c, k) for c in range(OTHER_CLASSES) for k in range(OTHER_BITS)])


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts in unary, as ``WORDS64`` 64-bit numbers a row."""
    letters = codes.astype(np.int64)
    letters = np.where((letters >= 97) & (letters <= 122), letters - 97, 26 + letters % OTHER_CLASSES)
    n, classes = len(codes), 26 + OTHER_CLASSES
    out = np.zeros((n, WORDS64), np.uint64)
    bits = letter_bits()
    for a in range(0, n, 4096):
        part = letters[a:a + 4096]
        counts = np.bincount((part + np.arange(len(part))[:, None] * classes).ravel(),
                             minlength=len(part) * classes).reshape(len(part), classes)
        flags = np.zeros((len(part), 64 * WORDS64), np.uint8)
        flags[:, :len(bits)] = counts[:, bits[:, 0]] > bits[:, 1]
        out[a:a + 4096] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
    return out


def bit_table(codes: np.ndarray) -> np.ndarray:
    """The bits of vectors, one byte each."""
    return np.unpackbits(np.ascontiguousarray(codes).view(np.uint8).reshape(len(codes), -1), axis=1, bitorder="little")


def masks() -> tuple[np.ndarray, np.ndarray]:
    """Per bit: what a count above it sets, and what a count not above it leaves."""
    bits = letter_bits()
    same = bits[:, 0][:, None] == bits[:, 0][None, :]
    low = np.zeros((len(bits), 64 * WORDS64), np.uint8)
    high = np.ones((len(bits), 64 * WORDS64), np.uint8)
    low[:, :len(bits)] = same & (bits[:, 1][None, :] <= bits[:, 1][:, None])
    high[:, :len(bits)] = ~(same & (bits[:, 1][None, :] >= bits[:, 1][:, None]))
    pack = lambda x: np.packbits(x, axis=1, bitorder="little").view(np.uint64)
    return pack(low), pack(high)


def reach(queries: np.ndarray, low: np.ndarray, high: np.ndarray, up: int, down: int) -> np.ndarray:
    """Which vectors lie within ``up`` steps up and ``down`` steps down of a box."""
    more = np.bitwise_count(low & ~queries).sum(axis=1)
    less = np.bitwise_count(queries & ~high).sum(axis=1)
    return (more <= up) & (less <= down)


def best_split(table: np.ndarray) -> int | None:
    """Bit (a letter and a count) that halves the vectors best; None if they are all equal."""
    ones = table.sum(axis=0, dtype=np.int64)
    bit = int(np.argmin(np.abs(2 * ones - len(table))))
    return bit if 0 < ones[bit] < len(table) else None


# ------------------------------------------------------------- upper trees
def upper_tree(sample: np.ndarray, leaves: int) -> list[tuple]:
    """Splits of one length into about ``leaves`` blocks, as nodes in preorder:
    ``(bit, right child)``, or ``(None, block)``."""
    nodes: list[tuple] = []
    table = bit_table(sample)
    blocks = 0

    def grow(rows: np.ndarray, parts: float) -> None:
        nonlocal blocks
        bit = best_split(table[rows]) if parts > 1 and len(rows) > 1 else None
        if bit is None:
            nodes.append((None, blocks))
            blocks += 1
            return
        at = len(nodes)
        nodes.append(())
        side = table[rows, bit] == 1
        share = side.mean()
        grow(rows[~side], parts * (1 - share))
        nodes[at] = (bit, len(nodes))
        grow(rows[side], parts * share)

    grow(np.arange(len(sample)), leaves)
    return nodes


def own_block(nodes: list[tuple], codes: np.ndarray) -> np.ndarray:
    """Block of each vector."""
    out = np.zeros(len(codes), np.int64)
    todo = [(0, np.arange(len(codes)))]
    while todo:
        node, rows = todo.pop()
        bit, child = nodes[node]
        if bit is None:
            out[rows] = child
            continue
        side = (codes[rows, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        todo += [(node + 1, rows[~side]), (child, rows[side])]
    return out


def reached_blocks(nodes: list[tuple], codes: np.ndarray, up: int, down: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, blocks): the blocks whose boxes each vector may reach."""
    above, below = masks()
    rows_out, blocks_out = [], []
    full = np.full(WORDS64, ~np.uint64(0))
    todo = [(0, np.arange(len(codes)), np.zeros(WORDS64, np.uint64), full)]
    while todo:
        node, rows, low, high = todo.pop()
        rows = rows[reach(codes[rows], low, high, up, down)]
        if not len(rows):
            continue
        bit, child = nodes[node]
        if bit is None:
            rows_out.append(rows)
            blocks_out.append(np.full(len(rows), child))
        else:
            todo += [(node + 1, rows, low, high & below[bit]), (child, rows, low | above[bit], high)]
    if not rows_out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows_out), np.concatenate(blocks_out)


# -------------------------------------------------------------- lower tree
class Tree:
    """k-d tree over the vectors of a block, with the exact box of every node."""

    def __init__(self, codes: np.ndarray) -> None:
        self.order = np.arange(len(codes))
        self.nodes: list[tuple] = []  # (low, high, first, last, right child or 0)
        table = bit_table(codes)
        stack = [(0, len(codes), -1)]
        while stack:
            first, last, parent = stack.pop()
            if parent >= 0:
                self.nodes[parent][4] = len(self.nodes)
            rows = self.order[first:last]
            part = codes[rows]
            node = [np.bitwise_and.reduce(part, axis=0), np.bitwise_or.reduce(part, axis=0), first, last, 0]
            self.nodes.append(node)
            bit = best_split(table[rows]) if last - first > LEAF else None
            if bit is not None:
                side = table[rows, bit] == 1
                self.order[first:last] = np.concatenate([rows[~side], rows[side]])
                middle = first + int((~side).sum())
                # the left child comes next, the right one when that is done
                stack += [(middle, last, len(self.nodes) - 1), (first, middle, -1)]
        self.codes = codes[self.order]

    def near(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, words) within the distance, leaf by leaf."""
        todo = [(0, np.arange(len(queries)))]
        while todo:
            at, rows = todo.pop()
            low, high, first, last, right = self.nodes[at]
            rows = rows[reach(queries[rows], low, high, up, down)]
            if not len(rows):
                continue
            if right:
                todo += [(at + 1, rows), (right, rows)]
                continue
            part = self.codes[first:last]
            for a in range(0, len(rows), 1 << 10):
                some = rows[a:a + (1 << 10)]
                for b in range(0, last - first, 1 << 8):  # a leaf of equal vectors may be long
                    away = np.bitwise_count(queries[some][:, None, :] ^ part[None, b:b + (1 << 8), :]).sum(axis=2)
                    q, m = np.nonzero(away <= up + down)
                    if len(q):
                        yield some[q], self.order[first + b + m]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether dropping one letter of ``long`` gives ``short``: their common
    beginning and end cover the shorter word."""
    n = short.shape[1]
    head = np.logical_and.accumulate(short == long[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


class Block:
    """All words of one block, and their links; rows are (word, n, near, best n, best word)."""

    def __init__(self, words: list[str], n: np.ndarray) -> None:
        self.words, self.n = np.array(words, object), n
        self.codes = code_points(words, len(words[0]))
        self.vectors = vectors(self.codes)
        self.tree = Tree(self.vectors)

    def links(self, points: np.ndarray, vecs: np.ndarray, down: int,
              after: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): same length and one letter replaced (``down`` is 1),
        or the query one letter shorter; only words of a number over
        ``after`` + query's, where given."""
        found_q, found_m = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for q, m in self.tree.near(vecs, 1, down):
            if after is not None:
                later = m > q + after
                q, m = q[later], m[later]
            good = one_replaced(points[q], self.codes[m]) if down else one_inserted(points[q], self.codes[m])
            found_q.append(q[good])
            found_m.append(m[good])
        return np.concatenate(found_q), np.concatenate(found_m)

    def own(self) -> Iterator[pa.RecordBatch]:
        """Every word once, and the links between them."""
        none = np.zeros(len(self.words), np.int64)
        yield linked_rows(self.words, self.n, none, None, None)
        parts = [(q + a, m) for a in range(0, len(self.words), BATCH)
                 for q, m in [self.links(self.codes[a:a + BATCH], self.vectors[a:a + BATCH], 1, a)]]
        q, m = (np.concatenate(x) for x in zip(*parts))
        yield from best_links(np.concatenate([q, m]), self.words, np.concatenate([m, q]), self.words, self.n)

    def queries(self, down: int, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links with words of other blocks, for both sides."""
        points = code_points(words, len(words[0]))
        q, m = self.links(points, vectors(points), down)
        others = np.array(words, object)
        yield from best_links(q, others, m, self.words, self.n)
        yield from best_links(m, self.words, q, others, n)


LINK_SCHEMA = "word string, n long, near long, best_n long, best string"


def linked_rows(words, n, near, best_n, best) -> pa.RecordBatch:
    void = pa.nulls(len(words), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), void if n is None else pa.array(n, pa.int64()), pa.array(near, pa.int64()),
         void if best_n is None else pa.array(best_n, pa.int64()),
         pa.nulls(len(words), pa.string()) if best is None else pa.array(best, pa.string())],
        names=["word", "n", "near", "best_n", "best"])


def best_links(side: np.ndarray, words: np.ndarray, other: np.ndarray, other_words: np.ndarray,
               other_n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per word of a side: its partners, and the one of largest n
    (ties: the smallest in code-point order)."""
    if not len(side):
        return
    rank = np.empty(len(other_words), np.int64)
    rank[np.argsort(other_words)] = np.arange(len(other_words))
    order = np.lexsort((rank[other], -other_n[other], side))
    side, other = side[order], other[order]
    first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
    yield linked_rows(words[side[first]], None, np.diff(np.r_[first, len(side)]), other_n[other[first]],
                      other_words[other[first]])


# ------------------------------------------------------------------ the job
KEYS = ("size", "block", "part")


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, list[str], np.ndarray]]:
    """(block, role, words, counts) of rows sorted by block and role, a batch at most each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, z in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
            yield (tuple(keys[:3, a]), int(keys[3, a]), batch.column(4).slice(a, z - a).to_pylist(),
                   batch.column(5).slice(a, z - a).to_numpy(zero_copy_only=False))


def search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the blocks of a partition; a task holds one block and one batch of queries."""
    key, words, counts, block = None, [], [], None
    for here, role, some, n in segments(batches):
        if here != key:
            if words and block is None:
                yield from Block(words, np.concatenate(counts)).own()
            key, words, counts, block = here, [], [], None
        if role == 0:
            words += some
            counts.append(n)
        elif words:
            if block is None:
                block = Block(words, np.concatenate(counts))
                yield from block.own()
            yield from block.queries(1 if role == 1 else 0, some, n)
    if words and block is None:
        yield from Block(words, np.concatenate(counts)).own()


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, vectors) of a batch of words."""
    words = batch.column(0).to_pylist()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, vectors(code_points([words[i] for i in rows], int(size)))


def word_hash(words: pa.Array) -> np.ndarray:
    """A number of each word that deals out the words of a crowded block."""
    import zlib

    return np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, n_near, best_n, best`` of distinct words: how many words are
    one inserted, deleted or replaced code point away, and the one of largest
    ``n`` (ties: the smallest in code-point order).

    ``words`` is ``word, n``, one row a word, without nulls and empty words,
    and is read several times.
    """
    total = words.count()
    size = max(block, -(-total // BLOCKS))
    # lengths with more words than a block: as many as blocks at most
    crowded = {r.size: r.n for r in words.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > size).collect()}
    every = -(-total // SAMPLE)
    sample = words.where(F.length("word").isin(list(crowded)) & (F.pmod(F.xxhash64("word"), F.lit(every)) == 0))
    by_size: dict[int, list[str]] = {}
    for r in (sample.select("word").collect() if crowded else []):
        by_size.setdefault(len(r.word), []).append(r.word)
    trees = {k: upper_tree(vectors(code_points(sorted(v), k)), -(-crowded[k] // size)) for k, v in by_size.items()}
    one = [(None, 0)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, rows, vecs in by_length(batch):
                own = own_block(trees.get(length, one), vecs)
                blocks, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(blocks), length), pa.int64()), pa.array(blocks, pa.int64()),
                     pa.array(n, pa.int64())], names=["size", "block", "n"])

    # blocks that the sample judged wrongly, or whose words hardly differ in their letters, are cut by a hash
    placed = words.mapInArrow(place, "size long, block long, n long").groupBy("size", "block").agg(F.sum("n").alias("n"))
    parts = {(r["size"], r["block"]): -(-r["n"] // size) for r in placed.where(F.col("n") > 2 * size).collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from dealt(batch, trees, parts)

    rows = words.mapInArrow(deal, "size long, block long, part long, role long, word string, n long")
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (rows.repartition(n, *KEYS).sortWithinPartitions(*KEYS, "role")
             .mapInArrow(search_blocks, LINK_SCHEMA))
    best = F.min(F.when(F.col("best_n").isNotNull(), F.struct(-F.col("best_n"), "best"))).alias("best")
    return (found.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best)
            .select("word", "n", "n_near", (-F.col("best.col1")).alias("best_n"), F.col("best.best").alias("best")))


def dealt(batch: pa.RecordBatch, trees: dict[int, list[tuple]],
          parts: dict[tuple, int]) -> Iterator[pa.RecordBatch]:
    """Each word as a member of its block (role 0), and as a query of the later
    blocks of its length (1) and of the blocks of the next length (2) that it
    may reach; of a block cut in parts, a member of one and a query of all."""
    hashes = word_hash(batch.column(0))
    for length, rows, vecs in by_length(batch):

        def out(size, at, blocks, part, role):
            take = pa.array(rows[at])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), size)), pa.array(blocks), pa.array(part), pa.array(np.full(len(at), role)),
                 batch.column(0).take(take), batch.column(1).take(take)], names=[*KEYS, "role", "word", "n"])

        nodes, cut = tree_of(trees, parts, length)
        own = own_block(nodes, vecs)
        sub = hashes[rows] % cut[own]
        yield out(length, np.arange(len(rows)), own, sub, 0)
        at, to, part = spread(*reached_blocks(nodes, vecs, 1, 1), cut)
        later = (to > own[at]) | (to == own[at]) & (part > sub[at])
        yield out(length, at[later], to[later], part[later], 1)
        nodes, cut = tree_of(trees, parts, length + 1)
        at, to, part = spread(*reached_blocks(nodes, vecs, 1, 0), cut)
        yield out(length + 1, at, to, part, 2)


def tree_of(trees: dict[int, list[tuple]], parts: dict[tuple, int], length: int) -> tuple[list[tuple], np.ndarray]:
    """Upper tree of a length (one block, if it has none) and the parts of its blocks."""
    nodes = trees.get(length, [(None, 0)])
    blocks = [child for bit, child in nodes if bit is None]
    return nodes, np.array([parts.get((length, b), 1) for b in sorted(blocks)], np.int64)


def spread(at: np.ndarray, to: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every part of every block."""
    times = cut[to]
    first = np.repeat(np.cumsum(times) - times, times)
    return np.repeat(at, times), np.repeat(to, times), np.arange(times.sum()) - first


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: where following forms ends.

    Pointers are doubled, so a chain of n forms takes log2 n rounds; a chain
    of forms that are each ten times as frequent is short.
    """
    now = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        release(now)
        now = step.select("word", "root")
        now._spilled = step._spilled
        if not step.where("moved").limit(1).count():
            return now


def spelling_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10,
                      drop_one_in: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of all texts, with the form that each is likely a variant of.

    Words are those of ``word_counts`` with ``min_length`` code points and
    ``min_count`` occurrences at least.  Two are near if one code point
    inserted, deleted or replaced turns one into the other.  A word's form is
    its near word of largest count (ties: the smallest in code-point order) if
    that is ``ratio`` times its own at least, else null; its root is where
    following forms ends.  Returns ``word, form, root, n, n_near, form_n``.

    Null text has no words; the words of repeated rows count as often as they
    occur, and a null id counts as an empty one; very long runs are words like
    any other.  Further columns are ignored; an empty table gives an empty
    result.
    """
    words = materialize(word_counts(docs, min_length, min_count, drop_one_in, id_col, text_col), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    release(words)
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    per = near.select("word", form.alias("form"), "n", F.col("n_near").cast("long").alias("n_near"),
                      F.when(form.isNotNull(), F.col("best_n")).alias("form_n"))
    found = roots(per.where("form is not null"))
    return per.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
