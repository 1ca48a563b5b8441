"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Pieces and scores come from a public model file; the agenda is our own, since
the library's sampling cannot be seeded per text.  Merges of a chunk leave an
agenda in score order (ties: leftmost first); a merge that comes up is skipped
for good if a hash of (seed, text, place of the chunk, place of the merge)
falls below the rate, so each occurrence of a word draws its own.  Every
segmentation is made of vocabulary pieces and bytes, so it decodes to the very
text.

The agendas of all short chunks of a batch of texts run side by side in tables,
one merge of every chunk at a time; long chunks and those with characters that
no piece holds run one by one.
"""

from __future__ import annotations

import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import mix64, worker_cache

SPACE = "\u2581"
#: Runs of the agenda that a worker remembers (``variants`` only), and the longest
#: chunk that is merged in a table or remembered.
CACHE_ENTRIES = 150_000
CACHE_CHARS = 40
#: Characters of the texts whose merges are drawn at once (one text at least).
BATCH_CHARS = 1 << 20
#: A run of spaces with the word after it; no piece of the model crosses these borders.
_CHUNK = re.compile(r" *[^ \n]+|\n| +")
_M64 = (1 << 64) - 1


#: Rank of a pair that is no piece; no symbol, and the place after the last one.
NEVER = np.int32(2 ** 31 - 1)
NONE, END = -1, -2
#: Widths of the tables in which chunks of like lengths are merged together.
WIDTHS = (4, 8, 12, 16, 24, CACHE_CHARS)


class PairTable:
    """(rank, merged piece) of two adjacent pieces, for whole arrays: a hash
    table with linear probing."""

    BITS = 21

    def __init__(self, pairs: dict[int, tuple[int, int]], pieces: int) -> None:
        self.pieces = pieces
        size = 1 << self.BITS
        if len(pairs) * 2 > size:
            raise ValueError("too many pairs of pieces")
        self.code = np.full(size, -1, np.int64)
        self.rank = np.full(size, NEVER, np.int32)
        self.piece = np.full(size, NONE, np.int32)
        codes = np.fromiter(pairs, np.int64, len(pairs))
        slots, self.depth = self._slot(codes).tolist(), 1
        used = {}
        for code, slot in zip(codes.tolist(), slots):
            at, probes = slot, 1
            while at in used:
                at, probes = (at + 1) % size, probes + 1
            used[at] = code
            self.depth = max(self.depth, probes)
            self.code[at], (self.rank[at], self.piece[at]) = code, pairs[code]

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = a.astype(np.int64) * self.pieces + b
        codes[(a < 0) | (b < 0)] = -3
        at = self._slot(codes)
        open_ = np.flatnonzero((self.code[at] != codes) & (self.code[at] >= 0))
        for _ in range(self.depth):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.BITS) - 1)
            here = self.code[at[open_]]
            open_ = open_[(here != codes[open_]) & (here >= 0)]
        hit = self.code[at] == codes
        return np.where(hit, self.rank[at], NEVER), np.where(hit, self.piece[at], NONE)


class MergeDropout:
    """Encoder and decoder of one model.

    With ``variants`` 0 each occurrence of a chunk draws its own merges; a
    positive number bounds how many segmentations a chunk has under one seed
    (the n-th chunk of a text takes ``(hash of the text + n) % variants``).
    """

    def __init__(self, model: str, rate: float, seed: int, variants: int = 0) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        self.limit = int(rate * 2 ** 64)
        self.seed, self.variants = seed, variants
        self.ids, self.rank, self.bytes_of = {}, {}, [b""] * size
        self.byte_id = [0] * 256
        plain = []
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses a chunk border")
                self.ids[piece] = i
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                plain.append((-sp.get_score(i), piece))
        order = -1
        before = None
        for score, piece in sorted(plain):
            order += score != before
            before = score
            self.rank[piece] = order
        self.cache: dict = {}
        self.entries = 0
        # pieces of one character by code point, and all pairs of pieces that make a piece
        ones = sorted((ord(c), i) for c, i in ((" " if p == SPACE else p, i) for p, i in self.ids.items()) if len(c) == 1)
        self.letters = np.array([c for c, _ in ones], np.int64)
        self.letter_ids = np.array([i for _, i in ones], np.int32)
        pairs = {self.ids[p[:k]] * size + self.ids[p[k:]]: (r, self.ids[p]) for p, r in self.rank.items()
                 for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = PairTable(pairs, size)

    def _dropped(self, h: int) -> bool:
        """Whether the hash of an occurrence and a merge's place falls below the rate."""
        h = ((h ^ (h >> 31)) * 0x7FB5D329728EA185) & _M64
        h = ((h ^ (h >> 27)) * 0x81DADEF4BC2DD44D) & _M64
        return h ^ (h >> 33) < self.limit

    def _merge(self, symbols: list, key: int | None, skip: frozenset = frozenset(),
               steps: list | None = None) -> list:
        """Symbols after the agenda; ``None`` symbols never merge.

        Merges are dropped by ``key``; without one, those in ``skip`` are.
        ``steps`` takes the places of all merges that come up, dropped or not.
        """
        n, rank, limit = len(symbols), self.rank.get, self.limit
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        length = [1] * n
        agenda = []
        for i in range(n - 1):
            a, b = symbols[i], symbols[i + 1]
            if a and b:
                r = rank(a + b)
                if r is not None:
                    agenda.append((r, i, 1, 1))
        heapq.heapify(agenda)
        while agenda:
            r, i, la, lb = heapq.heappop(agenda)
            j = i + la
            if length[i] != la or j >= n or length[j] != lb:
                continue  # one side has been merged since
            if limit:
                place = (i * 0x9E3779B97F4A7C15 + (j + lb) * 0xC2B2AE3D27D4EB4F + j) & _M64
                if steps is not None:
                    steps.append(place)
                if place in skip if key is None else self._dropped(key ^ place):
                    continue
            symbols[i] += symbols[j]
            length[i] = la + lb
            length[j] = 0
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if symbols[k]:
                    q = rank(symbols[i] + symbols[k])
                    if q is not None:
                        heapq.heappush(agenda, (q, i, length[i], length[k]))
            p = left[i]
            if p >= 0 and symbols[p]:
                q = rank(symbols[p] + symbols[i])
                if q is not None:
                    heapq.heappush(agenda, (q, p, length[p], length[i]))
        return [(i, symbols[i]) for i in range(n) if length[i]]

    def _ids(self, chunk: str, key: int | None, skip: frozenset = frozenset(), steps: list | None = None) -> bytes:
        known = self.ids
        symbols = [SPACE if c == " " else c if c != SPACE and c in known else None for c in chunk]
        out = array("I")
        for i, s in self._merge(symbols, key, skip, steps):
            if s is None:
                out.extend(self.byte_id[b] for b in chunk[i].encode())
            else:
                out.append(known[s])
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _run(self, chunk: str, skip: frozenset = frozenset()) -> tuple[list, bytes, frozenset, dict]:
        """(merges that come up, ids, dropped merges, runs with one more dropped) if ``skip`` is dropped."""
        self.entries += 1
        steps: list = []
        ids = self._ids(chunk, None, skip, steps)
        return steps, ids, skip, {}

    def chunk_ids(self, chunk: str, key: int) -> bytes:
        """Ids of the occurrence ``key`` of a chunk."""
        if len(chunk) > CACHE_CHARS:
            return self._ids(chunk, key)
        run = self.cache.get(chunk)
        if run is None:
            if self.entries >= CACHE_ENTRIES:
                self.cache.clear()
                self.entries = 0
            run = self.cache[chunk] = self._run(chunk)
        at = 0
        while True:
            steps, ids, skip, more = run
            for at in range(at, len(steps)):
                place = steps[at]
                if place not in skip and self._dropped(key ^ place):
                    break
            else:
                return ids
            # up to this merge the run with it dropped is the same
            run = more.get(place)
            if run is None:
                run = self._run(chunk, skip | {place})
                if self.entries < CACHE_ENTRIES:
                    more[place] = run

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        """Piece of each code point, or its byte if that is one (bytes are part
        of no pair), else ``NONE``."""
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        byte = np.where(codes < 128, np.array(self.byte_id)[np.minimum(codes, 127)], NONE)
        return np.where(self.letters[at] == codes, self.letter_ids[at], byte).astype(np.int32)

    def _agenda(self, symbols: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """``_merge`` for a table of chunks, a row each (``symbols`` padded with
        ``END`` and one column wider than the longest): one merge that comes up
        in every row at a time.  Returns the table of pieces, ``END`` where a
        symbol has been merged into another."""
        n, width = symbols.shape
        ranks, pieces = (x.reshape(n, width - 1) for x in self.pairs.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
        after = np.tile(np.arange(1, width + 1, dtype=np.int64), (n, 1))
        before = np.tile(np.arange(-1, width - 1, dtype=np.int64), (n, 1))
        rows = np.arange(n)
        while len(rows):
            at = ranks[rows].argmin(axis=1)
            going = ranks[rows, at] != NEVER
            rows, at = rows[going], at[going]
            right = after[rows, at]
            end = after[rows, right]  # the place after both: the length of the chunk if nothing follows
            if self.limit:
                place = (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                         + end.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + right.astype(np.uint64))
                dropped = self._drops(keys[rows] ^ place)
                ranks[rows[dropped], at[dropped]] = NEVER
                stay = ~dropped
                r, i, j, k = rows[stay], at[stay], right[stay], end[stay]
            else:
                r, i, j, k = rows, at, right, end
            merged = pieces[r, i]
            symbols[r, i], symbols[r, j] = merged, END
            after[r, i] = k
            inner = j < width - 1
            ranks[r[inner], j[inner]] = NEVER
            has = k < lengths[r]
            before[r[has], k[has]] = i[has]
            ranks[r, i] = NEVER
            ranks[r[has], i[has]], pieces[r[has], i[has]] = self.pairs.find(merged[has], symbols[r[has], k[has]])
            p = before[r, i]
            has = p >= 0
            ranks[r[has], p[has]], pieces[r[has], p[has]] = self.pairs.find(symbols[r[has], p[has]], merged[has])
        return symbols

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, every occurrence of a chunk with its own draws."""
        whole = [" " + t for t in texts if t]
        if not whole:
            return [b""] * len(texts)
        codes = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        firsts = np.cumsum([0, *map(len, whole)])
        # a chunk starts with a text, at and after a line break, and at the first of some spaces
        line, space = codes == 10, codes == 32
        start = line | space
        start[1:] = line[1:] | line[:-1] | (space[1:] & ~space[:-1])
        start[firsts[:-1]] = True
        starts = np.flatnonzero(start)
        lengths = np.diff(np.append(starts, len(codes)))
        first_chunk = np.searchsorted(starts, firsts)
        base = np.array([xxhash.xxh3_64_intdigest(t[1:].encode("utf-8", "surrogatepass"), self.seed) for t in whole], np.uint64)
        of = np.repeat(np.arange(len(whole)), np.diff(first_chunk))
        number = (np.arange(len(starts)) - first_chunk[of] + 1).astype(np.uint64)
        keys = base[of] + number * np.uint64(0xD6E8FEB86659FD93)

        symbols = self._symbols(codes)
        odd = np.zeros(len(starts), bool)  # chunks that need bytes, or are long: one by one
        odd[np.searchsorted(starts, np.flatnonzero(symbols == NONE), side="right") - 1] = True
        odd |= lengths > CACHE_CHARS
        counts, found = np.zeros(len(starts), np.int64), []
        for low, width in zip((0, *WIDTHS), WIDTHS):
            chunks = np.flatnonzero((lengths > low) & (lengths <= width) & ~odd)
            for a in range(0, len(chunks), 1 << 15):
                some = chunks[a:a + (1 << 15)]
                cells = starts[some][:, None] + np.arange(width + 1)
                table = np.where(np.arange(width + 1) < lengths[some][:, None],
                                 symbols[np.minimum(cells, len(symbols) - 1)], END)
                ids = self._agenda(table, lengths[some], keys[some])
                counts[some] = (ids != END).sum(axis=1)
                found.append((some, ids[ids != END]))
        for i in np.flatnonzero(odd).tolist():
            chunk = codes[starts[i]:starts[i] + lengths[i]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            ids = np.frombuffer(self._ids(chunk, int(keys[i])), "<u4")
            counts[i] = len(ids)
            found.append((np.array([i]), ids))
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), "<u4")
        for some, ids in found:
            n = counts[some]
            out[np.repeat(ends[some] - n - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        bounds = np.append(0, ends)[first_chunk]
        parts = iter([out[a:z].tobytes() for a, z in zip(bounds, bounds[1:])])
        return [next(parts) if t else b"" for t in texts]

    def _drops(self, h: np.ndarray) -> np.ndarray:
        """``_dropped`` of many hashes."""
        return np.ones(len(h), bool) if self.limit >= 2 ** 64 else mix64(h) < np.uint64(self.limit)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers; the empty text has none."""
        if not text:
            return b""
        if not self.variants:
            return self.encode_many([text])[0]
        out = []
        base = xxhash.xxh3_64_intdigest(text.encode(), self.seed)
        for at, chunk in enumerate(_CHUNK.findall(" " + text), 1):
            key = xxhash.xxh3_64_intdigest(chunk.encode("utf-8", "surrogatepass"),
                                           self.seed * 65537 + (base + at) % self.variants)
            out.append(self.chunk_ids(chunk, key))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        numbers = array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        table = self.bytes_of
        return b"".join([table[i] for i in numbers])[1:].decode() if numbers else ""


def coder(model: str, rate: float, seed: int, variants: int) -> MergeDropout:
    """The worker's coder; its cache lives as long as the Python worker."""
    cache, key = worker_cache(), ("dropout", model, rate, seed, variants)
    if key not in cache:
        cache[key] = MergeDropout(model, rate, seed, variants)
    return cache[key]


def encode_documents(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0, variants: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, ids`` (little-endian unsigned 32-bit) of every whole text.

    ``rate`` 0 gives the model's own segmentation.  The result depends on
    (text, model, rate, seed, variants) only, not on partitions.  Null text is
    empty text and has no pieces; repeated rows are encoded alike; ids may be
    null; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(model, rate, seed, variants)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size, first = [], 0, at
                while at < batch.num_rows and (not texts or size < BATCH_CHARS):
                    texts.append(batch.column(1)[at].as_py() or "")
                    size += len(texts[-1])
                    at += 1
                part = batch.slice(first, at - first)
                ids = [mine.encode(t) for t in texts] if variants else mine.encode_many(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_pieces", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, n_pieces long, ids binary")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` with the text its ``ids`` stand for as ``decoded``."""
    kinds = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    where = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = coder(model, 0.0, 0, 1)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [mine.decode(x.as_py() or b"") for x in part.column(where)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, f"{kinds}, decoded string")
