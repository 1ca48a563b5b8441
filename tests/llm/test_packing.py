import zlib

import numpy as np
import pytest
from tests.llm.data import corpus, docs

public_tokenizers = pytest.importorskip("public_tokenizers")

from riskweave.llm.packing import SumOfSquares, pack_documents  # noqa: E402
from riskweave.llm.queries import bpe_files, packed  # noqa: E402


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_pieces_cover_every_id_once_and_windows_are_gapless(spark):
    rows = corpus() + [(4000, "<|endoftext|> it's  2 spaces \n\n and 日本語 👍 ")]
    df = docs(spark, rows).repartition(3)
    got = pack_documents(df, *bpe_files(), size=64).collect()
    want = sorted((str(i), reference_ids(t).tobytes()) for i, t in rows)
    whole = {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start)):
        assert r.length * 4 == len(r.ids) and 0 < r.length <= 64
        whole.setdefault(str(r.doc_id), []).append((r.start, r.ids, r.doc_tokens))
    # repeated ids interleave; compare the multiset of id bytes per document
    for key in {k for k, _ in want}:
        assert sum(len(x[1]) for x in whole[key]) == sum(len(b) for k, b in want if k == key)
    for key, ids in want:
        if sum(k == key for k, _ in want) == 1:
            pieces = sorted(whole[key])
            assert b"".join(p[1] for p in pieces) == ids
            assert all(p[2] * 4 == len(ids) for p in pieces)
            assert [p[0] for p in pieces] == list(np.cumsum([0] + [len(p[1]) // 4 for p in pieces[:-1]]))
    by_window = {}
    for r in got:
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    short = 0
    for pieces in by_window.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces[:-1]]))
        total = sum(n for _, n in pieces)
        assert total <= 64
        short += total < 64
    assert short <= 3  # one per task


def test_query_checksum_and_empty_table(spark):
    row = packed(docs(spark, [(1, "a b")])).first()
    assert row.ids_crc32 == zlib.crc32(reference_ids("a b").tobytes()) and row.doc_tokens == 3
    assert packed(docs(spark, [])).count() == 0
    assert [tuple(r) for r in packed(docs(spark, [(5, None)])).select("doc_id", "length").collect()] == [(5, 1)]


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    p, size = SumOfSquares(20), 20
    for s in rng.integers(1, 20, 400):
        before = p.level.copy()

        def cost(h):
            n = before.copy()
            if h:
                n[h] -= 1
            if h + s < size:
                n[h + s] += 1
            return int((n[1:size] ** 2).sum())

        options = [cost(h) for h in range(size - s + 1) if h == 0 or before[h]]
        full = p.place(("d", 0, int(s), b"", 0), int(s))
        assert int((p.level[1:size] ** 2).sum()) == min(options)
        assert full is None or sum(x[2] for x in full) == size
