import pytest
from tests.llm.data import corpus, docs

public_tokenizers = pytest.importorskip("public_tokenizers")

from riskweave.llm.dropout import MergeDropout, decode_documents, encode_documents  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a  b", "line\nbreak\n\n", "▁ literal ▁▁ marks", "日本語 👍🏽 ünï", "<s> </s> <unk> <0x41>", "a" * 3000,
         "the quick brown fox " * 50, "\t\x00\x1f odd", "trailing ", "  wide"]


def test_rate_zero_is_the_model_itself():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coder = MergeDropout(MODEL, 0.0, 0, 1)
    for t in TEXTS + [t for _, t in corpus() if t]:
        if t.strip() and "▁" not in t and "\x00" not in t:
            import numpy as np

            assert np.frombuffer(coder.encode(t), "<u4").tolist() == sp.encode(t), t


def test_dropout_varies_and_decodes_exactly():
    plain = MergeDropout(MODEL, 0.0, 0, 1)
    seeds = [MergeDropout(MODEL, 0.3, s, 4) for s in (1, 2)]
    for t in TEXTS + [t for _, t in corpus() if t]:
        for c in [plain, *seeds]:
            assert c.decode(c.encode(t)) == t
    text = "the quick brown fox " * 50
    a, b = (c.encode(text) for c in seeds)
    assert a != b and a == MergeDropout(MODEL, 0.3, 1, 4).encode(text)
    assert len(a) > len(plain.encode(text))
    assert MergeDropout(MODEL, 1.0, 1, 1).encode("ab") == b"".join(plain.chunk_ids(c, 0) for c in ()) + \
        MergeDropout(MODEL, 1.0, 2, 1).encode("ab")  # nothing merges: the same pieces under any seed


def test_dataframe_round_trip(spark):
    rows = corpus() + list(enumerate(TEXTS, 9000))
    df = docs(spark, rows).repartition(3)
    out = decode_documents(encode_documents(df, MODEL, 0.2, 5), MODEL).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in out) == sorted((str(i), t or "") for i, t in rows)
    assert all(r.n_pieces * 4 == len(r.ids) for r in out)
    assert decode_documents(encode_documents(docs(spark, []), MODEL), MODEL).count() == 0


def test_every_occurrence_draws_its_own():
    coder = MergeDropout(MODEL, 0.1, 1)
    word = " internationalisation"
    keys = [k * 0x9E3779B97F4A7C15 % 2 ** 64 for k in range(2000)]
    got = [coder.chunk_ids(word, k) for k in keys]
    assert got == [coder._ids(word, k) for k in keys]  # the remembered runs are the plain agenda
    assert len(set(got)) > 20
    steps = coder._run(word)[0]
    whole = sum(not any(coder._dropped(k ^ p) for p in steps) for k in keys) / 2000
    assert abs(whole - 0.9 ** len(steps)) < 0.03
    text = "internationalisation " * 500
    pieces, of = set(), coder.encode(text)
    assert coder.decode(of) == text
    for one in (coder.chunk_ids(" internationalisation", k) for k in keys):
        pieces.add(one)
    assert sum(one in of for one in pieces) > 4


def test_batches_draw_as_the_plain_agenda_does():
    """Every chunk of every text, at several rates: the ids of the agenda with its own hash per merge."""
    import xxhash

    from riskweave.llm.dropout import _CHUNK

    texts = TEXTS + [t for _, t in corpus(3) if t] + ["internationalisation of unbelievable things " * 40, "y" * 41 + " z", "q" * 39]
    for rate in (0.0, 0.05, 0.4, 0.9, 1.0):
        coder = MergeDropout(MODEL, rate, 9)
        got = coder.encode_many(texts)
        for text, ids in zip(texts, got):
            base = xxhash.xxh3_64_intdigest(text.encode(), 9)
            plain = [coder._ids(c, (base + k * 0xD6E8FEB86659FD93) % 2 ** 64) for k, c in enumerate(_CHUNK.findall(" " + text), 1)]
            assert ids == (b"".join(plain) if text else b""), (rate, text[:40])
            assert coder.decode(ids) == text
        assert got == [coder.encode(t) for t in texts]
        assert got[::-1] == coder.encode_many(texts[::-1])  # whatever the batch
