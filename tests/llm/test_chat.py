import hashlib
import random

import pytest

pytest.importorskip("public_tokenizers")

from riskweave.llm.chat import format_conversations, format_turn, read_conversations, read_turns  # noqa: E402
from riskweave.llm.queries import bpe_files  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string, window long, loss string"
MARKS = ["### assistant: ", "</turn>\n", "\\", "#", "<", "\\### Assistant: </turn> ok", "", "\n", ": "]


def rows(seed=0):
    rng = random.Random(seed)
    out = []
    for c in range(12):
        for t in range(rng.choice([1, 2, 5, 60])):
            role = "system" if t == 0 and c % 2 else ["user", "assistant"][t % 2]
            text = " ".join(rng.choice(MARKS + ["word", "é", "a longer run of words"]) for _ in range(rng.randrange(40)))
            out.append((c, t, role, text))
    out += [(50, None, None, None), (50, 1, "assistant", None), (None, 0, "assistant", "x"), (51, 0, "ro:le\\", "y"),
            (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "assistant", "w " * 3000)]
    rng.shuffle(out)
    return out


def test_digests_against_the_input(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in data], SCHEMA)
    windows = format_conversations(df, *bpe_files(), budget=120, history=40)
    got = {r.conv_id: r for r in read_conversations(windows).collect()}
    by = {}
    for c, t, role, text in data:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x[3] for x in turns if x[2] == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{x[2]}\n{x[3]}\n" for x in turns).encode()).hexdigest()
    by_conv = {}
    for w in windows.orderBy("conv_id", "window").collect():
        by_conv.setdefault(w.conv_id, []).append(w)
    for c, ws in by_conv.items():
        assert [w.window for w in ws] == list(range(len(ws)))
        assert got[c].formatted_chars == sum(len(w.formatted) for w in ws)
        system = read_turns(ws[0].formatted)[0] if read_turns(ws[0].formatted)[0][0] == "system" else None
        before = []
        for w in ws:
            turns = read_turns(w.formatted)
            new = turns[w.n_repeated:]
            assert w.n_tokens <= 120 or len(new) == 1
            if w.window and system:
                assert turns[0] == system and w.n_repeated >= 1
            history = turns[bool(system and w.window):w.n_repeated]
            assert history == before[len(before) - len(history):]
            before += new


def test_marks_are_escaped_reversibly():
    for text in MARKS + ["".join(MARKS)]:
        formatted, start, length = format_turn("a:b", text)
        assert read_turns(formatted * 2) == [("a:b", text)] * 2
        assert formatted[start:start + length].count("</turn>") == 0
    with pytest.raises(ValueError):
        read_turns("### user: text")


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert read_conversations(format_conversations(df, *bpe_files())).count() == 0


def test_large_ids_beside_null_ones(spark):
    """Ids and turn numbers that a double cannot hold stay apart, also in a batch with nulls."""
    big = 2 ** 60
    data = [(big + k, t, "assistant", f"text {k} {t}") for k in (1, 2, 3) for t in (big + 1, big + 2)]
    data += [(None, big + 2, "assistant", "b"), (None, None, "user", "z"), (None, big + 1, "assistant", "a"), (None, big + 1, "user", "q")]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], SCHEMA).coalesce(1)
    windows = format_conversations(df, *bpe_files())
    assert {w.conv_id for w in windows.collect()} == {None, big + 1, big + 2, big + 3}
    got = {r.conv_id: r for r in read_conversations(windows).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {None: 4, big + 1: 2, big + 2: 2, big + 3: 2}
    turns = "".join(f"assistant\ntext 2 {t}\n" for t in (big + 1, big + 2))
    assert got[big + 2].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
    assert got[None].loss_sha256 == hashlib.sha256(b"ab").hexdigest()
