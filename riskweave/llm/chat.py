"""Chat formatting in budgeted windows.

The turns of a conversation stream through a task in order.  Prefix sums of
their token counts choose the spans: a window takes new turns while the sum
over its span, with the retained system turn and the repeated history, stays
within the budget.  Windows are cut at turns only.  Each window opens with
the system turn and up to ``history`` tokens of the turns before it; those
repeated turns carry no loss, so every assistant text is a target once.

A turn is ``### <role>: <text></turn>\\n``.  Inside texts and roles ``\\``, ``#``
and ``<`` (in roles also ``:``) are written ``\\b``, ``\\h``, ``\\l`` and ``\\c``, so
no mark can occur in them and reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.tokens import byte_bpe

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
_TEXT = re.compile(r"[\\#<]")
_ROLE = re.compile(r"[\\#<:]")
_BACK = re.compile(r"\\([bhlc])")
_NAMES = {"\\": "\\b", "#": "\\h", "<": "\\l", ":": "\\c"}
_SIGNS = {v[1]: k for k, v in _NAMES.items()}
_TURN = re.compile(r"### ([^:#<]*): ([^#<]*)</turn>\n", re.S)

#: Ids stay whole numbers in Arrow, next to null ids too.
WINDOW_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int64()), ("formatted", pa.string()), ("n_repeated", pa.int32()),
    ("n_tokens", pa.int64()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))])
WINDOW_SCHEMA = ("conv_id long, window long, formatted string, n_repeated int, n_tokens long, "
                 "loss array<struct<start:int,length:int>>")


def record_batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)


def escape_text(text: str) -> str:
    return _TEXT.sub(lambda m: _NAMES[m[0]], text)


def escape_role(role: str) -> str:
    return _ROLE.sub(lambda m: _NAMES[m[0]], role)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: _SIGNS[m[1]], text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and length of its escaped text."""
    head, body = OPEN + escape_role(role) + COLON, escape_text(text)
    return head + body + CLOSE, len(head), len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window; anything else is an error."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class Windows:
    """Windows of one conversation, fed turn by turn."""

    def __init__(self, budget: int, history: int) -> None:
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.prefix = 0  # tokens of all turns so far
        self.turns: list[tuple] = []  # new turns of the open window
        self.begin = 0  # prefix sum where the open window's new turns begin
        self.recent: deque = deque()  # turns before them, with their prefix sums
        self.repeated: list[tuple] = []
        self.first = True

    def add(self, role: str, formatted: str, start: int, length: int, tokens: int) -> tuple | None:
        """Take one turn; the window it closes, if any."""
        turn = (role, formatted, start, length, tokens)
        done = None
        held = (self.system[4] if self.system and not self.first else 0) + sum(t[4] for t in self.repeated)
        if self.turns and held + self.prefix + tokens - self.begin > self.budget:
            done = self.close()
            self.begin = self.prefix
        if self.first and not self.turns and not self.system and role == "system":
            self.system = turn
        self.turns.append(turn)
        self.prefix += tokens
        return done

    def close(self) -> tuple | None:
        """The open window: (formatted turns, number repeated, tokens, loss spans)."""
        if not self.turns:
            return None
        lead = ([self.system] if self.system and not self.first else []) + self.repeated
        text, spans, at = [], [], 0
        for i, (role, formatted, start, length, _) in enumerate(lead + self.turns):
            if role == "assistant" and i >= len(lead):
                spans.append({"start": at + start, "length": length})
            at += len(formatted)
            text.append(formatted)
        out = "".join(text), len(lead), sum(t[4] for t in lead + self.turns), spans
        # history of the next window: the latest turns whose prefix sums span at most `history` tokens
        self.recent.extend(t for t in self.turns if t is not self.system)
        total, keep = 0, []
        for t in reversed(self.recent):
            total += t[4]
            if total > self.history:
                break
            keep.append(t)
        self.repeated = keep[::-1]
        self.recent = deque(self.repeated)
        self.turns, self.first = [], False
        return out


def _fits(windows: Windows, tokens: int) -> None:
    """Give up history that would push the coming turn over the budget."""
    if windows.turns:
        return
    base = (windows.system[4] if windows.system and not windows.first else 0) + tokens
    while windows.repeated and base + sum(t[4] for t in windows.repeated) > windows.budget:
        windows.repeated.pop(0)


def format_conversations(turns: DataFrame, ranks_path: str, pattern: str, budget: int = 512,
                         history: int = 128) -> DataFrame:
    """Windows of all conversations (``conv_id, turn, role, text``).

    Returns ``conv_id, window`` (from 0)``, formatted, n_repeated`` (leading
    turns that repeat the system turn or history)``, n_tokens`` and ``loss``
    (spans of code points in ``formatted``).

    Turns are ordered by ``turn`` (null first), then role and text, so
    repeated turns keep one order; null roles and texts are empty.  Rows with
    a null ``conv_id`` are one conversation.  A turn over the budget has a
    window to itself.  Other columns are ignored; no rows, no windows.

    One shuffle by conversation; a task streams its sorted rows and holds one
    window, so a conversation of any length takes bounded memory.
    """
    cols = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = cols.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator) -> Iterator:
        bpe = byte_bpe(ranks_path, pattern)
        conv, windows, number = None, None, 0
        rows: list[tuple] = []

        def put(done):
            nonlocal number
            if done:
                rows.append((conv, number, done[0], done[1], done[2], done[3]))
                number += 1

        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if windows is None or c != conv:
                    if windows is not None:
                        put(windows.close())
                    conv, number, windows = c, 0, Windows(budget, history)
                formatted, start, length = format_turn(role, text)
                tokens = bpe.count(formatted)
                put(windows.add(role, formatted, start, length, tokens))
                if len(windows.turns) == 1:
                    last = windows.turns.pop()
                    _fits(windows, last[4])
                    windows.turns.append(last)
                if len(rows) >= 2000:
                    yield record_batch(rows, WINDOW_TYPES)
                    rows.clear()
        if windows is not None:
            put(windows.close())
        if rows:
            yield record_batch(rows, WINDOW_TYPES)

    return ordered.mapInArrow(run, WINDOW_SCHEMA)


DIGEST_TYPES = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
DIGEST_SCHEMA = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                 "formatted_chars long, n_windows long")


def read_conversations(windows: DataFrame) -> DataFrame:
    """Read windows back: one row per conversation with counts and digests of
    its turns and of the text under the loss mask."""
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")

    def run(batches: Iterator) -> Iterator:
        state = None
        rows: list[tuple] = []

        def put():
            if state is not None:
                rows.append((state["conv"], state["n"], state["turns"].hexdigest(), state["chars"],
                             state["loss"].hexdigest(), state["all"], state["windows"]))

        for batch in batches:
            named = (batch.column(batch.schema.get_field_index(k)) for k in ("conv_id", "formatted", "n_repeated", "loss"))
            for c, formatted, lead, spans in zip(*(k.to_pylist() for k in named)):
                if state is None or c != state["conv"]:
                    put()
                    state = {"conv": c, "n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(),
                             "all": 0, "windows": 0}
                for role, text in read_turns(formatted)[int(lead):]:
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                for span in spans:
                    text = unescape(formatted[span["start"]:span["start"] + span["length"]])
                    state["chars"] += len(text)
                    state["loss"].update(text.encode("utf-8", "replace"))
                state["all"] += len(formatted)
                state["windows"] += 1
            if len(rows) >= 2000:
                yield record_batch(rows, DIGEST_TYPES)
                rows.clear()
        put()
        if rows:
            yield record_batch(rows, DIGEST_TYPES)

    return ordered.mapInArrow(run, DIGEST_SCHEMA)
