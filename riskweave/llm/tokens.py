"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import base64
import sys
from array import array

from riskweave.llm.common import worker_cache


class ByteBpe:
    """Encoder over a file of token ranks (``base64 rank`` per line); strings
    of special tokens inside a text are ordinary text."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks,
                                         special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        ids = array("I", self._encode(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def count(self, text: str) -> int:
        return len(self._encode(text))


def byte_bpe(ranks_path: str, pattern: str) -> ByteBpe:
    """The worker's encoder, loaded once per Python worker."""
    cache, key = worker_cache(), ("byte_bpe", ranks_path, pattern)
    if key not in cache:
        cache[key] = ByteBpe(ranks_path, pattern)
    return cache[key]
