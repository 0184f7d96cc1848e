"""Byte-level BPE from a public rank file, with byte offsets from the tokens' own lengths."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken


class ByteBpe:
    """Ids and byte ends of whole texts; ``controls`` are strings that are one token each."""

    def __init__(self, path: str, controls: tuple[str, ...] = ()) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        first = max(ranks.values()) + 1
        special = {c: first + i for i, c in enumerate(controls)}
        self.engine = tiktoken.Encoding(
            "byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.controls = special
        self.sizes = np.zeros(first + len(controls), np.int64)
        for raw, i in ranks.items():
            self.sizes[i] = len(raw)
        for c, i in special.items():
            self.sizes[i] = len(c.encode())
        self.splitter = re.compile("|".join(map(re.escape, controls))) if controls else None

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, end of each token in the text's UTF-8 bytes)."""
        ids = np.array(
            self.engine.encode(text, allowed_special="all") if self.controls else self.engine.encode_ordinary(text),
            dtype=np.int64,
        )
        return ids, np.cumsum(self.sizes[ids])


@lru_cache(maxsize=4)
def byte_encoder(path: str, controls: tuple[str, ...] = ()) -> ByteBpe:
    """One encoder per Python worker, file and set of controls."""
    return ByteBpe(path, controls)
