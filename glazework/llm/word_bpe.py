"""Ids of a word-ended BPE vocabulary (a ``tokenizers`` JSON file), a whole text at a time.

The vocabulary's own library spends most of its time on normalising and
splitting. Its ids of a text are the ids of its white-space chunks in a row (white space
is dropped before merging), and prose repeats its chunks; so chunks are looked
up in a bounded cache, and the new ones of a text are encoded by the library
in one batch. The result is the library's, id by id.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Chunks kept per Python worker; the cache is emptied when it is full.
CACHE_CHUNKS = 300_000
#: Stands for the end of a word inside the byte-pair engine; a text that holds it takes the plain path.
END = "\x01"
#: Letters, ASCII digits and signs below U+0250: normalising leaves them as they are, and every
#: engine agrees on their classes. A chunk with any other character takes the plain path.
PLAIN = re.compile("[\\x21-\\x7e\\u00a1-\\u00ac\\u00ae-\\u00b1\\u00b4-\\u00b8\\u00ba\\u00bb\\u00bf-\\u012f\\u0131-\\u024f]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: The vocabulary's split, for those characters (no digits but 0-9, no marks).
find_pieces = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall


class WordBpe:
    """Encoder over one vocabulary file; ``ids`` gives a text's ids as a uint32 array."""

    def __init__(self, path: str) -> None:
        self.plain = Tokenizer.from_file(path)
        #: the little-endian uint32 ids of a chunk
        self.cache: dict[str, bytes] = {}
        vocab = self.plain.get_vocab(with_added_tokens=False)
        alphabet = _byte_alphabet()
        ranks: dict[bytes, int] = {}
        to_id: list[int] = []
        # ranks in id order: single bytes, bytes with the end, then merges by age
        for token, i in sorted(vocab.items(), key=lambda x: x[1]):
            ends = token.endswith("</w>")
            body = token[:-4] if ends else token
            if not body or any(c not in alphabet for c in body):
                continue
            raw = bytes(alphabet[c] for c in body) + (END.encode() if ends else b"")
            ranks[raw] = len(to_id)
            to_id.append(i)
        if END.encode() not in ranks:
            ranks[END.encode()] = len(to_id)
            to_id.append(-1)
        self.to_id = np.array(to_id).astype("<u4")
        self.ends = np.array([raw.endswith(END.encode()) for raw in ranks])
        self.engine = tiktoken.Encoding(
            "word-bpe", pat_str=f"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={}
        )

    def _encode_new(self, new: set[str]) -> None:
        """Put chunks that the cache lacks into it, in one call of each engine."""
        fast = [c for c in new if (c.isascii() and c.isprintable() or PLAIN.fullmatch(c)) and "<|" not in c]
        if fast:
            pieces = [[c.lower()] if c.isalpha() else find_pieces(c.lower()) for c in fast]
            joined = END.join(chain.from_iterable(pieces)) + END
            ranks = np.array(self.engine.encode_ordinary(joined), dtype=np.int64)
            # a chunk's ids end with its last piece, and a piece with a token that holds the end
            last = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) - 1
            stops = (4 * (np.flatnonzero(self.ends[ranks])[last] + 1)).tolist()
            ids = self.to_id[ranks].tobytes()
            self.cache.update((c, ids[a:b]) for c, a, b in zip(fast, [0, *stops], stops))
        if len(fast) < len(new):
            known = self.cache
            slow = [c for c in new if c not in known]
            encoded = self.plain.encode_batch(slow, add_special_tokens=False)
            known.update((c, np.array(e.ids, dtype="<u4").tobytes()) for c, e in zip(slow, encoded))

    def ids(self, text: str) -> np.ndarray:
        # the separators \x1c-\x1f are white space to str.split, but not to the vocabulary
        chunks = re.split(r"[^\S\x1c-\x1f]+", text.strip(" ")) if SEPARATORS.search(text) else text.split()
        distinct = set(chunks)
        if len(self.cache) + len(distinct) > CACHE_CHUNKS:
            self.cache.clear()
        new = distinct.difference(self.cache)
        if new:
            self._encode_new(new)
        return np.frombuffer(b"".join(map(self.cache.__getitem__, chunks)), dtype="<u4")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in set(shown)):
        out[chr(256 + n)] = b
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> WordBpe:
    """One encoder per Python worker and file."""
    return WordBpe(path)
