"""Batch tokenizing with the ``tokenizers`` library and a bounded memo of chunks.

A chunk is a run of blanks and newlines with the letters or other characters
that follow it. Both pre-tokenizers in use end a piece before such a run and
between a Latin letter and a comma or full stop, so a text's ids are those of
its chunks in order. A text with any other white space, or with the string of a token
that was added to the vocabulary, is encoded whole.
"""
from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

CHUNK = re.compile(r"[ \n]*[a-zA-ZÀ-ÖØ-öø-ÿ]++(?![^ \n,.])|[ \n]*[^ \n]+|[ \n]+")
OTHER_SPACE = re.compile("[" + "".join(map(chr, [
    9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030),
    *range(0x205F, 0x2065), 0x3000, 0xFEFF])) + "]")
MEMO_BYTES = 160 << 20  # of chunks, their ids and the table itself
ENTRY_BYTES = 150
# A chunk of Latin letters after at most one blank is one piece. The memo asks the
# library's model for its merges directly, which costs a fraction of a whole call;
# the piece's characters are those by which a byte-level vocabulary writes bytes.
PIECE = re.compile(r" ?[a-zA-ZÀ-ÖØ-öø-ÿ]+\Z")


def byte_characters() -> dict[int, str]:
    """Fixed by the vocabulary: printable bytes stand for themselves, the others for
    the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer and memo for all tasks of a Python worker."""
    return ChunkTokenizer(path)


class Memo(dict):
    """Ids of chunks as bytes; a chunk that it lacks is encoded and added."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.size = 0

    def __missing__(self, chunk: str) -> bytes:
        ids = self.encode(chunk)
        if len(chunk) <= 64:
            self[chunk] = ids
            self.size += ENTRY_BYTES + len(chunk) + len(ids)
        return ids

    def trim(self, limit: int) -> None:
        """Over ``limit`` bytes, keep the shorter half, which recurs most."""
        if self.size > limit:
            half = sorted(map(len, self))[len(self) // 2]
            for k in [k for k in self if len(k) >= half]:
                del self[k]
            self.size = sum(ENTRY_BYTES + len(k) + len(v) for k, v in self.items())


class ChunkTokenizer:
    """Ids of whole texts as little-endian bytes of ``width`` bytes an id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.merges = self.tokenizer.model.tokenize
        self.lower = self._ids("A") == self._ids("a")
        self.blanks_go = self._ids(" a") == self._ids("a")
        table = byte_characters()
        self.spelling = str.maketrans({c: "".join(table[b] for b in c.encode())
                                       for c in " " + "".join(map(chr, range(0xC0, 0x100)))})
        self.memo = Memo(self._chunk)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> bytes:
        if not PIECE.match(chunk):
            return array(self.code, self._ids(chunk)).tobytes()
        piece = chunk.lower() if self.lower else chunk
        piece = piece.lstrip(" ") if self.blanks_go else piece
        return array(self.code, [t.id for t in self.merges(piece.translate(self.spelling))]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """A null text counts as empty; an empty text has no ids."""
        self.memo.trim(MEMO_BYTES)
        find, known, added = CHUNK.findall, self.memo.__getitem__, self.added
        return [array(self.code, self._ids(t)).tobytes() if OTHER_SPACE.search(t) or any(x in t for x in added)
                else b"".join(map(known, find(t))) for t in (t or "" for t in texts)]
