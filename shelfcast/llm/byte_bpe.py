"""Byte-level BPE encoding and decoding in numpy.

Texts are split by the tokenizer's pattern; the distinct pieces that the worker's
bounded memo doesn't know are sorted into buckets by length and padded to
matrices of byte ids. Each round every row merges its leftmost pair of minimum
rank: ranks come from an open-addressing hash table of id pairs, the merged id
takes the left place, the rest of the row moves up, and rows without a mergeable
pair leave the matrix. Pieces over ``LONG`` bytes, whose rounds would take
quadratic time, merge the same pairs in the same order by a heap.

Defined results: null and empty texts have no ids; characters are encoded as
UTF-8; there are no special tokens. Only the named columns are read.
"""
from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

NONE = np.int32(2**31 - 1)
BUCKETS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 96, 128, 256, 512, 1024, 2048)
LONG = BUCKETS[-1]
CELLS = 1 << 21  # of a matrix
MEMO_PIECES = 300_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class PairTable:
    """Hashed lookup of (left id, right id) -> rank of the two together."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.shift = np.uint64(64 - max(4, (2 * len(pairs)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NONE, np.int32)
        todo = np.fromiter(pairs, np.int64, len(pairs))
        value = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(todo)
        while len(todo):  # each round, one key settles in every free slot that is asked for
            free = self.keys[slot] == -1
            self.keys[slot[free]] = todo[free]
            won = self.keys[slot] == todo
            self.ranks[slot[won]] = value[won]
            todo, value, slot = todo[~won], value[~won], slot[~won] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * MIX >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE where the pair doesn't merge. Ids below 0 are padding."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        ask = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        flat, found = keys.ravel()[ask], out.ravel()
        slot = self._slot(flat)
        while len(ask):
            there = self.keys[slot]
            hit = there == flat
            found[ask[hit]] = self.ranks[slot[hit]]
            go = ~hit & (there != -1)
            ask, flat, slot = ask[go], flat[go], slot[go] + 1 & self.mask
        return found.reshape(keys.shape)


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBPE:
    """One table and memo for all tasks of a Python worker."""
    return ByteBPE(path, pattern)


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.memo: dict[str, list[int]] = {}

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        memo = self.memo
        split = [self.split(t or "") for t in texts]
        new = list(set(chain.from_iterable(split)).difference(memo))
        raw = [p.encode() for p in new]
        memo.update(zip(new, self.merge(raw)))
        out = [list(chain.from_iterable(map(memo.__getitem__, pieces))) for pieces in split]
        for p, b in zip(new, raw):
            if len(b) > 256:
                del memo[p]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        todo: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[i] = [whole]
            elif len(p) > LONG:
                out[i] = self._by_heap(p)
            elif p:
                todo.setdefault(next(b for b in BUCKETS if len(p) <= b), []).append(i)
        for width, members in todo.items():
            step = max(1, CELLS // width)
            for j in range(0, len(members), step):
                part = members[j:j + step]
                for i, ids in zip(part, self._by_matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def _by_matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_ids[raw], -1)
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        alive = np.arange(len(pieces))
        out: list[list[int]] = [[]] * len(pieces)
        while len(alive):
            at = rank.argmin(1)  # the first of equal ranks: the leftmost
            rows = np.arange(len(at))
            best = rank[rows, at]
            done = best == NONE
            if done.any():
                for r in np.flatnonzero(done):
                    out[alive[r]] = ids[r, :lengths[r]].tolist()
                go = ~done
                ids, rank, alive, lengths, at, best = ids[go], rank[go], alive[go], lengths[go], at[go], best[go]
                rows = np.arange(len(at))
                if not len(alive):
                    break
                width = int(lengths.max())
                ids, rank = ids[:, :width], rank[:, :max(width - 1, 1)]
            ids[rows, at] = best
            # close the gap after the merged pair
            cols = np.arange(ids.shape[1] - 1)
            ids[:, :-1] = np.where(cols > at[:, None], ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            if rank.shape[1] > 1:
                cols = np.arange(rank.shape[1] - 1)
                rank[:, :-1] = np.where(cols > at[:, None], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NONE
            lengths = lengths - 1
            left = at > 0
            r, c = rows[left], at[left]
            rank[r, c - 1] = self.pairs(ids[r, c - 1], ids[r, c])
            right = at + 1 < ids.shape[1]
            r, c = rows[right], at[right]
            rank[r, c] = self.pairs(ids[r, c], ids[r, c + 1])
        return out

    def _by_heap(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pairs(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        ids, n = ids.tolist(), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        token = self.bytes_of

        def rank_at(i):
            j = after[i]
            return self.ranks.get(token[ids[i]] + token[ids[j]]) if j < n else None
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank_at(i) != r:
                continue  # outdated
            j = after[i]
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (new := rank_at(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return [x for x in ids if x >= 0]
