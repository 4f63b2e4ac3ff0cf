"""Periodic run detection by block convolution.

A run is a stretch of consecutive words with smallest period q, at least
``max(least, exponent * q)`` words long, that no neighbouring word extends keeping
period q (words q apart are identical). ``least`` is 6 and ``exponent`` 4.

At every dyadic scale b the words are cut into blocks of b words. A run of period q
in [b, 2b) holds two neighbouring blocks whole, and both occur again q words later.
The distances in [b, 2b) at which a block occurs again are those at which the sum of
squared differences between the block and the window that follows it is zero. The
sums come from a number theoretic transform over the integers modulo the prime
65537: words are numbered, numbers are taken modulo the prime, and the correlation
of all blocks of a scale with their windows is one batch of transforms, exact in
integer arithmetic. A sum that is zero only modulo the prime does no harm, as a
distance is a seed only: it is extended to both sides by comparing the words
themselves. Seeds inside a known run of a smaller period are multiples of that
period and are left out; by the theorem of Fine and Wilf nothing else can be.

Blocks longer than ``LONGEST`` words are looked up by their first ``LONGEST`` words,
with the window cut in pieces, so a transform has a bounded size however long a text
is. The steps of a text of n words are n log(n) at every scale and log(n) scales.

Documents stay where they are: there is no shuffle. A worker joins the texts of a
batch, longest first, parted by words that occur nowhere else, so that short texts
share their transforms, at most ``WORDS`` words at once (a longer text alone).

Defined results: a null text and one without a word have no run and collapse to the
empty text; repeated rows come back as often as they occur; an empty table gives an
empty result; only the named columns are read and the kept ones carried along.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIME, GENERATOR = 65537, 3
LONGEST = 1 << 15     # words of a block that are compared by convolution
WORDS = 1 << 18       # words of the texts that are joined
CELLS = 1 << 19       # numbers that are transformed at once
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _reduced(x: np.ndarray) -> np.ndarray:
    """A number congruent to x modulo 2**16 + 1, about 16 bits shorter."""
    return (x & 0xFFFF) - (x >> 16)


@cache
def _powers(size: int, inverse: bool) -> list[np.ndarray]:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = []
    while size > 1:
        w = np.ones(size // 2, np.int64)
        for i in range(1, size // 2):
            w[i] = w[i - 1] * root % PRIME
        out.append(np.where(w > PRIME // 2, w - PRIME, w)[:, None])
        root, size = root * root % PRIME, size // 2
    return out


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number theoretic transform of every column of x (without the inverse's
    factor), congruent modulo the prime. Numbers below 2**17 in size stay below 2**34."""
    size, columns = x.shape
    stride = columns
    for w in _powers(size, inverse):
        half = len(w)
        a, b = x.reshape(2, half, stride)
        y = np.empty((half, 2, stride), np.int64)
        np.add(a, b, out=y[:, 0])
        d = a - b
        d *= w
        np.subtract(d & 0xFFFF, d >> 16, out=y[:, 1])
        x, stride = y, stride * 2
    return x.reshape(size, columns)


def mismatches(patterns: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Row i, column k: the sum of squared differences between pattern i (c numbers) and
    the c numbers of window i (2c numbers) from place k on, modulo the prime, k < c."""
    n, c = patterns.shape
    p = np.zeros((2 * c, n), np.int64)
    p[:c] = patterns.T[::-1]
    product = _reduced(_reduced(transform(p)) * _reduced(transform(np.ascontiguousarray(windows.T))))
    cross = transform(product, inverse=True)[c - 1:2 * c - 1]
    cross = cross % PRIME * pow(2 * c, -1, PRIME)
    squares = np.zeros((n, 2 * c + 1), np.int64)
    np.cumsum(windows * windows, axis=1, out=squares[:, 1:])
    return ((patterns * patterns).sum(1)[:, None] + squares[:, c:2 * c] - squares[:, :c] - 2 * cross.T) % PRIME


def seeds(field: np.ndarray, n: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances) of blocks of scale ``b`` among the first ``n`` numbers that,
    with the next block, occur again at the distance. ``field`` holds 4b numbers more."""
    c = min(b, LONGEST)
    rows = n // b
    step = max(2, CELLS // (2 * c))
    places, distances = [], []
    for first in range(0, max(rows - 1, 0), step - 1):
        at = np.arange(first, min(first + step, rows)) * b
        patterns = field[at[:, None] + np.arange(c)]
        for offset in range(b, 2 * b, c):
            again = mismatches(patterns, field[at[:, None] + (offset + np.arange(2 * c))]) == 0
            i, k = np.nonzero(again[:-1] & again[1:])
            places.append(at[i])
            distances.append(offset + k)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(distances)


def _extent(equal, n: int) -> int:
    """How many of the first n comparisons hold from the first on; ``equal(i, j)`` makes
    those from i to j."""
    i, step = 0, 64
    while i < n:
        wrong = np.flatnonzero(~equal(i, min(i + step, n)))
        if len(wrong):
            return i + int(wrong[0])
        i, step = i + step, step * 2
    return n


def find_runs(x: np.ndarray, least: int = 6, exponent: int = 4, longest: int | None = None,
              prefix: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the word numbers ``x``, by start, then period.
    ``prefix`` lists (least words, end): texts of as many words all end before that place."""
    if exponent < 4:
        raise ValueError("two blocks of a scale lie in a run and its repetition for an exponent of 4 or more")
    n = len(x)
    longest = n if longest is None else longest
    field = np.zeros(n + 4 * max(n, 1) // exponent + 8, np.int64)
    field[:n] = x % PRIME
    found: list[tuple[int, int, int]] = []
    b = 1
    while exponent * b <= longest:
        end = min((e for words, e in prefix if words <= exponent * b), default=n)
        place, distance = seeds(field, end, b)
        if len(place) and found:
            starts = np.array(sorted((s, s + size) for s, size, _ in found))
            ends = np.maximum.accumulate(starts[:, 1])
            i = np.searchsorted(starts[:, 0], place, "right")
            known = np.where(i > 0, ends[i - 1], 0)
            new = known < place + b + distance
            place, distance = place[new], distance[new]
        order = np.lexsort((place, distance))
        last, done = -1, 0
        for p, d in zip(place[order].tolist(), distance[order].tolist()):
            if d != last:
                last, done = d, 0
            if p < done or p + d >= n or x[p] != x[p + d]:
                continue
            right = p + _extent(lambda i, j: x[p + i:p + j] == x[p + d + i:p + d + j], n - d - p)
            left = p - _extent(lambda i, j: x[p - j:p - i][::-1] == x[p + d - j:p + d - i][::-1], p)
            done = right
            if right - left + d >= max(least, exponent * d):
                found.append((left, right - left + d, d))
        b *= 2
    return sorted((s, size, d) for s, size, d in found)


def runs_of(texts: Sequence[str | None], least: int = 6, exponent: int = 4) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """(words, runs) of every text."""
    words = [(t or "").encode().split() for t in texts]  # bytes split at \x20 and \x09 to \x0D alone
    out: list = [None] * len(words)
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    at = 0
    while at < len(order):
        part, size = [order[at]], len(words[order[at]])
        while at + len(part) < len(order) and size + len(words[order[at + len(part)]]) <= WORDS:
            part.append(order[at + len(part)])
            size += len(words[part[-1]])
        at += len(part)
        number: dict = {}
        starts, x, sizes = [], [], []
        for i in part:
            starts.append(len(x))
            x += [number.setdefault(w, len(number)) for w in words[i]]
            x.append(number.setdefault((i,), len(number)))  # found in no other place
            sizes.append(len(words[i]))
        ends = [s + size for s, size in zip(starts, sizes)]
        reach, b = [], 1
        while exponent * b <= sizes[0]:  # texts of exponent * b words or more come first
            n = int(np.searchsorted(-np.array(sizes), -exponent * b, "right"))
            reach.append((exponent * b, ends[n - 1]))
            b *= 2
        runs = find_runs(np.array(x, np.int64), least, exponent, sizes[0], reach)
        own: list[list] = [[] for _ in part]
        for k, (s, size, d) in zip(np.searchsorted(starts, [r[0] for r in runs], "right") - 1, runs):
            own[k].append((s - starts[k], size, d))
        for i, r in zip(part, own):
            out[i] = words[i], r
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by blanks, without those that a run holds after its first period."""
    if runs:
        cover = np.zeros(len(words) + 1, np.int64)
        for s, size, d in runs:
            cover[s + d] += 1
            cover[s + size] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]
    return b" ".join(words).decode()


def periodic_runs(docs: DataFrame, text: str | Column = "text", keep: Sequence[str] = ("doc_id",), least: int = 6,
                  exponent: int = 4) -> DataFrame:
    """The ``keep`` columns, ``_found``: struct of ``n_words`` (long), ``runs`` (by start,
    then period) and ``collapsed`` (the text without the repetitions)."""
    @F.pandas_udf(f"n_words bigint, runs {RUNS}, collapsed string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = [(len(words), [{"start": s, "length": size, "period": d} for s, size, d in runs], collapsed(words, runs))
                   for words, runs in runs_of(texts.tolist(), least, exponent)]
            yield pd.DataFrame(out, columns=["n_words", "runs", "collapsed"], index=texts.index)
    column = F.col(text) if isinstance(text, str) else text
    return docs.select(*[F.col(c) for c in keep], found(column).alias("_found"))
