"""Periodic runs of words, found by block convolution.

A run is a maximal stretch of words in which words ``q`` apart are the same, ``q`` being its
smallest period, at least ``min_exponent`` periods and ``min_length`` words long.

At every scale B = 1, 2, 4 ... a text is cut into blocks of B words.  A run of period q lies
over a whole block of the scale with B <= q < 2B that stands again q words later.  So for each
block all distances from B to 2B - 1 are tested at once: the sums of squared differences
between the block and its following window come from one cyclic convolution of length 2B, as a
number-theoretic transform in exact integers; a sum of zero is a match.  Modulo one prime a
sum may vanish by chance, so as many primes are used as make their product exceed the largest
possible sum.  Matching distances are seeds, extended both ways word by word.

A block of a run has no word whose next copy is 2B words away or further, so others are never
transformed; the largest gap of each block follows from those of its halves.
"""

from __future__ import annotations

import functools
import itertools
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from faretrail.llm.common import series_of, words_of

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Primes c * 2**k + 1 below 2**32 with a generator; products fit in 64 bits.
PRIMES = ((3221225473, 5), (3489660929, 3), (2013265921, 31))
#: Numbers that one transform holds at most, one block with its window aside.
_AT_ONCE = 1 << 18
_NEVER = np.iinfo(np.int64).max
RUN = "struct<start:bigint,length:bigint,period:bigint>"


@functools.lru_cache(maxsize=256)
def _powers(prime: int, generator: int, half: int, back: bool) -> np.ndarray:
    """w**0 .. w**(half - 1) for a root w of unity of order 2 * half, or its inverse."""
    w = pow(generator, (prime - 1) // (2 * half), prime)
    w = pow(w, prime - 2, prime) if back else w
    out = np.ones(half, dtype=np.uint64)
    done = 1
    while done < half:
        out[done:2 * done] = out[:done] * np.uint64(pow(w, done, prime)) % np.uint64(prime)
        done *= 2
    return out


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transform of each row (length a power of two, numbers below ``prime``), bit-reversed order."""
    a, p = rows.copy(), np.uint64(prime)
    half = a.shape[1] // 2
    while half:
        v = a.reshape(len(a), -1, 2, half)
        low, high = v[:, :, 0], v[:, :, 1]
        difference = (low + (p - high)) % p * _powers(prime, generator, half, False) % p
        v[:, :, 0] = (low + high) % p
        v[:, :, 1] = difference
        half //= 2
    return a


def transform_back(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Inverse of :func:`transform`."""
    a, p, n = rows.copy(), np.uint64(prime), rows.shape[1]
    half = 1
    while half < n:
        v = a.reshape(len(a), -1, 2, half)
        high = v[:, :, 1] * _powers(prime, generator, half, True) % p
        low = v[:, :, 0].copy()
        v[:, :, 0] = (low + high) % p
        v[:, :, 1] = (low + (p - high)) % p
        half *= 2
    return a * np.uint64(pow(n, prime - 2, prime)) % p


def squared_differences(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """(rows, B): sum over i of (block[i] - window[e + i]) ** 2 modulo ``prime`` for e below B.
    ``blocks`` (rows, B), ``windows`` (rows, 2B)."""
    p, size = np.uint64(prime), blocks.shape[1]
    x, w = blocks.astype(np.uint64) % p, windows.astype(np.uint64) % p
    turned = np.zeros_like(w)  # block[i] at -i, so that the cyclic convolution is a correlation
    turned[:, 0] = x[:, 0]
    turned[:, size + 1:] = x[:, :0:-1]
    product = transform(turned, prime, generator) * transform(w, prime, generator) % p
    common = transform_back(product, prime, generator)[:, :size]
    squares = np.zeros((len(w), 2 * size + 1), dtype=np.uint64)
    np.cumsum(w * w % p, axis=1, out=squares[:, 1:])
    own = (x * x % p).sum(axis=1, dtype=np.uint64)[:, None] % p
    return (own + (squares[:, size:2 * size] - squares[:, :size]) % p + 2 * (p - common)) % p


def _gaps(ids: np.ndarray) -> np.ndarray:
    """For each word the distance to its next copy."""
    gap = np.full(len(ids), _NEVER)
    order = np.argsort(ids.astype(np.uint16) if ids.max() < 1 << 16 else ids, kind="stable")
    again = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    gap[order[again]] = order[again + 1] - order[again]
    return gap


def _right(x: np.ndarray, at: int, d: int) -> int:
    """The first j from ``at`` on with x[j] != x[j + d], or len(x) - d."""
    step, end = 64, len(x) - d
    while at < end:
        to = min(at + step, end)
        other = x[at:to] != x[at + d:to + d]
        k = int(other.argmax())
        if other[k]:
            return at + k
        at, step = to, 2 * step
    return max(at, end)


def _left(x: np.ndarray, at: int, d: int) -> int:
    """The smallest i such that x[j] == x[j + d] for all j from i to ``at`` - 1."""
    step = 64
    while at > 0:
        to = max(at - step, 0)
        other = (x[to:at] != x[to + d:at + d])[::-1]
        k = int(other.argmax())
        if other[k]:
            return at - k
        at, step = to, 2 * step
    return 0


def _divisors(d: int) -> list[int]:
    """d divided by each of its prime factors."""
    out, rest, f = [], d, 2
    while f * f <= rest:
        if rest % f == 0:
            out.append(d // f)
            while rest % f == 0:
                rest //= f
        f += 1
    return [*out, d // rest] if rest > 1 else out


class _Stretches:
    """Extends seeds of one text; keeps the maximal stretches and their smallest periods."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.found: dict[tuple[int, int], int] = {}  # (start, period): end
        self._last: dict[int, tuple[int, int]] = {}
        self._ends: dict[tuple[int, bool], tuple[int, int]] = {}

    def extend(self, b: int, size: int, d: int) -> None:
        """Words b .. b + size - 1 stand again d words later."""
        start, end = self._last.get(d, (0, 0))
        if start <= b and b + size + d <= end:
            return
        x = self.x
        start, end = _left(x, b, d), _right(x, b + size, d) + d
        self._last[d] = start, end
        # from three periods on, a smaller period divides d
        if end - start >= 3 * d and not any((x[start:start + d] == x[start + s:start + s + d]).all() for s in _divisors(d)):
            self.found[start, d] = end

    def _end(self, b: int, size: int, p: int, later: bool) -> int:
        """Where the stretch of period p over words b .. b + size - 1 ends."""
        start, end = self._ends.get((p, later), (0, 0))
        if not (start <= b and b + size <= end):
            start, end = b, _right(self.x, b + size - p, p) + p
            self._ends[p, later] = start, end
        return end

    def seeds(self, b: int, size: int, distances: list[int]) -> None:
        """All distances from size to 2 * size - 1 at which the block at b stands again."""
        if len(distances) < 3:
            for d in distances:
                self.extend(b, size, d)
            return
        # three copies within so short a window overlap: the block has the period p, and the
        # copies lie p apart.  Where they lie in the block's own stretch of that period, any
        # longer period is no smallest one; else the two stretches' ends lie one period apart.
        p, last = distances[1] - distances[0], b + distances[-1]
        end = self._end(b, size, p, False)
        if end < last + size:
            d = self._end(last, size, p, True) - end
            if d in distances:
                self.extend(b, size, d)

    def settled(self, b: np.ndarray, size: int) -> np.ndarray:
        """Which blocks lie with their windows in one stretch of an earlier scale: they stand
        again at multiples of its period only."""
        if not self.found:
            return np.zeros(len(b), dtype=bool)
        spans = sorted((start, end) for (start, _), end in self.found.items())
        starts = np.array([s for s, _ in spans])
        reach = np.maximum.accumulate([e for _, e in spans])
        k = np.searchsorted(starts, b, "right") - 1
        return (k >= 0) & (reach[np.maximum(k, 0)] >= b + 3 * size)


def _matches(x: np.ndarray, b: np.ndarray, size: int, values: int):
    """(b, distances) of every block at ``b`` that stands again size to 2 * size - 1 words on."""
    n, e = len(x), np.arange(size)
    used, product = 0, 1
    while used < len(PRIMES) and product <= size * values * values:
        product *= PRIMES[used][0]
        used += 1
    padded = np.append(x, np.zeros(2 * size, dtype=x.dtype))
    rows = max(1, _AT_ONCE // (2 * size))
    for lo in range(0, len(b), rows):
        own = b[lo:lo + rows]
        blocks, windows = padded[own[:, None] + e], padded[own[:, None] + size + np.arange(2 * size)]
        same = own[:, None] + 2 * size + e <= n
        for prime, generator in PRIMES[:used]:
            same &= squared_differences(blocks, windows, prime, generator) == 0
        for r in np.flatnonzero(same.any(axis=1)):
            yield int(own[r]), (np.flatnonzero(same[r]) + size).tolist()


def runs_of(ids: np.ndarray, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers below its length, by
    start, then period.  ``min_exponent``: 3 at least."""
    if min_exponent < 3:
        raise ValueError("blocks of half a period show runs of three periods and more")
    n = len(ids)
    if n < 3:
        return []
    stretches, values = _Stretches(ids), int(ids.max()) + 1
    widest, size = _gaps(ids), 1
    while 3 * size <= n:
        b = np.flatnonzero(widest < 2 * size) * size
        b = b[b + 2 * size <= n]
        if len(b):
            b = b[~stretches.settled(b, size)]
            for at, distances in _matches(ids, b, size, values):
                stretches.seeds(at, size, distances)
        half = len(widest) // 2
        widest, size = np.maximum(widest[0:2 * half:2], widest[1:2 * half:2]), 2 * size
    return sorted((start, end - start, q) for (start, q), end in stretches.found.items()
                  if end - start >= max(min_length, min_exponent * q))


def word_runs(words: list[bytes], min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    number = defaultdict(itertools.count().__next__)
    return runs_of(np.fromiter(map(number.__getitem__, words), np.int64, len(words)), min_exponent, min_length)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that a run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return list(itertools.compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


def found(text: Column, min_exponent: int = MIN_EXPONENT, min_length: int = MIN_LENGTH) -> Column:
    """struct<n_words, runs: array<struct<start, length, period>>, collapsed> of every whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``; ``runs`` are ordered by start, then period; ``collapsed``
    holds the words left joined by one space.  A null, empty or blank text has no word, no run
    and collapses to the empty text.  Rows are read one by one, so equal rows give equal results.
    """
    @F.pandas_udf(f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>")
    def read(texts: pd.Series) -> pd.DataFrame:
        counts, runs, kept = [], [], []
        for t in series_of(texts):
            words = words_of(t)
            own = word_runs(words, min_exponent, min_length)
            counts.append(len(words))
            runs.append([{"start": s, "length": k, "period": q} for s, k, q in own])
            kept.append(b" ".join(collapsed(words, own)).decode("utf-8", "surrogatepass"))
        return pd.DataFrame({"n_words": counts, "runs": pd.Series(runs, dtype=object), "collapsed": pd.Series(kept, dtype=object)})

    return read(text.cast("string"))


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; of equal ones the first.  None: null."""
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
