"""Prefix polynomial hashes of texts, and fingerprints taken from them.

A text's prefix array holds, for every length, the polynomial hash of its first so many code points modulo a
prime. Any two spans are compared by two subtractions and two products; the longest common extension of two
places is found by binary search. Where two texts meet, ``shared`` extends every span that both have, from
anchors chosen by content, so that insertions shift nothing out of sight. A fingerprint keeps the hashes of a
few prefixes and suffixes, at lengths that grow by a fixed ratio, so that two fingerprints tell which
stretches of their texts agree when laid together at the start, and at the end; and the smallest hashes of
spans of ``SPAN`` code points wherever they stand, which tell how many of those are common. The arrays of a text
that is put together from beginnings of two others follow from theirs (``edited``) without hashing it anew.
"""

from functools import lru_cache
from typing import NamedTuple

import numpy as np

# Two primes below 2^31, so that a product of residues fits 64 bits, and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1812433253)

#: Prefix and suffix lengths in a fingerprint: FIRST times two to the power of multiples of 1/STEPS.
FIRST, STEPS = 2, 8
GRID = np.unique(np.round(FIRST * 2 ** (np.arange(0, 28 * STEPS) / STEPS)).astype(np.int64))
_EDGES = np.concatenate([[0], GRID])
#: The base to the power of each stretch between two lengths, and its inverse.
_STRETCH = np.array([pow(BASES[0], int(x), PRIMES[0]) for x in np.diff(_EDGES)])
_BACK = pow(BASES[0], -1, PRIMES[0])

#: Length of an anchor's span; one place in so many is an anchor; spans in a fingerprint.
SPAN, ANCHOR_PART, SKETCH = 32, 16, 64

_powers: dict[int, np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** i modulo prime for i below ``n`` at least, kept and doubled as longer texts come."""
    found = _powers.get(base)
    if found is None:
        found = np.ones(1, np.uint64)
    elif len(found) >= n:
        return found
    while len(found) < n:
        step = np.uint64(pow(base, len(found), prime))
        found = np.concatenate([found, found * step % np.uint64(prime)])
    _powers[base] = found
    return found


class PrefixHash:
    """The prefix arrays of one text, modulo both primes."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        sums = []
        for prime, base in zip(PRIMES, BASES):
            added = np.zeros(len(codes) + 1, np.uint64)
            # Fewer than 2^32 terms below 2^31 each: the sum needs no reduction on the way.
            np.cumsum(codes * powers(base, prime, len(codes))[: len(codes)] % np.uint64(prime), out=added[1:])
            sums.append(added % np.uint64(prime))
        self._set(sums)

    def _set(self, sums: list[np.ndarray], spans: np.ndarray | None = None) -> None:
        self.n = len(sums[0]) - 1
        self.prefix = sums
        self._read = [memoryview(x) for x in sums]  # gives Python numbers, faster than the array
        self._spans = spans
        self._anchors: tuple[np.ndarray, np.ndarray] | None = None

    def edited(self, keep: int, other: "PrefixHash", take: int) -> "PrefixHash":
        """The arrays of the first ``keep`` code points followed by the first ``take`` of ``other``."""
        keep, take = min(keep, self.n), min(take, other.n)
        sums = []
        for mine, theirs, prime, base in zip(self.prefix, other.prefix, PRIMES, BASES):
            shift = powers(base, prime, keep + 1)[keep]
            behind = (theirs[1 : take + 1] * shift + mine[keep]) % np.uint64(prime)
            sums.append(np.concatenate([mine[: keep + 1], behind]))
        made = PrefixHash.__new__(PrefixHash)
        made._set(sums)
        # Spans within either part are those of the texts; only those across the seam are new.
        before, behind = max(0, keep - SPAN + 1), max(0, take - SPAN + 1)
        seam = made._span_numbers(before, max(before, made.n - SPAN + 1 - behind))
        made._spans = np.concatenate([self.spans()[:before], seam, other.spans()[:behind]])
        return made

    def same(self, start: int, other: "PrefixHash", other_start: int, length: int) -> bool:
        """Whether ``length`` code points from ``start`` equal those of ``other`` from ``other_start``."""
        if start + length > self.n or other_start + length > other.n:
            return False
        for mine, theirs, prime, base in zip(self._read, other._read, PRIMES, BASES):
            a, b = mine[start + length] - mine[start], theirs[other_start + length] - theirs[other_start]
            if start != other_start:
                power = powers(base, prime, max(start, other_start) + 1)
                a, b = a * int(power[other_start]), b * int(power[start])
            if (a - b) % prime:
                return False
        return True

    def common(self, start: int, other: "PrefixHash", other_start: int) -> int:
        """How many code points agree from ``start`` here and ``other_start`` there."""
        low, high = 0, min(self.n - start, other.n - other_start)
        if high > 0 and not self.same(start, other, other_start, 1):
            return 0  # as with most texts
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.same(start, other, other_start, middle) else (low, middle - 1)
        return low

    def common_before(self, end: int, other: "PrefixHash", other_end: int) -> int:
        """How many code points agree up to ``end`` here and ``other_end`` there."""
        low, high = 0, min(end, other_end)
        if high > 0 and not self.same(end - 1, other, other_end - 1, 1):
            return 0
        while low < high:
            middle = (low + high + 1) // 2
            agree = self.same(end - middle, other, other_end - middle, middle)
            low, high = (middle, high) if agree else (low, middle - 1)
        return low

    def spans(self) -> np.ndarray:
        """A 32-bit number for the ``SPAN`` code points from each place; equal spans have equal ones."""
        if self._spans is None:
            self._spans = self._span_numbers(0, max(0, self.n - SPAN + 1))
        return self._spans

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors, and the numbers of their spans."""
        if self._anchors is None:
            places = (self.spans() < (1 << 32) // ANCHOR_PART).nonzero()[0]
            self._anchors = places, self.spans()[places]
        return self._anchors

    def _span_numbers(self, start: int, end: int) -> np.ndarray:
        if start >= end:
            return np.zeros(0, np.uint32)
        prime, sums = np.uint64(PRIMES[0]), self.prefix[0]
        back = powers(_BACK, PRIMES[0], end)[start:end]
        hashes = (sums[start + SPAN : end + SPAN] + prime - sums[start:end]) % prime * back % prime
        return (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)

    def shared(self, other: "PrefixHash") -> float:
        """The share, from 0 to 1, of the longer text in spans that the other text has too, wherever they stand.

        Spans are the longest extensions of the two starts, the two ends and the common anchors, on the last
        span's diagonal if it goes on there. Each text's code points count once; the smaller sum is taken. 1
        for equal texts only.
        """
        if self.n == other.n and self.same(0, other, 0, self.n):
            return 1.0
        if not self.n or not other.n:
            return 0.0
        head, tail = self.common(0, other, 0), self.common_before(self.n, other, other.n)
        found = [(0, 0, head), (self.n - tail, other.n - tail, tail)]
        (mine, wanted), (theirs, values) = self.anchors(), other.anchors()
        if len(theirs) and len(mine):
            first = values.argsort(kind="stable")
            values = values[first]
            at = np.minimum(values.searchsorted(wanted), len(values) - 1)
            both = values[at] == wanted
            reached, shift = head, 0
            for i, j in zip(mine[both].tolist(), theirs[first[at[both]]].tolist()):
                if i < reached or i >= self.n - tail:
                    continue
                if i + shift >= 0 and self.same(i, other, i + shift, SPAN):
                    j = i + shift
                elif not self.same(i, other, j, SPAN):
                    continue
                before, ahead = self.common_before(i, other, j), self.common(i, other, j)
                found.append((i - before, j - before, before + ahead))
                reached, shift = i + ahead, j - i
        covered = min(_length([(a, a + n) for a, _, n in found]), _length([(b, b + n) for _, b, n in found]))
        return float(min(covered / max(self.n, other.n), 1 - 1e-9))

    def fingerprint(self) -> str:
        """Length, hash of the whole, prefix hashes and suffix hashes at the grid's lengths below it, and the
        smallest numbers of spans."""
        prime = PRIMES[0]
        lengths = GRID[: np.searchsorted(GRID, self.n)]
        sums = self.prefix[0]
        heads = sums[lengths]
        # A suffix's hash is brought to exponent 0, so that it does not depend on what stands before.
        back = powers(_BACK, prime, self.n + 1)[self.n - lengths]
        tails = (sums[self.n] + np.uint64(prime) - sums[self.n - lengths]) % np.uint64(prime) * back % np.uint64(prime)
        whole = int(sums[self.n]) << 31 | int(self.prefix[1][self.n])
        octets = np.concatenate([heads, tails]).astype(">u4").tobytes().hex()
        numbers = self.spans()
        sketch = None
        if len(numbers) > 4 * SKETCH:  # most are far above the smallest
            sketch = _distinct(numbers[numbers < (1 << 32) // (len(numbers) // (2 * SKETCH))])
        if sketch is None or len(sketch) < SKETCH:
            sketch = _distinct(numbers)
        sketch = sketch[:SKETCH].astype(">u4").tobytes().hex()
        return f"{self.n:x}.{whole:016x}.{octets}.{sketch}"


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The different ones, sorted; a plain sort is faster than hashing for few."""
    numbers = np.sort(numbers)
    first = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=first[1:])
    return numbers[first]


def _length(spans: list[tuple[int, int]]) -> int:
    """How many places the spans cover."""
    covered, reached = 0, 0
    for start, end in sorted(spans):
        if end > reached:
            covered += end - (start if start > reached else reached)
            reached = end
    return covered


class _Fingerprint(NamedTuple):
    n: int
    heads: np.ndarray
    tails: np.ndarray
    whole: int
    sketch: np.ndarray
    """The smallest numbers of spans, different and sorted."""


@lru_cache(maxsize=16)
def _parsed(fingerprint: str) -> _Fingerprint:
    n, whole, octets, sketch = fingerprint.split(".")
    values = np.frombuffer(bytes.fromhex(octets), ">u4").astype(np.int64)
    heads, tails = values[: len(values) // 2], values[len(values) // 2 :]
    return _Fingerprint(int(n, 16), heads, tails, int(whole, 16) >> 31, np.frombuffer(bytes.fromhex(sketch), ">u4").astype(np.uint32))


def _sketched(a: _Fingerprint, b: _Fingerprint) -> float:
    """The share of the longer text that is in common spans, as the smallest numbers of spans tell."""
    if not len(a.sketch) or not len(b.sketch):
        return 0.0
    both = np.concatenate([a.sketch, b.sketch])  # what both have stands there twice
    both.sort()
    twice = (both[1:] == both[:-1]).nonzero()[0] + 1
    # Of the different ones the smallest count: before the i-th that stands twice there are i - 1 such.
    alike = np.count_nonzero(twice - np.arange(len(twice)) <= SKETCH) / min(SKETCH, len(both) - len(twice))
    return min(alike / (1 + alike) * (a.n + b.n), a.n, b.n) / max(a.n, b.n)


def likeness(a: str, b: str) -> float:
    """The share, from 0 to 1, of the longer text that agrees with the other one, as two fingerprints tell.

    A stretch between two lengths of the grid agrees if its hashes do, counted from the start or from the
    end; if the common spans tell of more, that counts. 1 for equal fingerprints only, and for two empty texts.
    """
    if a == b:
        return 1.0
    x, y = _parsed(a), _parsed(b)
    prime = PRIMES[0]
    count = min(len(x.heads), len(y.heads))
    apart = np.zeros((2, count + 1), np.int64)
    np.subtract(x.heads[:count], y.heads[:count], out=apart[0, 1:])
    np.subtract(x.tails[:count], y.tails[:count], out=apart[1, 1:])
    apart %= prime
    ahead = (apart[0, 1:] == apart[0, :-1]).nonzero()[0]
    # S(long) = hash of the stretch + base ** size * S(short), for suffixes S counted from their own start.
    behind = (apart[1, 1:] == apart[1, :-1] * _STRETCH[:count] % prime).nonzero()[0]
    least = min(x.n, y.n)
    spans = list(zip(_EDGES[ahead].tolist(), _EDGES[ahead + 1].tolist()))
    spans += zip((least - _EDGES[behind + 1]).tolist(), (least - _EDGES[behind]).tolist())
    if x.n == y.n and count and x.whole - y.whole == x.heads[-1] - y.heads[-1]:
        spans.append((int(_EDGES[count]), x.n))
    share = max(_length(spans) / max(x.n, y.n), _sketched(x, y))
    return float(min(share, 1 - 1e-9))
