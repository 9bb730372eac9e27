"""Wavelet matrix: a token sequence as bit planes with rank and select.

Plane 0 holds every token's highest bit in order.  The tokens are then parted
stably by that bit, zeros first, and plane 1 holds the next bit of the parted
sequence, and so on.  Each plane carries the number of ones before every block
of ``BLOCK`` bits, so a rank costs one look-up and one block.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

BLOCK = 512
PIECE = 1 << 16
MAGIC = b"WMX1"


def _parted(one: np.ndarray, zeros: int) -> Iterator[tuple[slice, tuple[tuple[np.ndarray, slice], ...]]]:
    """Pieces of a plane, small enough for a processor's cache: the places of the piece's
    zeros and of its ones, and where each go when the whole is parted."""
    low, high = 0, zeros
    for k in range(0, len(one), PIECE):
        piece = one[k:k + PIECE]
        a, b = np.flatnonzero(~piece), np.flatnonzero(piece)
        yield slice(k, k + PIECE), ((a, slice(low, low + len(a))), (b, slice(high, high + len(b))))
        low, high = low + len(a), high + len(b)


class WaveletMatrix:
    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray]):
        self.n, self.zeros, self.planes = n, zeros, planes
        self._ones: list[np.ndarray] | None = None

    # ---- building and the file form ----

    @classmethod
    def build(cls, tokens: np.ndarray, levels: int | None = None) -> "WaveletMatrix":
        top = int(tokens.max()) if len(tokens) else 0
        levels = max(levels or 1, top.bit_length())
        kind = np.uint16 if levels <= 16 else np.uint32
        now, zeros, planes = np.ascontiguousarray(tokens, dtype=kind), [], []
        for level in range(levels):
            one = (now & kind(1 << (levels - 1 - level))) != 0
            planes.append(np.packbits(one))
            zeros.append(len(now) - np.count_nonzero(one))
            after = np.empty_like(now)
            for here, sides in _parted(one, zeros[-1]):
                for places, there in sides:
                    after[there] = now[here].take(places)
            now = after
        return cls(len(tokens), zeros, planes)

    def to_bytes(self) -> bytes:
        """Header, zeros of each plane, block ranks, then the planes."""
        head = struct.pack(f"<4sQI{len(self.zeros)}Q", MAGIC, self.n, len(self.zeros), *self.zeros)
        return b"".join([head, *(r.astype("<u4").tobytes() for r in self._ranks()),
                         *(p.tobytes() for p in self.planes)])

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        magic, n, levels = struct.unpack_from("<4sQI", data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        zeros = list(struct.unpack_from(f"<{levels}Q", data, 16))
        at, blocks, width = 16 + 8 * levels, n // BLOCK + 1, (n + 7) // 8
        out = cls(n, zeros, [])
        out._ones = [np.frombuffer(data, "<u4", blocks, at + 4 * blocks * k) for k in range(levels)]
        at += 4 * blocks * levels
        out.planes = [np.frombuffer(data, np.uint8, width, at + width * k) for k in range(levels)]
        return out

    def _ranks(self) -> list[np.ndarray]:
        if self._ones is None:
            self._ones, blocks = [], self.n // BLOCK + 1
            for plane in self.planes:
                padded = np.zeros(blocks * BLOCK // 8, np.uint8)
                padded[:len(plane)] = plane
                ones = np.bitwise_count(padded).reshape(blocks, -1).sum(axis=1, dtype=np.uint64)
                self._ones.append(np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.uint32))
        return self._ones

    # ---- queries ----

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (7 - (i & 7))) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        start = block * BLOCK
        ones = int(self._ranks()[level][block])
        whole = self.planes[level][start >> 3:i >> 3]
        ones += int(np.bitwise_count(whole).sum())
        if i & 7:
            ones += int(self.planes[level][i >> 3] >> (8 - (i & 7))).bit_count()
        return ones

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            token = token << 1 | bit
            i = zeros + ones if bit else i - ones
        return token

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of ``token`` at positions from ``start`` to before ``end``."""
        end = self.n if end is None else min(max(end, 0), self.n)
        a, b = self._span(token, min(max(start, 0), end), end)
        return b - a

    def _span(self, token: int, a: int, b: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.zeros):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            x, y = self._rank1(level, a), self._rank1(level, b)
            if token >> (len(self.zeros) - 1 - level) & 1:
                a, b = zeros + x, zeros + y
            else:
                a, b = a - x, b - y
        return a, b

    def locate(self, token: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of ``token``."""
        a, b = self._span(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(len(self.zeros) - 1, -1, -1):
            if token >> (len(self.zeros) - 1 - level) & 1:
                at = self._select(level, at - self.zeros[level], 1)
            else:
                at = self._select(level, at, 0)
        return at

    def _select(self, level: int, k: int, bit: int) -> int:
        """Position of the ``k``-th bit (from 0) of that value in a plane."""
        ranks = self._ranks()[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        start = block * BLOCK
        bits = np.unpackbits(self.planes[level][start >> 3:(start + BLOCK) >> 3])[:self.n - start]
        return start + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def to_array(self) -> np.ndarray:
        """All tokens in order: the planes undone from the last to the first."""
        levels = len(self.zeros)
        kind = np.uint16 if levels <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for level in range(levels - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            now[self.zeros[level]:] |= kind(1 << (levels - 1 - level))
            before = np.empty_like(now)
            for here, sides in _parted(one, self.zeros[level]):
                for places, there in sides:
                    before[here][places] = now[there]
            now = before
        return now
