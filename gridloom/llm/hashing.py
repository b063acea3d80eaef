"""64-bit hashes of words and word sequences of UTF-8 texts (numpy)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

#: Odd multipliers, modulo 2**64.
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Words kept with their hashes: at most so many, none longer than so many bytes, some 100 MB a worker.
KEPT_WORDS, KEPT_BYTES = 600_000, 32


class _Words(dict):
    """Word to hash; emptied when full, as it only saves work."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= KEPT_BYTES:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = h
        return h


_words = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


#: For the two hashes of ``Texts``: what is added to and multiplied into a lane.
LANE_SEEDS = ((0x27D4EB2F165667C5, 1), (0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD))
#: The first 0 to 8 bytes of a lane.
LANE_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Texts:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts that stand in one buffer, cut and hashed all at once.

    ``starts`` and ``lengths`` are in bytes; ``first`` is the place of each text's first word among all
    words, with their number at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = np.zeros(len(data) + 8, np.uint8)
        self.data[: len(data)] = data
        self.inside = (data != 32) & (data - np.uint8(9) > 4)
        start, end = self.inside.copy(), self.inside.copy()
        start[1:] &= ~self.inside[:-1]
        end[:-1] &= ~self.inside[1:]
        bounds = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
        start[bounds] = self.inside[bounds]
        end[bounds - 1] = self.inside[bounds - 1]
        self.starts = np.flatnonzero(start)
        self.lengths = np.flatnonzero(end) + 1 - self.starts
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, other: bool = False) -> np.ndarray:
        """64-bit hashes of the words, 8 bytes at a time; long words, which are few, one by one. The other ones are independent of the first."""
        seed, times = (np.uint64(x) for x in LANE_SEEDS[other])
        lanes = np.ndarray((len(self.data) - 7,), np.dtype("<u8"), self.data, strides=(1,))
        h = mix(mix((lanes[self.starts] & LANE_BYTES[np.minimum(self.lengths, 8)]) * times + seed) + self.lengths.astype(np.uint64) * M1)
        more = np.flatnonzero(self.lengths > 8)
        for lane in range(8, KEPT_BYTES, 8):
            part = lanes[self.starts[more] + lane] & LANE_BYTES[np.minimum(self.lengths[more] - lane, 8)]
            h[more] = mix((h[more] ^ part) * M2 + seed)
            more = more[self.lengths[more] > lane + 8]
        for i in more.tolist():
            s = self.starts[i]
            h[i] = xxhash.xxh3_64_intdigest(self.data[s : s + self.lengths[i]], int(other))
        return h

    def joined(self, keep: np.ndarray) -> list[memoryview]:
        """For each text those words that ``keep`` marks, joined by one space."""
        data, mask = self.data[: len(self.inside)].copy(), self.inside.copy()
        if not keep.all():
            mask[mask] = np.repeat(keep, self.lengths)
        held = np.flatnonzero(keep)
        upto = np.searchsorted(held, self.first)
        spaced = np.ones(len(held), bool)
        spaced[upto[1:][upto[1:] > upto[:-1]] - 1] = False
        after = (self.starts + self.lengths)[held[spaced]]
        data[after], mask[after] = 32, True
        size = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.lengths[held] + spaced)])[upto].tolist()
        out = data[mask].data
        return [out[a:b] for a, b in zip(size[:-1], size[1:], strict=True)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * M2
    x ^= x >> np.uint64(29)
    x *= M3
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, base, np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Spans:
    """Hashes of any spans of a sequence of word hashes."""

    def __init__(self, h: np.ndarray, base: int = 0x9E3779B97F4A7C15):
        self.up, self.down = _powers(base, 1 << max(12, (len(h) + 1).bit_length()))
        self.upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[: len(h)])])

    def all_of(self, size: int) -> np.ndarray:
        """``of`` every span of so many words."""
        n = max(len(self.upto) - size, 0)
        return mix((self.upto[size:] - self.upto[:n]) * self.down[:n] + np.uint64(size * int(M2) % (1 << 64)))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.upto[ends] - self.upto[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * M2)
