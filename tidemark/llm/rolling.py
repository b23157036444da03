"""Hashes of all stretches of a buffer from one prefix sum, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd multipliers and seeds of the byte values, for two hashes of one stretch.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
SEEDS = (20_240_611, 77_003_141)

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@lru_cache(maxsize=2)
def byte_values(which: int = 0) -> np.ndarray:
    return np.random.default_rng(SEEDS[which]).integers(1, 2**64, 256, dtype=np.uint64)


@lru_cache(maxsize=2)
def powers(bits: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first ``2**bits`` powers of a base and of its inverse."""
    size = 1 << bits
    out = []
    for base in (BASES[which], pow(BASES[which], -1, 2**64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps, out=steps))
    return out[0], out[1]


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits spread, so that high and low ones are equally good."""
    out = values ^ (values >> np.uint64(31))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


class Rolling:
    """``hashes(starts, lengths)`` gives a 64-bit hash of each stretch; equal bytes have equal hashes anywhere.

    Polynomials modulo 2**64 over random byte values: stretches of under 1,024 bytes have no known systematic
    collisions. ``which`` chooses one of two hashes that have nothing to do with each other.
    """

    def __init__(self, buffer: np.ndarray, which: int = 0) -> None:
        size = len(buffer)
        power, self.inverse = powers(max(20, int(size).bit_length()), which)
        self.prefix = np.zeros(size + 1, np.uint64)
        np.cumsum(byte_values(which)[buffer] * power[:size], out=self.prefix[1:])

    def raw(self, starts: np.ndarray, lengths) -> np.ndarray:
        return (self.prefix[starts + lengths] - self.prefix[starts]) * self.inverse[starts]

    def hashes(self, starts: np.ndarray, lengths) -> np.ndarray:
        return mixed(self.raw(starts, lengths))

    def all_of(self, length: int) -> np.ndarray:
        """The hash at every start of a stretch of this length."""
        count = max(0, len(self.prefix) - length)
        return mixed((self.prefix[length:] - self.prefix[:count]) * self.inverse[:count])


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches in which the mask is set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, a line feed after each, with their starts and ends."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), ends - sizes, ends
