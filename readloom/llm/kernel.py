"""Vectorised text kernels shared by the operators that work on word or byte windows."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

#: Seeds and multipliers of the hash family: fixed values, the same on every executor.
SEED_A, SEED_B = 20240601, 20240602
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

WHITE = bytes([0x20, *range(0x09, 0x0E)])
UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes(range(0x61, 0x7B))
FOLD = bytes.maketrans(UPPER, LOWER)
#: Every ASCII byte that is neither digit nor letter becomes a space; A-Z becomes a-z.
ALNUM_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
SPACE = np.zeros(256, bool)
SPACE[list(WHITE)] = True


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(2**60, 2**62)) << 2) | 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, step = 1, base
    while done < n:
        k = min(done, n - done)
        out[done : done + k] = out[:k] * np.uint64(step)
        done, step = done + k, step * step % (1 << 64)
    return out


A, B = Powers(SEED_A), Powers(SEED_B)


def release() -> None:
    """Lets the tables of powers go; they grow again on demand."""
    for family in (A, B):
        family.up = family.down = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


#: Bytes of words that are their own hash, and what is left of eight bytes for each length.
SHORT = 15
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class Words:
    """Words of a batch: 128 bits of each, the document of each, the first word of each document.

    Of a word of up to 15 bytes the 128 bits are its bytes and its length, of a longer one a cryptographic
    digest; so no two words of a corpus have the same ones, whatever they were made for.
    """

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = b" ".join(texts) + b" " * 17
        space = SPACE[np.frombuffer(raw, np.uint8)]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(start, np.cumsum(sizes + 1) - sizes - 1)
        self.count = np.diff(np.append(self.first, len(start)))
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        size = end - start
        eights = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        low = eights[start] & _LEFT[np.minimum(size, 8)]
        high = eights[start + 8] & _LEFT[np.clip(size - 8, 0, 7)] | np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
        far = np.flatnonzero(size > SHORT)
        if len(far):
            digests: dict[bytes, bytes] = {}
            long = [raw[a:b] for a, b in zip(start[far].tolist(), end[far].tolist())]
            for w in long:
                if w not in digests:
                    digests[w] = blake2b(w, digest_size=16).digest()
            halves = np.frombuffer(b"".join(map(digests.__getitem__, long)), "<u8").reshape(-1, 2)
            low[far], high[far] = halves[:, 0], halves[:, 1] | np.uint64(0xFF << 56)  # no short word has this length
        high = mix(high)
        # Both are made anew one to one, so that each half alone spreads over the key space.
        self.lanes = np.stack((mix(low + high), mix(high ^ MIX_2)))

    def hashes(self, lane: int = 0) -> np.ndarray:
        return self.lanes[lane]

    def windows(self, size: int) -> np.ndarray:
        """First word of each window of ``size`` words inside one document."""
        n = len(self.doc)
        return np.flatnonzero(self.doc[size - 1 :] == self.doc[: n - size + 1]) if n >= size else np.empty(0, np.int64)

    def window_hashes(self, at: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
        """Hash of the windows that begin at some words, from one half of their words' hashes."""
        family, n = (A, B)[lane], len(self.doc)
        family.need(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.lanes[lane] * family.up[:n], out=total[1:])
        return mix((total[at + size] - total[at]) * family.down[at])


class Bytes:
    """The bytes of a batch, a separator after each document, and where documents begin and end."""

    def __init__(self, texts: list[bytes]):
        self.bytes = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_end = np.cumsum(lengths + 1) - 1
        self.doc_start = self.doc_end - lengths


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
