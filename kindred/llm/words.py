"""Words of whole byte buffers at numpy speed: boundaries and 64-bit hashes without a Python loop."""

from __future__ import annotations

import numpy as np

#: Separators: ASCII white space, or (after A-Z are lower-cased) every ASCII byte but 0-9 and a-z.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_SLICE = 1 << 20
_ODD = 0x9E3779B97F4A7C15
#: Two families of word hashes, of a base and values of bytes of their own: together they are 128 bits.
_BASES = (_ODD, 0xA0761D6478BD642F)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        p = np.full(n, base & (2**64 - 1), np.uint64)
        p[0] = 1
        return np.cumprod(p, dtype=np.uint64)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    if family not in _TABLES or len(_TABLES[family][0]) < n:
        size = max(_SLICE + 1, 1 << int(n).bit_length())
        _TABLES[family] = (_powers(_BASES[family], size), _powers(pow(_BASES[family], -1, 2**64), size))
    return _TABLES[family]


def _hash_slice(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int) -> np.ndarray:
    up, down = _tables(len(buf), family)
    with np.errstate(over="ignore"):
        total = np.cumsum(_BYTE[family][buf] * up[: len(buf)], dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), total])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def bounds_of(texts: list[bytes], sep: np.ndarray = WHITE) -> tuple[np.ndarray, ...]:
    """(buffer, doc, starts, ends) of all words of the texts: doc is the text's index, starts and ends
    are byte offsets in the buffer, b"\\n".join(texts). Empty texts have no words."""
    data = b"\n".join(texts)
    buf = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~sep[buf]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(texts) else np.zeros(0, np.int64)
    return buf, np.searchsorted(first, starts, side="right") - 1, starts, ends


def hashes_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit hashes of the words of bounds_of()."""
    hashes, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):  # slices end between words; a longer word makes its slice longer
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _SLICE, side="right")))
        low, high = starts[at], ends[to - 1]
        hashes[at:to] = _hash_slice(buf[low:high], starts[at:to] - low, ends[at:to] - low, family)
        at = to
    return hashes


def words_of(texts: list[bytes], sep: np.ndarray = WHITE, hashed: bool = True):
    """(doc, starts, ends, hashes) of all words of the texts, see bounds_of() and hashes_of()."""
    buf, doc, starts, ends = bounds_of(texts, sep)
    return doc, starts, ends, hashes_of(buf, starts, ends) if hashed else None


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hashes of all runs of n words; one for each start that has n words after it."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(_ODD) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


class Spans:
    """Hashes of word ranges of any length in one array, from prefix sums."""

    def __init__(self, hashes: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            self.up, self.down = _powers(0xD1342543DE82EF95, len(hashes) + 1), _powers(pow(0xD1342543DE82EF95, -1, 2**64), len(hashes) + 1)
            self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes) * self.up[: len(hashes)], dtype=np.uint64)])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.total[ends] - self.total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge)[:n] > 0
