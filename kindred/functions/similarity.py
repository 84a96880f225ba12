"""String similarities, 0 to 100: of one pair, plainly, and of many pairs at once, as the Arrow-batched column
functions over distinct pairs of a batch take them. Texts are compared by letters (code points)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Pairs whose letters are tabled at a time, and cuts that run at a time.
CHUNK, LANES = 1 << 12, 1 << 15


def lcs(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel over a's letters."""
    if not a or not b:
        return 0
    place: dict[str, int] = {}
    for k, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & place.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@lru_cache(100_000)
def ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


@lru_cache(100_000)
def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter against all windows of the longer, those over its ends included. Of two equally
    long ones, either may be cut."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n = len(a)
    cuts = lambda t: {t[max(0, k) : min(len(t), k + n)] for k in range(1 - n, len(t))}
    best = max(ratio(a, w) for w in cuts(b))
    return max(best, *(ratio(w, b) for w in cuts(a))) if len(b) == n else best


def _sorted(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(one, two), ratio(both, one) if both else 0.0, ratio(both, two) if both else 0.0)


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 100.0
    return max(partial_ratio(_sorted(a), _sorted(b)), partial_ratio(" ".join(sorted(x - y)), " ".join(sorted(y - x))))


def w_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    share = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if share < 1.5:
        return max(best, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.9 if share <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    """lcs() of many pairs at once: one 64-bit lane each for pairs whose shorter text has at most 64 letters."""
    flip = [len(x) > len(y) for x, y in zip(a, b)]
    short, long = ([y if f == first else x for x, y, f in zip(a, b, flip)] for first in (True, False))
    out = np.zeros(len(a), np.int64)
    n, m = _sizes(short), _sizes(long)
    wide = np.flatnonzero(n > 64)
    for k in wide.tolist():
        out[k] = lcs(short[k], long[k])
    fit = np.flatnonzero((n > 0) & (n <= 64))
    fit = fit[np.argsort(-m[fit], kind="stable")]
    for at, hits in _tables([short[k] for k in fit], [long[k] for k in fit]):
        own = fit[at]
        out[own] = _lanes(hits, np.cumsum(m[own]) - m[own], m[own], n[own])
    return out


def _sizes(texts: list[str]) -> np.ndarray:
    return np.fromiter(map(len, texts), np.int64, len(texts))


def _letters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _tables(a: list[str], b: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For chunks of pairs: their places; for each letter of b, one text after the other, the bits of where its
    a has that letter."""
    low = 0
    while low < len(a):
        high = min(len(a), low + CHUNK)
        of_a, of_b = _letters(a[low:high]), _letters(b[low:high])
        names, codes = np.unique(np.concatenate([of_a, of_b]), return_inverse=True)
        if len(names) * (high - low) > 64 * CHUNK and high - low > 1:  # many scripts: smaller chunks
            high = low + max(1, 64 * CHUNK // len(names))
            of_a, of_b = _letters(a[low:high]), _letters(b[low:high])
            names, codes = np.unique(np.concatenate([of_a, of_b]), return_inverse=True)
        n = _sizes(a[low:high])
        row = np.repeat(np.arange(high - low), n)
        place = np.arange(len(of_a)) - np.repeat(np.cumsum(n) - n, n)
        bits = np.zeros((high - low, len(names)), np.uint64)
        np.bitwise_or.at(bits, (row, codes[: len(of_a)]), np.uint64(1) << place.astype(np.uint64))
        yield np.arange(low, high), bits[np.repeat(np.arange(high - low), _sizes(b[low:high])), codes[len(of_a) :]]
        low = high


def _lanes(hits: np.ndarray, start: np.ndarray, size: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Longest common subsequences of texts of n letters with the runs of letters whose bits hits has from
    start, so many (size, in descending order)."""
    state = np.full(len(start), np.uint64(0xFFFFFFFFFFFFFFFF))
    live = len(start)
    with np.errstate(over="ignore"):
        for j in range(int(size[0]) if len(size) else 0):
            while live and size[live - 1] <= j:
                live -= 1
            now = state[:live]
            hit = now & hits[start[:live] + j]
            state[:live] = (now + hit) | (now ^ hit)
    full = np.where(n >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~state & full).astype(np.int64)


def _share(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = a + b
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    return _share(lcs_many(a, b), _sizes(a), _sizes(b))


def partial_many(a: list[str], b: list[str]) -> np.ndarray:
    """partial_ratio() of many pairs: all cuts of all pairs are lanes of one recursion."""
    pairs = [(x, y, k) if len(x) <= len(y) else (y, x, k) for k, (x, y) in enumerate(zip(a, b))]
    pairs += [(y, x, k) for x, y, k in pairs if len(x) == len(y) and x != y]  # of equally long ones, either may be cut
    out = np.zeros(len(a))
    for x, y, k in pairs:
        if not x:
            out[k] = 0.0 if y else 100.0
        elif len(x) > 64:
            out[k] = partial_ratio(x, y)
    pairs = [p for p in pairs if 0 < len(p[0]) <= 64]
    short, long, to = [p[0] for p in pairs], [p[1] for p in pairs], np.array([p[2] for p in pairs], np.int64)
    n, m = _sizes(short), _sizes(long)
    low = 0
    while low < len(pairs):  # so many pairs as have about LANES cuts
        high = max(low + 1, int(np.searchsorted(np.cumsum((n + m - 1)[low:]), LANES, side="right")) + low)
        for at, hits in _tables(short[low:high], long[low:high]):
            own = low + at
            cuts = n[own] + m[own] - 1
            row = np.repeat(np.arange(len(own)), cuts)
            k = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts) + 1 - n[own][row]
            begin, end = np.maximum(k, 0), np.minimum(k + n[own][row], m[own][row])
            order = np.argsort(begin - end, kind="stable")  # longest first
            row, begin, size = row[order], begin[order], (end - begin)[order]
            first = np.cumsum(m[own]) - m[own]
            common = _lanes(hits, first[row] + begin, size, n[own][row])
            np.maximum.at(out, to[own[row]], _share(common, n[own][row], size))
        low = high
    return out


def _token_sets(a: list[str], b: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Sorted words of both, of the left alone and of the right alone."""
    words = [(set(x.split()), set(y.split())) for x, y in zip(a, b)]
    return tuple([" ".join(sorted(f(x, y))) for x, y in words] for f in (set.__and__, set.__sub__, lambda x, y: y - x))


def token_set_many(a: list[str], b: list[str], parts=None) -> np.ndarray:
    """What both have leads both texts, so it is common as it stands and only the rests are compared."""
    both, left, right = parts or _token_sets(a, b)
    i, x, y = _sizes(both), _sizes(left), _sizes(right)
    gap = ((i > 0) & (x > 0)).astype(np.int64), ((i > 0) & (y > 0)).astype(np.int64)
    one, two = i + gap[0] + x, i + gap[1] + y
    rest = lcs_many(left, right)
    best = _share(i + (gap[0] & gap[1]) + rest, one, two)
    best = np.where(i > 0, np.maximum(best, np.maximum(_share(i, i, one), _share(i, i, two))), best)
    best = np.where((i > 0) & ((x == 0) | (y == 0)), 100.0, best)
    return np.where((i + x == 0) | (i + y == 0), 0.0, best)


def scores_many(a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """All five similarities of many pairs."""
    n, m = _sizes(a), _sizes(b)
    parts = _token_sets(a, b)
    sorted_a, sorted_b = ([_sorted(x) for x in t] for t in (a, b))
    out = {"ratio": ratio_many(a, b), "partial": partial_many(a, b), "token_sort": ratio_many(sorted_a, sorted_b), "token_set": token_set_many(a, b, parts)}
    longer, shorter = np.maximum(n, m), np.minimum(n, m)
    uneven = (shorter > 0) & (longer >= 1.5 * shorter)
    w = np.maximum(out["ratio"], 0.95 * np.maximum(out["token_sort"], out["token_set"]))
    at = np.flatnonzero(uneven)
    if len(at):
        some = np.array([bool(parts[0][k]) for k in at])
        of = lambda t: [t[k] for k in at]
        token = np.where(some, 100.0, np.maximum(partial_many(of(sorted_a), of(sorted_b)), partial_many(of(parts[1]), of(parts[2]))))
        scale = np.where(longer[at] <= 8 * shorter[at], 0.9, 0.6)
        w[at] = np.maximum(out["ratio"][at], np.maximum(scale * out["partial"][at], 0.95 * scale * token))
    out["w_ratio"] = np.where(shorter == 0, 0.0, w)
    return out


def _distinct(a: pd.Series, b: pd.Series) -> tuple[np.ndarray, list[str], list[str]]:
    """Place of each pair among the distinct ones of the batch, and those. Null is the empty text."""
    place: dict[tuple[str, str], int] = {}
    at = np.fromiter((place.setdefault((x or "", y or ""), len(place)) for x, y in zip(a, b)), np.int64, len(a))
    return at, [x for x, _ in place], [y for _, y in place]


def _column(f):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        at, x, y = _distinct(a, b)
        return pd.Series(f(x, y)[at], dtype="float64")

    return run


sim_ratio = _column(ratio_many)
sim_partial = _column(partial_many)
sim_token_sort = _column(lambda a, b: ratio_many([_sorted(x) for x in a], [_sorted(x) for x in b]))
sim_token_set = _column(token_set_many)
sim_w = _column(lambda a, b: scores_many(a, b)["w_ratio"])


@F.pandas_udf(StructType([StructField(k, DoubleType()) for k in ("ratio", "partial", "token_sort", "token_set", "w_ratio")]))
def sim_all(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """The five similarities of a pair in one pass."""
    at, x, y = _distinct(a, b)
    return pd.DataFrame({k: v[at] for k, v in scores_many(x, y).items()})
