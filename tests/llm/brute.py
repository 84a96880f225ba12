"""Plain versions of the operators' contracts, one document at a time."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from math import log10

import xxhash

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def hexed(s):
    return sha256(s.encode()).hexdigest()


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def quality(text):
    words, lines = WHITE.findall(text or ""), [x for x in (text or "").split("\n") if WHITE.search(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    n = len(words)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), n < 10 or 100 * len(hit) > 20 * n


def longest_repeat(words):
    best = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
    return best


def substrings(rows):
    first = {}
    words = [WHITE.findall(t or "") for _, t in rows]
    order = [(i is None, i) for i, _ in rows]
    key = lambda d: (order[d][0], order[d][1] or 0)
    for d, ws in enumerate(words):
        for s in range(len(ws) - 19):
            g = tuple(ws[s : s + 20])
            at = (key(d), s)
            first[g] = min(first.get(g, at), at)
    out = []
    for d, (i, _) in enumerate(rows):
        ws = words[d]
        gone = {k for s in range(len(ws) - 19) if (key(d), s) > first[tuple(ws[s : s + 20])] for k in range(s, s + 20)}
        out.append((i, len(ws), len(gone), hexed(" ".join(w for k, w in enumerate(ws) if k not in gone))))
    return out


def decontaminate(rows, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        ws = word.findall(lower(t or ""))
        n = min(len(ws), 10)
        for s in range(len(ws) - n + 1 if n else 0):
            windows[tuple(ws[s : s + n])].add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in rows:
        ws, hit, got = word.findall(lower(t or "")), set(), set()
        for n in sizes:
            for s in range(len(ws) - n + 1):
                if (g := tuple(ws[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    got |= windows[g]
        ids = sorted(str(x) for x in got if x is not None)
        out.append((d, len(ws), len(hit), len(ids), hexed(",".join(ids)), bool(hit)))
    return out


def fingerprint(text):
    ws = WHITE.findall(lower(text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(rows):
    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, f"{fps[k]:016x}", least[find(k)]) for k, (i, _) in enumerate(rows)]


RULES = [("assign", r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8), ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 32)]


def secrets(text):
    spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(RULES) for m in re.finditer(p, text or "") if ok(m))
    n = Counter(k for _, _, k, _ in spans)
    return n["assign"], n["access"], n["hex"], hexed(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))


def lm_base(rows):
    tokens = [[*lower(t or "").encode().split(), None] for _, t in rows]
    out_of = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for ts, o in zip(tokens, out_of) if not o for w in ts)
    n, v = sum(c.values()), len(c)
    return [(i, o, len(ts), sum(c[w] > 0 for w in ts), n, sum(log10((c[w] + 1) / (n + v + 1)) for w in ts)) for (i, _), ts, o in zip(rows, tokens, out_of)]


HOST_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def url(u):
    if u is None or "://" not in u:
        host = path = ""
    else:
        rest = u.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = lower(host)
    fits = [(len(h + p), h + p, v) for h, p, v in HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best and best[2]
