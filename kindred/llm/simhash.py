"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 4 of 64 bits share a variant at 2 bits or fewer from both. So each
distinct fingerprint has a ball of 2,081 variants, those within half the radius, and fingerprints that meet
at a variant are linked. Variants with equal leading bits go to one bucket: what is shuffled is a row for
each fingerprint and bucket that its ball reaches (29 of 128 buckets at 7 bits), and the bucket's task lists
the variants that fall in it, in slices of bounded size. A bucket in which a crowd of near copies lies is
split by further bits. Fingerprints at one variant are within 4 bits of one another, so neighbours in order
are verified and joined, and a task returns a spanning forest of its links, never pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frequent, hot_join, shuffle_partitions, small_batches, stored, text_key
from .components import components

RADIUS = 4
HALF = RADIUS // 2
#: Fingerprints by which buckets are counted out, and beyond which one is split by further bits.
BUCKET, CROWD = 1 << 16, 1 << 18
#: Variants that a task lists at once: 8 bytes each.
AT_ONCE = 1 << 22
MOST_TASKS = 1 << 13


def fingerprint(text: bytes, width: int = 4) -> int:
    """Of a UTF-8 text: majority bits of XXH64 (seed 42) over shingles of width words, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    line, digest, at, starts, ends = b" ".join(words), xxhash.xxh64_intdigest, 0, [], []
    for n in map(len, words):
        starts.append(at)
        ends.append(at + n)
        at += n + 1
    if len(words) <= width:
        return digest(line, 42)
    bits = np.zeros(64, np.int64)
    for low in range(0, len(words) - width + 1, 1 << 14):
        high = min(low + (1 << 14), len(words) - width + 1)
        got = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts[low:high], ends[low + width - 1 : high + width - 1])), "<u8", high - low)
        bits += np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(words) - width + 1, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column) -> Column:
    """As a signed long with the same 64 bits."""

    @F.pandas_udf("long")
    def run(texts):
        import pandas as pd

        return pd.Series(np.array([fingerprint((t or "").encode()) for t in texts], np.uint64).view(np.int64), dtype="int64")

    return run(text)


@cache
def _masks(bits: int, flips: int) -> np.ndarray:
    """All masks of at most so many of the low bits."""
    return np.array([sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(bits), k)], np.uint64)


def _lead(u: np.ndarray, bits: int) -> np.ndarray:
    return u >> np.uint64(64 - bits)


def deal(u: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row): the buckets that the balls of the fingerprints u reach. A bucket is a 1 and then its
    leading bits. levels: numbers of leading bits, each with the buckets that the next level splits."""
    bits, _ = levels[0]
    masks = _masks(bits, HALF)
    key, row = (_lead(u, bits)[:, None] ^ masks).reshape(-1), np.repeat(np.arange(len(u)), len(masks))
    buckets, rows = [], []
    for (bits, crowded), (longer, _) in zip(levels, [*levels[1:], (0, None)]):
        split = np.isin(key, crowded)
        buckets.append(key[~split] | np.uint64(1 << bits))
        rows.append(row[~split])
        key, row = key[split], row[split]
        if not len(key):
            break
        own = _lead(u[row], longer) & np.uint64((1 << (longer - bits)) - 1)
        left = HALF - np.bitwise_count(_lead(u[row], bits) ^ key).astype(np.int64)
        parts = []
        for k in range(HALF + 1):
            at, masks = np.flatnonzero(left == k), _masks(longer - bits, k)
            parts.append((((key[at] << np.uint64(longer - bits)) | own[at])[:, None] ^ masks).reshape(-1))
            parts.append(np.repeat(row[at], len(masks)))
        key, row = np.concatenate(parts[::2]), np.concatenate(parts[1::2])
    return np.concatenate(buckets).view(np.int64), np.concatenate(rows)


def meetings(u: np.ndarray, row: np.ndarray, left: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that share a variant in one bucket of so many leading bits; left: how many bits each
    row's variants may still differ in. Slices by the next bits keep the variants listed at once few."""
    if sum(int((left == k).sum()) * len(_masks(64 - bits, k)) for k in range(HALF + 1)) > AT_ONCE and bits < 60:
        nibble = _lead(u, bits + 4) & np.uint64(15)
        for k in range(16):
            rest = left - np.bitwise_count(nibble ^ np.uint64(k))
            near = rest >= 0
            yield from meetings(u[near], row[near], rest[near], bits + 4)
        return
    low = u & np.uint64((1 << (64 - bits)) - 1)
    size = [len(_masks(64 - bits, k)) for k in range(HALF + 1)]
    own = [np.flatnonzero(left == k) for k in range(HALF + 1)]
    variant = np.concatenate([(low[at][:, None] ^ _masks(64 - bits, k)).reshape(-1) for k, at in enumerate(own)])
    ranked = np.sort(variant)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return
    # rows are looked up only for variants that occur twice, found by a bitmap of their hashes
    place = lambda v: (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)
    flag = np.zeros(1 << 22, bool)
    flag[place(twice)] = True
    at = np.flatnonzero(flag[place(variant)])
    first = np.cumsum([0, *(len(o) * n for o, n in zip(own, size))])
    kind = np.searchsorted(first, at, side="right") - 1
    who = np.empty(len(at), np.int64)
    for k in range(HALF + 1):
        mine = kind == k
        who[mine] = row[own[k][(at[mine] - first[k]) // size[k]]] if mine.any() else 0
    order = np.argsort(variant[at], kind="stable")
    v, who = variant[at][order], who[order]
    same = np.flatnonzero(v[1:] == v[:-1])
    yield who[same], who[same + 1]


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of links a to b, those of a spanning forest of what they join; root, the least row of each row's
    component, is brought up to date."""
    used = []
    while len(a):
        x, y = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        at = np.flatnonzero(x != y)
        at = at[np.lexsort((x[at], y[at]))]
        at = at[np.concatenate([[True], y[at][1:] != y[at][:-1]])] if len(at) else at  # each root joins one below it
        if not len(at):
            break
        used.append(at)
        root[y[at]] = x[at]
        while (root[root] != root).any():
            root[:] = root[root]
    return np.concatenate(used) if used else np.zeros(0, np.int64)


def forest(bucket: int, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): links of a spanning forest of the distinct fingerprints u that meet in the bucket."""
    bits = bucket.bit_length() - 1
    left = HALF - np.bitwise_count(_lead(u, bits) ^ np.uint64(bucket - (1 << bits))).astype(np.int64)
    root, ends = np.arange(len(u)), []
    for a, b in meetings(u, np.arange(len(u)), left, bits):
        ok = np.bitwise_count(u[a] ^ u[b]) <= RADIUS
        a, b = a[ok], b[ok]
        at = joined(root, a, b)
        ends.append((u[a[at]], u[b[at]]))
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x).view(np.int64) for x in zip(*ends))


def bucket_levels(fps: DataFrame, n: int) -> list[tuple[int, np.ndarray]]:
    """Leading bits for n fingerprints, then the crowded buckets of each level: at most n / CROWD numbers."""
    need = lambda size: max(n // size, 1).bit_length()
    levels, bits = [], max(min(7, max(3, need(1024))), need(BUCKET))
    while True:
        lead = F.shiftrightunsigned("fp", 64 - bits)
        crowded = [r[0] for r in fps.groupBy(lead.alias("lead")).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("lead").collect()]
        levels.append((bits, np.array(sorted(crowded) if bits < 44 else [], np.uint64)))
        if not len(levels[-1][1]):
            return levels
        bits += 6


def link_edges(fps: DataFrame) -> DataFrame:
    """fps (fp long, distinct) -> (a, b): links whose components are those of all pairs within RADIUS bits."""
    levels = bucket_levels(fps, fps.count())

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096]
                bucket, row = deal(part.view(np.uint64), levels)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(part[row])], names=["bucket", "fp"])

    def meet(table: pa.Table) -> pa.Table:
        a, b = forest(table.column("bucket")[0].as_py(), np.ascontiguousarray(table.column("fp").to_numpy()).view(np.uint64))
        return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])

    tasks = max(min(1 << levels[-1][0], MOST_TASKS), shuffle_partitions(fps.sparkSession) if len(levels) > 1 else 1)
    dealt = fps.mapInArrow(emit, "bucket long, fp long").repartition(tasks, "bucket")
    return dealt.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are ignored): doc_id, text_hash (XXH64 of the
    text), fp, component_id, the smallest doc_id reachable over links of RADIUS bits or fewer, and root, the
    component's smallest fingerprint.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Equal texts have
    equal fingerprints, which are collapsed before any variant is made, so a group of copies of any size
    is one row there. A null doc_id counts as larger than any other: component_id is null only if all of
    the component's are. Repeated rows get a row each; an empty table gives none."""
    small_batches(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    own = stored(d.select("doc_id", text_key().alias("text_hash"), fingerprint_column(F.col("text")).alias("fp")), "fingerprints")
    each = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct")
    roots = stored(components(link_edges(each.select("fp"))), "roots")
    named = stored(each.join(roots, each["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "named")
    least = stored(named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"), F.count("*").alias("members")), "least")
    groups = stored(hot_join(named, "root", least, "of", frequent(least, "of", "members")).select(F.col("fp").alias("group_fp"), "component_id", "root", "n"), "groups")
    return hot_join(own, "fp", groups, "group_fp", frequent(groups, "group_fp", "n")).select("doc_id", "text_hash", "fp", "component_id", "root")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """docs with all their columns, one row of each component: that with the smallest doc_id (null last),
    then the smallest text hash. Rows equal in both are copies; one stays."""
    key = {"__kd_id": docs["doc_id"].cast("long"), "__kd_hash": text_key("text")}
    rows = docs.withColumns(key).dropDuplicates(list(key))  # copies of a row are put together before the shuffle
    groups = simhash_groups(docs)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r"))  # text_hash is never null
    reps = first.select(F.col("r.doc_id").alias("__kd_rep_id"), F.col("r.text_hash").alias("__kd_rep_hash"))
    on = rows["__kd_id"].eqNullSafe(reps["__kd_rep_id"]) & (rows["__kd_hash"] == reps["__kd_rep_hash"])
    return rows.join(reps, on, "left_semi").select(*docs.columns)
