"""Benchmark decontamination with training suffix arrays.

Each Arrow batch of documents is a shard. Its words are ranked against the benchmark's vocabulary; a
match can only lie in a run of known words as long as the shortest window, so the shard's suffix array
is built over those runs alone. Every test suffix is binary-searched in every shard's array; the range
found holds all its verbatim occurrences, which are chained into the longest matches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored, text_key
from .words import NOT_ALNUM, covered, words_of

WINDOW = 10
#: Bytes of benchmark text of one pass. A larger benchmark takes several passes over the documents.
BLOCK_BYTES = 16 << 20


class Tests:
    """The windows of one block of benchmark items, as ranks in the block's vocabulary (0: unknown)."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW) -> None:
        self.ids = [i for i, _ in items]
        item, _, _, hashes = words_of([(t or "").encode().lower() for _, t in items], NOT_ALNUM)
        self.vocabulary = np.unique(hashes)
        words = np.searchsorted(self.vocabulary, hashes) + 1
        n = np.bincount(item, minlength=len(items))
        first = np.cumsum(n) - n
        size = np.minimum(n, window)
        starts = np.concatenate([np.zeros(0, np.int64), *(first[i] + np.arange(n[i] - size[i] + 1) for i in range(len(items)) if n[i])])
        self.item, self.size = item[starts] if len(starts) else starts, size[item[starts]] if len(starts) else starts
        self.offset = starts - first[self.item] if len(starts) else starts
        self.least = int(self.size.min()) if len(starts) else 0
        at = starts[:, None] + np.arange(window)
        inside = np.arange(window) < self.size[:, None]
        self.words = np.where(inside, words[np.minimum(at, max(len(words) - 1, 0))], 0).astype(np.int32) if len(starts) else np.zeros((0, window), np.int32)


def search(tests: Tests, texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(n_words by text; then by occurrence of a window: text, word, test) of one shard."""
    doc, _, _, hashes = words_of([t.lower() for t in texts], NOT_ALNUM)
    n_words = np.bincount(doc, minlength=len(texts))
    none = np.zeros(0, np.int64)
    if not len(doc) or not tests.least:
        return n_words, none, none, none
    place = np.minimum(np.searchsorted(tests.vocabulary, hashes), len(tests.vocabulary) - 1)
    known = tests.vocabulary[place] == hashes
    first = np.cumsum(n_words) - n_words
    edge = np.concatenate([[True], doc[1:] != doc[:-1]]) | ~known | np.concatenate([[True], ~known[:-1]])
    run = np.cumsum(edge)
    length = np.bincount(run)[run] * known
    at = np.flatnonzero(length >= tests.least)  # words in runs that a window fits in
    if not len(at):
        return n_words, none, none, none
    run_end = np.searchsorted(run[at], run[at], side="right")
    words = (place[at] + 1).astype(np.int64)
    order = suffix_order(words, run_end, tests.words.shape[1])
    width = np.arange(tests.words.shape[1])

    def prefix(rows: np.ndarray) -> np.ndarray:
        cell = rows[:, None] + width
        return np.where(cell < run_end[rows][:, None], words[np.minimum(cell, len(words) - 1)], 0)

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(tests.words), np.int64), np.full(len(tests.words), len(order), np.int64)
        while (open_ := low < high).any():
            rows = np.flatnonzero(open_)
            mid = (low[rows] + high[rows]) // 2
            got, want = prefix(order[mid]), tests.words[rows]
            got = np.where(width < tests.size[rows][:, None], got, 0)
            differ = got != want
            k = np.argmax(differ, axis=1)
            less = np.where(differ.any(axis=1), got[np.arange(len(rows)), k] < want[np.arange(len(rows)), k], upper)
            low[rows] = np.where(less, mid + 1, low[rows])
            high[rows] = np.where(less, high[rows], mid)
        return low

    low, high = bound(False), bound(True)
    count = high - low
    test = np.repeat(np.arange(len(count)), count)
    hit = at[order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]]
    return n_words, doc[hit], hit - first[doc[hit]], test


def suffix_order(words: np.ndarray, run_end: np.ndarray, depth: int) -> np.ndarray:
    """The suffix array of the runs, by words and to the depth that a window can tell apart: prefix
    doubling stops there, so equal passages in many copies cost no more than one round each."""
    rank, width = np.unique(words, return_inverse=True)[1], 1
    n = len(rank)
    while width < depth:
        nxt = np.arange(n) + width
        second = np.where(nxt < run_end, rank[np.minimum(nxt, n - 1)] + 1, 0)
        _, rank = np.unique(rank * (n + 1) + second, return_inverse=True)
        width *= 2
    return np.argsort(rank, kind="stable")


def matches(tests: Tests, doc: np.ndarray, word: np.ndarray, test: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Longest verbatim matches: (text, item's index, word in text, word in item, words), windows chained
    along each diagonal."""
    item, offset, size = tests.item[test], tests.offset[test], tests.size[test]
    by = np.lexsort((offset, word - offset, item, doc))
    doc, item, word, offset, size = (x[by] for x in (doc, item, word, offset, size))
    if not len(by):
        return []
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | ((word - offset)[1:] != (word - offset)[:-1]) | (offset[1:] != offset[:-1] + 1)])
    head = np.flatnonzero(new)
    tail = np.concatenate([head[1:], [len(by)]]) - 1
    return list(zip(doc[head].tolist(), item[head].tolist(), word[head].tolist(), offset[head].tolist(), (offset[tail] - offset[head] + size[tail]).tolist()))


class Blocks(Sequence):
    """The test windows in blocks of about BLOCK_BYTES of text, each read when it is asked for: the driver
    holds one at a time. One block for any benchmark up to that size."""

    def __init__(self, benchmark: DataFrame, window: int = WINDOW) -> None:
        self.items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), benchmark["text"].cast("string").alias("text"))
        self.window = window
        size = self.items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n = -(-size // BLOCK_BYTES) or 1

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, k: int) -> Tests:
        if not 0 <= k < self.n:
            raise IndexError(k)
        own = self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n)) == k) if self.n > 1 else self.items
        return Tests([(r[0], r[1]) for r in own.collect()], self.window)


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW) -> Blocks:
    return Blocks(benchmark, window)


def _scan(docs: DataFrame, held: Broadcast) -> DataFrame:
    """doc_id, text_hash, n_words, matches of each row with a broadcast block, in one pass and no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int64()), ("item_word", pa.int64()), ("n_words", pa.int64())]))
        for batch in batches:
            texts = [x or b"" for x in batch.column(2).cast(pa.binary()).to_pylist()]
            n_words, doc, word, test = search(known, texts)
            found: list[list[dict]] = [[] for _ in texts]
            for d, i, w, o, n in matches(known, doc, word, test):
                found[d].append({"item_id": known.ids[i], "doc_word": w, "item_word": o, "n_words": n})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(found, kind)], names=["doc_id", "text_hash", "n_words", "matches"])

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key("text").alias("text_hash"), docs["text"].cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, text_hash long, n_words long, matches array<struct<item_id: string, doc_word: long, item_word: long, n_words: long>>")


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, n_words and all longest verbatim matches with their
    places. Repeated rows get a row each, however many blocks there are: past one block, each block's matches
    are written and then joined to all rows by id and text hash. Null and empty texts have no
    words; an item with fewer words than a window is one window, one with none matches nothing; a null
    item_id matches but has no name; an empty table gives no rows or no matches."""
    small_batches(docs.sparkSession)
    share, blocks = docs.sparkSession.sparkContext.broadcast, benchmark_blocks(benchmark, window)
    if len(blocks) == 1:
        return _scan(docs, share(blocks[0]))
    found = reduce(DataFrame.unionByName, [stored(found, f"block{k}") for k, found in enumerate(_hits(docs, blocks))])
    whole = found.groupBy(F.col("doc_id").alias("in_doc"), F.col("text_hash").alias("in_hash")).agg(F.flatten(F.collect_list("matches")).alias("found"))
    rows = _scan(docs, share(Tests([])))  # every row once, with its words
    on = rows["doc_id"].eqNullSafe(whole["in_doc"]) & (rows["text_hash"] == whole["in_hash"])
    return rows.join(whole, on, "left").select("doc_id", "text_hash", "n_words", F.coalesce("found", "matches").alias("matches"))


def _hits(docs: DataFrame, blocks: Blocks) -> Iterator[DataFrame]:
    """For each block, the rows with matches, copies once. A block is freed when the next one is asked for, so
    each table is to be written before that."""
    for tests in blocks:
        held = docs.sparkSession.sparkContext.broadcast(tests)
        # copies have equal matches: one copy's are taken
        yield _scan(docs, held).where("size(matches) > 0").groupBy("doc_id", "text_hash").agg(F.first("matches").alias("matches"))
        held.destroy()


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of benchmark_matches()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_hit, n_items, sha = [], [], []
            for got in batch.column(2).to_pylist():
                spans = [(m["doc_word"], m["doc_word"] + m["n_words"]) for m in got or ()]
                low, high = min((a for a, _ in spans), default=0), max((b for _, b in spans), default=0)
                n_hit.append(int(covered(np.array([a - low for a, _ in spans], np.int64), np.array([b - low for _, b in spans], np.int64), high - low).sum()))
                ids = sorted({m["item_id"] for m in got or () if m["item_id"] is not None})
                n_items.append(len(ids))
                sha.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
            cols = [batch.column(0), batch.column(1), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha), pa.array([x > 0 for x in n_hit], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.select("doc_id", "n_words", "matches").mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with all their columns, without the rows that hold any window of the benchmark."""
    small_batches(docs.sparkSession)
    blocks = benchmark_blocks(benchmark, window)
    if len(blocks) > 1:
        found = reduce(DataFrame.unionByName, [stored(found, f"block{k}") for k, found in enumerate(_hits(docs, blocks))])
        hits = found.select(F.col("doc_id").alias("__kd_hit_id"), F.col("text_hash").alias("__kd_hit_hash"))
        return docs.join(hits, docs["doc_id"].cast("long").eqNullSafe(hits["__kd_hit_id"]) & (text_key("text") == hits["__kd_hit_hash"]), "left_anti")
    held = docs.sparkSession.sparkContext.broadcast(blocks[0])

    def clean(texts):
        import pandas as pd

        raw = [(t or "").encode() for t in texts]
        out = np.ones(len(raw), bool)
        out[search(held.value, raw)[1]] = False
        return pd.Series(out)

    return docs.where(F.pandas_udf(clean, "boolean")(docs["text"]))
