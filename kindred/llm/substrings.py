"""Exact substring dedup by seed and extend.

Seeds: of any 20 consecutive words, winnowing picks one 8-word anchor by content alone, so equal windows
pick equal anchors. Consecutive windows with one anchor form a cell; a cell's text is the anchor extended
both ways as far as windows choose it. Cells meet on their anchor:
 - a cell whose whole text also starts earlier repeats in all its windows (the maximal repeats' inside);
 - an anchor with cells of different text has repeats that end inside a cell (the repeats' edges): those
   cells are extended word by word, that is, their windows are compared one by one;
 - all other cells, nearly all of a corpus, are new text and go no further.
Each task first combines its own cells: of equal ones only the earliest goes on, and of an anchor with
cells of different text only two go to the group, the others being edges already. So a passage in a third
of all documents gives a group of a few rows per task, and no pairs are made anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stored, text_key
from .words import Spans, bounds_of, covered, gram_hashes, hashes_of, mix

WINDOW, ANCHOR = 20, 8
#: Rows that a task combines at a time: 56 bytes each.
BUFFER = 1 << 20
ROW, MARK, EDGE, GONE = 0, 1, 2, 3
ROWS = "key long, cell long, did long, text_hash long, start int, n int, kind int"
NAMES = ("key", "cell", "did", "text_hash", "start", "n", "kind")
TYPES = (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)
#: Stands for a null doc_id: later than all others.
LAST = (1 << 63) - 1


def cells(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, anchor's hash, cell's hash, first window's start in the text, windows) of all cells. The two hashes
    are of different families: equal cells are equal in both."""
    buf, doc, starts, ends = bounds_of(texts)
    none = np.zeros(0, np.int64)
    if len(doc) < WINDOW:
        return none, none, none, none, none
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    grams = gram_hashes(hashes_of(buf, starts, ends), ANCHOR)
    at = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1 :])  # starts of windows
    low, anchor = grams[at], at.copy()
    for k in range(1, WINDOW - ANCHOR + 1):
        less = grams[at + k] < low
        low = np.where(less, grams[at + k], low)
        anchor[less] = at[less] + k
    if not len(at):
        return none, none, none, none, none
    head = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
    n = np.diff(np.concatenate([head, [len(at)]]))
    start = at[head]
    text = Spans(hashes_of(buf, starts, ends, 1))(start, start + n - 1 + WINDOW)
    return doc[start], low[head].view(np.int64), text.view(np.int64), start - first[doc[start]], n


def window_hashes(texts: list[bytes], ranges: list[list[tuple[int, int]]]) -> tuple[np.ndarray, ...]:
    """(text, window's two hashes, start) of the n windows from start on, for each text's ranges (start, n)."""
    buf, doc, starts, ends = bounds_of(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    own = np.repeat(np.arange(len(texts)), [len(r) for r in ranges])
    start = np.array([s for r in ranges for s, _ in r], np.int64)
    n = np.array([k for r in ranges for _, k in r], np.int64)
    begin = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    own = np.repeat(own, n)
    at = first[own] + begin
    one, two = (Spans(hashes_of(buf, starts, ends, family))(at, at + WINDOW).view(np.int64) for family in (0, 1))
    return own, one, two, begin


def combine(rows: dict[str, np.ndarray], edges: bool) -> dict[str, np.ndarray]:
    """What a task knows of its own rows (kind ROW): of equal cells, all but the earliest are GONE; where
    edges, an anchor's cells of different text are EDGE, two of them MARK the anchor. EDGE and GONE get a
    key of their own, so that they pass through the groups spread out."""
    by = np.lexsort((rows["start"], rows["did"], rows["cell"], rows["key"]))
    rows = {k: v[by] for k, v in rows.items()}
    key, cell, did, start = rows["key"], rows["cell"], rows["did"], rows["start"]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new_cell = new_key | np.concatenate([[True], cell[1:] != cell[:-1]])
    lead = np.maximum.accumulate(np.where(new_cell, np.arange(len(key)), 0))
    kind = np.where((did != did[lead]) | (start != start[lead]), GONE, ROW).astype(np.int32)
    more: dict[str, np.ndarray] = {k: v[:0] for k, v in rows.items()}
    if edges:
        group = np.cumsum(new_key) - 1
        several = np.bincount(group, weights=new_cell)[group] > 1
        nth = np.cumsum(new_cell) - np.cumsum(new_cell)[np.maximum.accumulate(np.where(new_key, np.arange(len(key)), 0))]
        mark = several & new_cell & (nth < 2)
        more = {k: v[mark].copy() for k, v in rows.items()}
        more["kind"] = np.full(mark.sum(), MARK, np.int32)
        kind[several & (kind == ROW)] = EDGE
    own = kind >= EDGE
    spread = mix((did[own].astype(np.uint64) << np.uint64(20)) ^ rows["text_hash"][own].view(np.uint64) ^ start[own].astype(np.uint64)).view(np.int64)
    rows = rows | {"kind": kind, "key": key.copy(), "cell": cell.copy()}
    rows["key"][own] = spread
    rows["cell"][own] = spread
    return {k: np.concatenate([rows[k], more[k]]) for k in NAMES}


def _combined(parts: Iterator[dict[str, np.ndarray]], edges: bool) -> Iterator[pa.RecordBatch]:
    held: list[dict[str, np.ndarray]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if any(len(p["key"]) for p in held):
            out = combine({k: np.concatenate([p[k] for p in held]).astype(t) for k, t in zip(NAMES, TYPES)}, edges)
            for at in range(0, len(out["key"]), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(out[k][at : at + (1 << 17)].astype(t)) for k, t in zip(NAMES, TYPES)], names=list(NAMES))
        held.clear()

    for part in parts:
        held.append(part)
        if sum(len(p["key"]) for p in held) >= BUFFER:
            yield from flush()
    yield from flush()


def _seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            did, th = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            doc, key, cell, start, n = cells([x or b"" for x in batch.column(2).cast(pa.binary()).to_pylist()])
            yield {"key": key, "cell": cell, "did": did[doc], "text_hash": th[doc], "start": start, "n": n, "kind": np.zeros(len(doc), np.int32)}

    return _combined(parts(), True)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def parts() -> Iterator[dict[str, np.ndarray]]:
        for batch in batches:
            did, th = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            ranges = [[(x["start"], x["n"]) for x in r] for r in batch.column(3).to_pylist()]
            doc, key, cell, start = window_hashes([x or b"" for x in batch.column(2).cast(pa.binary()).to_pylist()], ranges)
            one = np.ones(len(doc), np.int32)
            yield {"key": key, "cell": cell, "did": did[doc], "text_hash": th[doc], "start": start, "n": one, "kind": 0 * one}

    return _combined(parts(), False)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(texts, batch.column(2).to_pylist()):
            words = (text or b"").split()
            n_words.append(len(words))
            if ranges:
                start = np.array([r["start"] for r in ranges], np.int64)
                gone = covered(start, start + np.array([r["n"] for r in ranges]) + (WINDOW - 1), len(words))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["did", "n_words", "n_removed", "kept_text"])


def _lists(rows: DataFrame) -> DataFrame:
    """A document's ranges in one row: no longer than its text."""
    return rows.groupBy("did", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def _later(first: Column) -> Column:
    return F.struct("did", "start") > first


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are ignored): doc_id, n_words, n_removed and
    kept_text, the words that are left, joined by one space.

    Removed is each word inside a window of WINDOW words whose word sequence also starts earlier: in a
    smaller doc_id, or in the same document before. A null doc_id is later than any other. Rows that
    share a doc_id are one place in that order: equal starts there are a tie, and a tie is not earlier, so
    repeated rows get equal results. Null, empty and short texts have no window. Windows are compared by two
    independent 64-bit hashes, cells by their anchor's hash and one of their text. An empty table gives no rows."""
    small_batches(docs.sparkSession)
    own = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("did"), text_key("text").alias("text_hash"), docs["text"].cast("string").alias("text"))
    seeds = own.mapInArrow(_seed, ROWS)
    of_key, of_cell = Window.partitionBy("key"), Window.partitionBy("key", "cell")
    met = seeds.withColumn("first", F.min(F.struct("did", "start")).over(of_cell)).withColumns({"low": F.min("cell").over(of_key), "high": F.max("cell").over(of_key)})
    kind = F.when(F.col("kind") != ROW, F.col("kind")).when(_later(F.col("first")), GONE).when(F.col("low") != F.col("high"), EDGE).otherwise(MARK)
    known = stored(met.select("did", "text_hash", "start", "n", kind.alias("kind")).where(f"kind >= {EDGE}"), "repeats")

    edges = _lists(known.where(f"kind = {EDGE}"))
    windows = own.join(edges, ["did", "text_hash"]).select("did", "text_hash", "text", "ranges").mapInArrow(_extend, ROWS)
    windows = windows.withColumn("first", F.min(F.struct("did", "start")).over(of_cell))
    more = windows.where((F.col("kind") == GONE) | _later(F.col("first"))).select("did", "text_hash", "start", "n")
    gone = _lists(known.where(f"kind = {GONE}").select("did", "text_hash", "start", "n").unionByName(more))
    rows = own.join(gone, ["did", "text_hash"], "left").select("did", "text", "ranges")
    out = rows.mapInArrow(_cut, "did long, n_words long, n_removed long, kept_text string")
    return out.select(F.when(F.col("did") != LAST, F.col("did")).alias("doc_id"), "n_words", "n_removed", "kept_text")
