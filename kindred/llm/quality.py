"""Quality rules from a suffix array: maximal repeated substrings of each text, over its words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches
from .words import covered, words_of

SYMBOLS = b"#*$%&|<>"
_BLANK = bytes([0x20, *range(0x09, 0x0E)])
_WORD = re.compile(rb"[^\x20\x09-\x0D]")

SCHEMA = """doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
base_failed boolean, kept boolean, n_covered long, longest_repeat long"""


def suffix_ranks(first: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of several texts at once, by prefix doubling. first: dense ranks of the words,
    already different between texts; doc_end: for each word, where its text ends. levels[k] ranks the
    suffixes by their first 2**k words; only groups that are still tied are sorted again."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    head = np.concatenate([[True], first[order][1:] != first[order][:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, width = [rank.copy()], 1
    while True:
        tied = ~(head & np.concatenate([head[1:], [True]])) if n else head
        at = np.flatnonzero(tied)
        if not len(at):
            return order, levels
        own = order[at]
        nxt = own + width
        second = np.where(nxt < doc_end[own], rank[np.minimum(nxt, n - 1)], -1)
        by = np.lexsort((second, rank[own]))
        own, second, group = own[by], second[by], rank[own[by]]
        order[at] = own
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (second[1:] != second[:-1])])
        head[at] = fresh
        rank = rank.copy()
        rank[own] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        levels.append(rank)
        width *= 2


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray], doc_end: np.ndarray) -> np.ndarray:
    """For each suffix, the longest prefix that it shares with any other suffix of its text: the larger
    of the two common prefixes with its neighbours in the suffix array."""
    n = len(order)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    a, b = order[:-1], order[1:]
    some = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[some], b[some]
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + length, b + length
        ok = (i < doc_end[a]) & (j < doc_end[b])
        same = ok & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        length += same << k
    np.maximum.at(best, a, length)
    np.maximum.at(best, b, length)
    return best


def measure(texts: list[bytes], base_window: int = 5, min_repeat: int = 10) -> dict[str, np.ndarray]:
    """Figures of each text. n_covered: words in maximal repeats of min_repeat words or more;
    longest_repeat: the longest repeat's words, whatever its length."""
    m = len(texts)
    doc, _, _, hashes = words_of(texts)
    n_words = np.bincount(doc, minlength=m)
    doc_end = np.cumsum(n_words)[doc] if len(doc) else doc
    _, word = np.unique(hashes, return_inverse=True)
    _, first = np.unique(doc * (len(word) + 1) + word, return_inverse=True)
    lcp = neighbour_lcp(*suffix_ranks(first, doc_end), doc_end)
    out = {"n_words": n_words}
    for name, least in (("n_repeat_words", base_window), ("n_covered", min_repeat)):
        at = np.flatnonzero(lcp >= least)
        out[name] = np.bincount(doc[covered(at, at + lcp[at], len(doc))], minlength=m)
    out["longest_repeat"] = np.zeros(m, np.int64)
    np.maximum.at(out["longest_repeat"], doc, lcp)
    out["word_chars"] = np.array([len((t.translate(None, _BLANK)).decode("utf-8", "replace")) for t in texts], np.int64)
    out["n_symbols"] = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    dup = np.zeros(m, np.int64)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if _WORD.search(x)]
        dup[i] = len(lines) - len(set(lines))
    out["n_dup_lines"] = dup
    return out


def quality_rules(docs: DataFrame, min_repeat: int = 10, max_covered: float = 0.18, max_longest: int = 50) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are ignored).

    kept is false if base_failed, if maximal repeats of min_repeat words or more cover over max_covered
    of the words, or if one repeat is longer than max_longest words. A null or empty text has no words
    and fails the base rule; a null doc_id is kept as it is; repeated rows get a row each; an empty table
    gives none. A task holds one Arrow batch at a time, so memory follows the batch and the longest text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            f = measure(texts, min_repeat=min_repeat)
            n = f["n_words"]
            failed = (n < 10) | (100 * f["n_repeat_words"] > 20 * n)
            kept = ~failed & (f["n_covered"] <= max_covered * n) & (f["longest_repeat"] <= max_longest)
            long = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            cols = [batch.column(0), *(pa.array(f[x], pa.int64()) for x in long), pa.array(failed), pa.array(kept)]
            cols += [pa.array(f[x], pa.int64()) for x in ("n_covered", "longest_repeat")]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *long, "base_failed", "kept", "n_covered", "longest_repeat"])

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return d.mapInArrow(run, SCHEMA)
