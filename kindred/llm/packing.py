"""Best-fit packing into fixed-length sequences, certified by dual-feasible-function bounds.

Documents become pieces of at most `capacity` tokens. Full pieces are sequences of their own. The others
are dealt into partitions of bounded size and packed best-fit decreasing. Bins are counted against lower
bounds from dual feasible functions, of each partition and of the histogram of all lengths. If the whole
meets its bound, no packing is better. Else the partitions with a gap, to their own bound or to their mere
volume, keep their full bins, exchange the documents of the others and pack again, in ever fewer mixes."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stored

CAPACITY = 2048
#: Sequences that one partition packs: its tokens divided by the capacity. It bounds a task's memory.
BINS = 4096
#: Partitions that exchange documents with one another in each round.
MIX = 8
#: Fixed value: the pattern of a byte-level pre-tokenizer, which its files name but do not spell out.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White-space runs from this length on go to the tokenizer file's own library: the other one's pattern backtracks.
LONG_GAP = 100_000


def _byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones stand for themselves, the
    others for the letters from U+0100 on, in order."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Ids:
    """Ids of whole texts by a byte-level BPE file of `tokenizers`. Where its merges are in the order of their
    ids, merging by rank gives the same ids, and `tiktoken` does that several times as fast; tests compare
    both. Other files, and texts with very long gaps, are encoded by `tokenizers` itself.

    special_as_text: the strings of special tokens in a text are ordinary text, as the description of the
    public files sets it, so no document can write an end of text; else they become those tokens' ids, as the
    library does where it is not told."""

    def __init__(self, path: str, special_as_text: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = None if special_as_text or not names else re.compile("|".join(map(re.escape, names)))
        self.fast = self._ranked(path)
        self.gap = re.compile(r"\s{%d}" % LONG_GAP)

    @staticmethod
    def _ranked(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, split, letters = whole["model"], whole["pre_tokenizer"] or {}, _byte_letters()
        vocab, merges = model.get("vocab", {}), model.get("merges", [])
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not whole["normalizer"]
        if model.get("type") != "BPE" or not plain or any(vocab.get("".join(m)) != 256 + k for k, m in enumerate(merges)):
            return None
        ranks = {bytes(letters[c] for c in piece): k for piece, k in vocab.items() if k < 256 + len(merges)}
        return tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, without the end id."""
        if self.fast is None or len(text) >= LONG_GAP and self.gap.search(text) or self.special and self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


def tokenized(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, special_as_text: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of all pieces of all rows: the ids of the whole
    text, then id 0. A document over the capacity is cut from its end, so that only its first piece may be
    shorter. Null and empty texts are the end id alone. A null doc_id stays; repeated rows are rows of their
    own; an empty table gives none; other columns are ignored. special_as_text: see Ids."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids(path, special_as_text)
        for batch in batches:
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                got = ids_of.encode(text or "") + b"\0\0\0\0"
                n, low, nth = len(got) // 4, 0, 0
                high = n if n <= capacity else n % capacity or capacity
                while low < n:
                    part = got[4 * low : 4 * high]
                    for to, x in zip((doc, piece, start, length, crc), (k, nth, low, high - low, zlib.crc32(part))):
                        to.append(x)
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
                    low, high, nth = high, high + capacity, nth + 1
            cols = [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, longest first, each into the fullest bin that has room. Bins with
    equal room are alike, so a stack for each room and a bit mask of rooms find one at once."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, n = 0, 0
    for k, size in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = stacks[room].pop()
            if not stacks[room]:
                mask &= ~(1 << room)
        else:
            room, own, n = capacity, n, n + 1
        bins[k], offsets[k] = own, capacity - room
        stacks[room - size].append(own)
        mask |= 1 << (room - size)
    return bins, offsets


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that count[n] pieces of each length n need at least: the best of two families of dual feasible
    functions. For a cut c, sizes over capacity - c count as whole bins and those under c as nothing; for k,
    sizes are rounded down to k-ths of a bin by way of k + 1 of them."""
    size = np.arange(capacity + 1)
    best = 0
    number, mass = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * size)])
    for c in range(capacity // 2 + 1):
        high = capacity - c
        total = capacity * (number[-1] - number[high + 1]) + (mass[high + 1] - mass[c])
        best = max(best, -(-int(total) // capacity))
    for k in range(1, 33):
        share = (k + 1) * size
        whole = share % capacity == 0
        numer = np.where(whole, k * size, share // capacity * capacity)  # over k * capacity
        best = max(best, -(-int((count * numer).sum()) // (k * capacity)))
    return best


PLACED = "uid long, length long, part long, bin long, offset long, bound long, n_bins long, volume long, loose boolean"


def _pack(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        uid, length, part, was, at = (table.column(k).to_numpy() for k in ("uid", "length", "part", "bin", "offset"))
        by = np.lexsort((uid, length))
        uid, length, part, was, at = (x[by] for x in (uid, length, part, was, at))
        bins, offsets = best_fit(length, capacity)
        bound, n = lower_bound(np.bincount(length, minlength=capacity + 1), capacity), int(bins.max()) + 1
        names, old = np.unique(was, return_inverse=True)
        if was.min() >= 0 and len(names) <= n:  # the mix saved nothing: the earlier places stay
            bins, offsets, n = old, at, len(names)
        used = np.bincount(bins, weights=length)
        cols = [uid, length, part, bins, offsets, np.full(len(uid), bound), np.full(len(uid), n), np.full(len(uid), -(-int(length.sum()) // capacity))]
        return pa.table([*(pa.array(c.astype(np.int64)) for c in cols), pa.array(used[bins] < capacity)], names=["uid", "length", "part", "bin", "offset", "bound", "n_bins", "volume", "loose"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, bins: int = BINS) -> DataFrame:
    """pieces with sequence_id and offset. Every row is placed once; a sequence holds at most capacity
    tokens, gapless from 0. Equal rows are packed as the rows that they are. No rows: no sequences.

    part_bins and part_bound certify the partition that placed a row: the sequences that it took, and the lower
    bound of its lengths by dual feasible functions (both 1 for a piece that fills a sequence by itself)."""
    full = F.col("length") >= capacity
    own = stored(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    lengths = {r["length"]: r["n"] for r in own.where(~full).groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most one row for each length
    least = lower_bound(np.array([lengths.get(n, 0) for n in range(capacity + 1)], np.int64), capacity)
    parts = -(-sum(n * k for n, k in lengths.items()) // (bins * capacity)) or 1
    todo = own.where(~full).select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(parts)).alias("part"), F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    rounds, settled, done, level = 0, 0, [], (1 << 26)
    while True:
        placed = stored(todo.groupBy("part").applyInArrow(_pack(capacity), PLACED), "placed")
        named = placed.withColumn("sequence_id", F.lit(rounds) * F.lit(1 << 56) + F.col("part") * F.lit(level) + F.col("bin"))
        gap = F.col("loose") & (F.col("n_bins") > F.least("bound", "volume"))
        now = named.groupBy("part", "sequence_id").agg(F.max(gap).alias("gap")).agg(F.count("*"), F.sum(F.col("gap").cast("int")), F.countDistinct(F.when(F.col("gap"), F.col("part")))).first()
        if settled + now[0] <= least or parts == 1 or now[2] < 2:  # certified, or nothing left to exchange with
            done.append(named)
            break
        settled += now[0] - now[1]
        done.append(named.where(~gap))
        parts, rounds = -(-parts // MIX), rounds + 1
        # an earlier place is known by its sequence, which is unique among partitions
        todo = named.where(gap).select("uid", "length", F.floor(F.col("part") / MIX).alias("part"), F.col("sequence_id").alias("bin"), "offset")
    place = reduce(DataFrame.unionByName, [d.select("uid", "sequence_id", "offset", F.col("n_bins").alias("part_bins"), F.greatest("bound", "volume").alias("part_bound")) for d in done])
    short = own.where(~full).join(place, "uid")
    whole = own.where(full).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long"), "part_bins": F.lit(1).cast("long"), "part_bound": F.lit(1).cast("long")})
    return short.unionByName(whole).drop("uid")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row about the rows of pack(): pieces, sequences, and bound, the sequences that any packing of the
    same lengths takes at least. sequences - bound is how far from the best it can be."""
    counts = {r["length"]: r["n"] for r in packed.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most one row for each length
    least = counts.get(capacity, 0) + lower_bound(np.array([counts.get(n, 0) if n < capacity else 0 for n in range(capacity + 1)], np.int64), capacity)
    used = packed.select("sequence_id").distinct().agg(F.count("*").alias("sequences"))
    return used.select(F.lit(sum(counts.values())).cast("long").alias("pieces"), "sequences", F.lit(least).cast("long").alias("bound"))
