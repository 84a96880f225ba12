"""Toxicity by multiple-instance learning: a document is toxic if any sentence is.

A sentence's probability is logistic in its words and word beginnings; sentences combine by noisy-or with
a leak, P = 1 - (1 - leak) prod(1 - p_s). The leak is what no sentence explains, such as labels without a
reason in the text: without it the sentences' own bias must, and long texts come to look toxic for their
length. All is trained from document labels alone, by gradient of the documents' likelihood, and then
locates the offending sentences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .words import NOT_ALNUM, mix, words_of

#: Training takes labelled documents of each class in order of the hashes of their ids, whole texts of any
#: length, until it has so many of them or so many bytes: the document that reaches the bytes is the last.
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000
TOXIC_BYTES, CLEAN_BYTES = 3 << 20, 6 << 20
#: Word beginnings, in bytes, that are features beside the whole word.
BEGINNINGS = (4, 5, 6)
#: Features kept: in at least so many training documents, the most telling first.
LEAST_DOCS, MOST_FEATURES = 5, 20_000
THRESHOLD = 0.3
#: Steps of the fit, and its shrinkage.
ROUNDS, L2 = 300, 1e-5
_END = np.zeros(256, bool)
_END[[0x0A, 0x21, 0x2E, 0x3F]] = True


def features_of(texts: list[bytes]):
    """(doc, sentence, word starts, word ends, hashes by feature kind) of A-Z lower-cased texts. Sentences
    end at . ! ? and line ends and are numbered through the batch; kind 0 is the word, the others its
    beginnings, where it is longer."""
    low = [t.lower() for t in texts]
    doc, starts, ends, whole = words_of(low, NOT_ALNUM)
    buf = np.frombuffer(b"\n".join(low), np.uint8)
    sentence = np.cumsum(_END[buf])[starts] if len(starts) else starts
    kinds = [whole]
    for k, n in enumerate(BEGINNINGS):
        got = np.zeros(len(starts), np.uint64)
        long = np.flatnonzero(ends - starts > n)
        for j in range(n):
            got[long] = mix(got[long] ^ (buf[starts[long] + j].astype(np.uint64) + np.uint64((k + 1) << 8)))
        kinds.append(got)
    return doc, sentence, starts, ends, kinds


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    leak: float = -5.0  # as a logit

    def logits(self, n: int, sentence: np.ndarray, kinds: list[np.ndarray]) -> np.ndarray:
        z = np.full(n, self.bias)
        for own in kinds:
            if len(self.features) and len(own):
                at = np.minimum(np.searchsorted(self.features, own), len(self.features) - 1)
                z += np.bincount(sentence, weights=np.where(self.features[at] == own, self.weights[at], 0.0), minlength=n)[:n]
        return z

    def score(self, texts: list[bytes]):
        """(document scores; then by sentence with words: doc, first byte, end byte, probability)."""
        doc, sentence, starts, ends, kinds = features_of(texts)
        none = np.zeros(0, np.int64)
        if not len(doc):
            return np.full(len(texts), 1 / (1 + np.exp(-self.leak))), none, none, none, np.zeros(0)
        head = np.concatenate([[True], (sentence[1:] != sentence[:-1]) | (doc[1:] != doc[:-1])])
        own, first = np.cumsum(head) - 1, np.flatnonzero(head)
        z = self.logits(len(first), own, kinds)
        miss = np.bincount(doc[first], weights=-np.logaddexp(0, z), minlength=len(texts))
        score = -np.expm1(miss - np.logaddexp(0, self.leak))
        last = np.concatenate([first[1:], [len(doc)]]) - 1
        return score, doc[first], starts[first], ends[last], 1 / (1 + np.exp(-z))


def fit(texts: list[bytes], toxic: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS, l2: float = L2) -> Model:
    """Full-batch Adam on the weighted log likelihood of the documents' labels."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -5.0)
    doc, sentence, _, _, kinds = features_of(texts)
    y = toxic.astype(float)
    if not len(doc) or y.min() == y.max():
        return none
    head = np.concatenate([[True], (sentence[1:] != sentence[:-1]) | (doc[1:] != doc[:-1])])
    own = np.cumsum(head) - 1
    sent_doc = doc[head]
    pairs_d, pairs_f = [], []
    for k in kinds:
        keep = k != 0
        order = np.lexsort((k[keep], doc[keep]))
        d, f = doc[keep][order], k[keep][order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (f[1:] != f[:-1])])
        pairs_d.append(d[new])
        pairs_f.append(f[new])
    d, f = np.concatenate(pairs_d), np.concatenate(pairs_f)
    names, at = np.unique(f, return_inverse=True)
    in_toxic = np.bincount(at, weights=y[d], minlength=len(names))
    in_all = np.bincount(at, minlength=len(names))
    rate = y.mean()
    z = (in_toxic - in_all * rate) / np.sqrt(in_all * rate * (1 - rate))
    z[in_all < LEAST_DOCS] = 0
    chosen = np.argsort(-np.abs(z), kind="stable")[:MOST_FEATURES]
    chosen = np.sort(chosen[np.abs(z[chosen]) > 3])
    if not len(chosen):
        return none
    names = names[chosen]
    rows, cols = [], []
    for k in kinds:
        place = np.minimum(np.searchsorted(names, k), len(names) - 1)
        hit = names[place] == k
        rows.append(own[hit])
        cols.append(place[hit])
    r, c = np.concatenate(rows), np.concatenate(cols)
    w, b, leak = np.zeros(len(names)), -5.0, -5.0
    m, v = np.zeros(len(names) + 2), np.zeros(len(names) + 2)
    total = weight.sum()
    for t in range(1, rounds + 1):
        zs = b + np.bincount(r, weights=w[c], minlength=len(sent_doc))
        p = 1 / (1 + np.exp(-zs))
        log_miss = np.bincount(sent_doc, weights=-np.logaddexp(0, zs), minlength=len(y)) - np.logaddexp(0, leak)
        hit = -np.expm1(log_miss)
        pull = np.where(y > 0, np.exp(log_miss) / np.maximum(hit, 1e-12), -1.0) * weight
        g = p * pull[sent_doc]
        biases = [g.sum() / total, (pull / (1 + np.exp(-leak))).sum() / total]
        grad = np.concatenate([np.bincount(c, weights=g[r], minlength=len(w)) / total - l2 * w, biases])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b, leak = w + step[:-2], b + step[-2], leak + step[-1]
    return Model(names, w, float(b), float(leak))


def held_out(doc_id: Column) -> Column:
    """A null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, most_toxic: int | None = None, most_clean: int | None = None) -> Model:
    """From labelled documents that are not held out: a sample whose size no table changes (most_toxic and
    most_clean documents, by default TRAIN_TOXIC and TRAIN_CLEAN, and the bytes above), drawn from the ids that
    docs has a text of. The classes' weights restore their share among all labelled rows. Rows
    with a null label or doc_id are left out; of several labels of a document, the largest counts."""
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    lab = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).where("toxic is not null and doc_id is not null")
    lab = lab.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = {r["y"]: r["n"] for r in lab.groupBy((F.col("toxic") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    sizes = own.where("text is not null").select("doc_id", F.octet_length("text").alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    present = lab.join(sizes, "doc_id")
    chosen = []
    for is_toxic, most, most_bytes in ((True, most_toxic or TRAIN_TOXIC, TOXIC_BYTES), (False, most_clean or TRAIN_CLEAN, CLEAN_BYTES)):
        part = present.where((F.col("toxic") > 0) == F.lit(is_toxic)).select(F.xxhash64("doc_id").alias("h"), "doc_id", "n")
        taken = 0
        for r in part.orderBy("h", "doc_id").limit(most).collect():
            if taken >= most_bytes:
                break
            taken += r["n"]
            chosen.append((r["doc_id"], is_toxic))
    if not chosen:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -5.0)
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, is_toxic boolean")  # no more rows than the sample's bound
    some = own.where("text is not null").join(F.broadcast(ids), "doc_id")
    some = some.dropDuplicates(["doc_id"])  # repeated rows of an id do not lift the bound
    rows = [(r["text"].encode(), r["is_toxic"]) for r in sorted(some.collect(), key=lambda r: r["doc_id"])]
    y = np.array([t for _, t in rows], bool)
    n = {k: max((y == k).sum(), 1) for k in (True, False)}
    weight = np.array([max(count.get(bool(t), 0), 1) / n[bool(t)] for t in y]) if len(y) else np.zeros(0)
    return fit([t for t, _ in rows], y, weight) if len(y) else Model(np.zeros(0, np.uint64), np.zeros(0), -5.0)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None) -> DataFrame:
    """One row per row of docs (doc_id, text; other columns are ignored): doc_id, held_out, score,
    predicted, and sentences, the offending ones: code points start and end (exclusive) and score.

    Null, empty and blank texts have the model's least score. Repeated rows get a row each and equal
    scores. With no usable label the model is its bias. An empty table gives no rows."""
    small_batches(docs.sparkSession)
    model = model or train(docs, labels)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(2).cast(pa.binary()).to_pylist()]
            score, doc, start, end, p = held.value.score(texts)
            base, found = np.cumsum([0, *(len(t) + 1 for t in texts)]), [[] for _ in texts]
            for k in np.flatnonzero(p >= threshold):
                d = int(doc[k])
                a, b = int(start[k] - base[d]), int(end[k] - base[d])
                first = len(texts[d][:a].decode("utf-8", "replace"))
                found[d].append({"start": first, "end": first + len(texts[d][a:b].decode("utf-8", "replace")), "score": float(p[k])})
            cols = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "held_out", "score", "predicted", "sentences"])

    d = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held_out(docs["doc_id"]).alias("held_out"), docs["text"].cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, sentences array<struct<start: long, end: long, score: double>>")


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with all their columns, without the rows whose score reaches the threshold."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def clean(texts):
        import pandas as pd

        return pd.Series(held.value.score([(t or "").encode() for t in texts])[0] < threshold)

    return docs.where(F.pandas_udf(clean, "boolean")(docs["text"]))
