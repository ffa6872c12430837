"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are all its byte-class trigrams (letters, capitals, digits, white space, kinds of
punctuation) and buckets of a few shape measures, such as the share of words that repeat the word
before.  Log counts are weighted by inverse document frequency in the training sample, and a
truncated SVD of the sample's matrix gives latent vectors.  The sample's vectors are sent to all
executors (their number is bounded by ``SAMPLE``); every document's exact cosine with every one of
them is computed in blocks of doubles, and the ``NEIGHBOURS`` nearest vote with their similarity's
power.  Cosines count to ``DIGITS`` decimals; of equal ones the sample's earlier row (by doc_id) is
nearer, so a score doesn't depend on the block that a text came in.

Only the text is an input of a score.  Null texts count as empty; very long texts are read whole.
Without labelled rows every score is 0.5; with one class only, that class.  Null ids score like
others and are never learnt from; repeated rows are scored as often as they occur, and an id is
learnt from once.  An empty table gives an empty result.  Columns of other names are left out by
``score`` and ``classify``, and kept as they are by ``filter_rows``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks
from trajkit.llm.labelled import Words, fitted, held_out, sample

#: Most labelled rows that the model is fitted on, by class.
SAMPLE = {0: 1500, 1: 3000}
DIMENSIONS, NEIGHBOURS, POWER, DIGITS = 48, 25, 8, 9
_CLASSES, _SHAPES, _BUCKETS = 16, 6, 16
TERMS = _CLASSES**3 + _SHAPES * _BUCKETS


def _byte_classes() -> np.ndarray:
    out = np.full(256, 14, np.int64)
    out[128:] = 15
    out[:32] = 1
    out[32] = 0
    for kind, chars in ((2, "abcdefghijklmnopqrstuvwxyz"), (3, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (4, "0123456789"), (5, "."), (6, ","), (7, "!?"), (8, "|"), (9, "#"), (10, "$"), (11, "%"), (12, "&"), (13, "*")):
        out[[ord(c) for c in chars]] = kind
    return out


_CLASS = _byte_classes()


def counts(texts: pa.Array) -> np.ndarray:
    """Log term counts, one row a text."""
    w = Words(texts)
    n, size = len(w.offsets) - 1, np.diff(w.offsets)
    doc = np.repeat(np.arange(n), size)
    kind = _CLASS[w.data]
    flat_counts = np.zeros(n * TERMS)
    if len(kind) > 2:
        same = doc[2:] == doc[:-2]
        code = (kind[:-2] * _CLASSES + kind[1:-1]) * _CLASSES + kind[2:]
        flat_counts += np.bincount((doc[2:] * TERMS + code)[same], minlength=n * TERMS)
    x = np.log1p(flat_counts.reshape(n, TERMS).astype(np.float32))
    words = np.maximum(np.diff(w.bounds), 1)
    after = (w.codes[1:] == w.codes[:-1]) & (w.doc[1:] == w.doc[:-1]) if len(w.codes) > 1 else np.zeros(0, bool)
    pairs = np.unique(w.doc * max(len(w.keys), 1) + w.codes)
    distinct = np.bincount(pairs // max(len(w.keys), 1), minlength=n)
    share = lambda classes: np.bincount(doc, np.isin(kind, classes), n) / np.maximum(size, 1)
    shapes = [np.bincount(w.doc[1:], after, n) / words if len(after) else np.zeros(n), distinct / words, share([3]), share([4]), share([7, 8, 9, 10, 11, 12, 13, 14]), np.minimum(np.log2(size + 1) / 20, 1)]
    for i, s in enumerate(shapes):
        bucket = np.minimum((s * _BUCKETS).astype(np.int64), _BUCKETS - 1)
        x[np.arange(n), _CLASSES**3 + i * _BUCKETS + bucket] = 4.0
    return x


class Model:
    def __init__(self, idf: np.ndarray, basis: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.idf, self.basis, self.vectors, self.labels = idf, basis, vectors, labels

    def latent(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64) * self.idf
        z = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)) @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        n, k = len(self.labels), min(NEIGHBOURS, len(self.labels))
        z = self.latent(counts(texts))
        out, place = np.zeros(len(z)), np.arange(n)
        for a in range(0, len(z), 512):
            sim = np.rint(z[a : a + 512] @ self.vectors.T * 10**DIGITS).astype(np.int64)
            # one number for cosine and place: the k nearest are the same in any order of work
            near = np.sort(np.argpartition(place - sim * n, k - 1, 1)[:, :k], 1)
            weight = np.maximum(np.take_along_axis(sim, near, 1) / 10**DIGITS, 0.0) ** POWER + 1e-9
            out[a : a + 512] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit(rows: pa.Table) -> Model:
    labels = rows.column("label").to_numpy().astype(np.float64)
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    w, at = np.empty((rows.num_rows, TERMS), np.float32), 0
    for block in blocks(iter(rows.combine_chunks().to_batches()), "text", 1 << 20):
        w[at : at + block.num_rows] = counts(block.column("text"))
        at += block.num_rows
    idf = (np.log((1 + len(w)) / (1 + np.count_nonzero(w, axis=0))) + 1).astype(np.float32)
    w *= idf
    w /= np.maximum(np.sqrt(np.einsum("ij,ij->i", w, w))[:, None], 1e-9)
    # truncated SVD by subspace iteration from a fixed start
    rank = min(DIMENSIONS, len(w))
    q = np.linalg.qr(w.T @ (w @ np.random.default_rng(11).normal(size=(w.shape[1], rank)).astype(np.float32)))[0]
    for _ in range(4):
        q = np.linalg.qr(w.T @ (w @ q))[0]
    q = q.astype(np.float64)
    z = np.concatenate([w[a : a + 512].astype(np.float64) @ q for a in range(0, len(w), 512)])
    return Model(idf, np.ascontiguousarray(q), z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9), labels)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in blocks(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sent.value.scores(block.column("text")))], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fitted(sample(docs, labels, "quality", ~held_out(3, 1), SAMPLE), fit)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier doesn't reject."""
    return filter_rows(docs, train(docs, labels), lambda s: s >= 0.5)


def filter_rows(docs: DataFrame, model, keep) -> DataFrame:
    """Rows, all columns, whose text's score under the model passes ``keep``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in blocks(batches, "text", 1 << 20):
            yield block.filter(pa.array(keep(sent.value.scores(block.column("text")))))

    return docs.mapInArrow(run, docs.schema)
