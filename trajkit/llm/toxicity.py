"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is a logistic function of the weights of its words' features: the word itself
and its prefixes of 3 to 6 letters.  A document's score is the noisy-or of its sentences' scores,
1 - prod(1 - p).  Weights are trained on document labels alone by gradient steps through the
noisy-or.  Of all features only those seen in at least ``MIN_TEXTS`` toxic texts of the sample (and
a share ``MIN_SHARE`` of them) and clearly more often there than in clean ones (by ``LIFT`` and ``PROOF``) get a weight, so the model has at most ``FEATURES``.

Sentences end at . ! ? and line ends; a sentence without letters scores the bias alone.  Empty and
null texts have no sentence and score 0.  Only the text is an input.  With labels of one kind only,
or none, nothing can be told apart: every score is 1 where all labels are toxic, else 0.  Very long
texts are read whole; of sentences with equal scores the first is the worst.  Null ids score like
others and are never learnt from; repeated rows are scored as often as they occur, and an id is
learnt from once.  An empty table gives an empty result.  Columns of other names are left out by
``score`` and ``classify``, and kept as they are by ``quality.filter_rows``, whatever their names.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks
from trajkit.llm.labelled import Words, fitted, held_out, sample

#: Most labelled rows that the model is fitted on, by class.
SAMPLE = {0: 3000, 1: 2000}
FEATURES, MIN_TEXTS, MIN_SHARE, LIFT, PROOF = 5000, 3, 0.01, 15.0, 10.0
STEPS, RATE, DECAY = 400, 0.1, 1e-4
#: Bytes of text whose words are held at a time while fitting.
FIT_BYTES = 1 << 20
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_EDGES = string.whitespace + string.punctuation + string.digits


def features_of(word: bytes) -> list[str]:
    out, text = [], word.decode("utf-8", "replace").lower().strip(_EDGES)
    for part in (text,) if text.isalpha() else _NOT_LETTERS.split(text):
        if part:
            out += [part, *(f"{part[:n]}-" for n in range(3, min(7, len(part) + 1)))]
    return out


class Sentences:
    """Sentence numbers of a block's words."""

    def __init__(self, texts: pa.Array):
        w = self.words = Words(texts)
        ends = np.fromiter((k.rstrip(b"\"')]}*#$%&|").endswith((b".", b"!", b"?")) for k in w.keys), bool, len(w.keys))
        begins = np.fromiter((b"\n" in k[: len(k) - len(k.lstrip())] for k in w.keys), bool, len(w.keys))
        new = begins[w.codes]
        if len(new):
            new[1:] |= ends[w.codes[:-1]]
            new[1:] |= w.doc[1:] != w.doc[:-1]
            new[0] = True
        self.first = np.flatnonzero(new)
        self.of_word = np.cumsum(new) - 1
        self.doc = w.doc[self.first] if len(self.first) else np.zeros(0, np.int64)


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[bytes, float] = {}
        self.held = 0

    def __getstate__(self):
        return self.weights, self.bias

    def __setstate__(self, state):
        self.__init__(*state)

    def word_logits(self, keys: list[bytes]) -> np.ndarray:
        if len(self.known) > 150_000 or self.held > 32 << 20:
            self.known.clear()
            self.held = 0
        known, get = self.known, self.weights.get
        for k in keys:
            if k not in known:
                self.held += len(k)
                known[k] = sum(get(f, 0.0) for f in features_of(k))
        return np.fromiter(map(known.__getitem__, keys), np.float64, len(keys))

    def sentences(self, texts: pa.Array) -> tuple[Sentences, np.ndarray]:
        s = Sentences(texts)
        z = np.full(len(s.first), self.bias)
        if len(s.first):
            z += np.bincount(s.of_word, self.word_logits(s.words.keys)[s.words.codes], len(s.first))
        return s, z

    def scores(self, texts: pa.Array) -> np.ndarray:
        s, z = self.sentences(texts)
        return self.combined(s, z, len(texts))

    def combined(self, s: Sentences, z: np.ndarray, n: int) -> np.ndarray:
        """The noisy-or of the sentences of each of n texts."""
        if not self.weights:
            return np.full(n, float(self.bias > 0))
        return -np.expm1(-np.bincount(s.doc, np.logaddexp(0, z), n))


def _once(s: Sentences, own: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The features of the marked texts of a block, each once a text; ``own`` has the features of each word."""
    pair = np.unique(s.words.doc * max(len(own), 1) + s.words.codes)
    doc, code = pair // max(len(own), 1), pair % max(len(own), 1)
    doc, code = doc[rows[doc]], code[rows[doc]]
    if not len(code):
        return np.zeros(0, np.uint64)
    lens = np.fromiter(map(len, own), np.int64, len(own))
    off, joined, n = np.cumsum(lens) - lens, np.concatenate(own), lens[code]
    at = np.repeat(off[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    kinds, which = np.unique(joined[at], return_inverse=True)
    return kinds[np.unique(np.repeat(doc, n) * max(len(kinds), 1) + which) % max(len(kinds), 1)] if len(kinds) else kinds


def _parts(rows: pa.Table):
    """Sentences and labels of blocks of ``FIT_BYTES`` of text, so that fitting holds one block's words at a time."""
    for batch in rows.combine_chunks().to_batches():
        for block in blocks(iter([batch]), "text", FIT_BYTES):
            yield Sentences(block.column("text")), block.column("label").to_numpy().astype(bool)


def _hashes(key: bytes) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f) for f in features_of(key)], np.uint64)


def _chosen(rows: pa.Table, label: np.ndarray) -> list[str]:
    """The features that get a weight."""
    # what toxic texts hold, counted by hash so that only numbers are held
    values, bad = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for s, _ in _parts(rows.filter(pa.array(label))):
        seen = _once(s, [_hashes(k) for k in s.words.keys], np.ones(len(s.words.offsets) - 1, bool))
        both = np.concatenate([values, seen])
        count = np.concatenate([bad, np.ones(len(seen), np.int64)])
        values, which = np.unique(both, return_inverse=True)
        bad = np.bincount(which, count, len(values)).astype(np.int64)
    enough = bad >= max(MIN_TEXTS, MIN_SHARE * label.sum())
    frequent, bad = values[enough], bad[enough]
    # the same features in clean texts, and their names
    wanted, names = set(frequent.tolist()), {}
    good = np.zeros(len(frequent), np.int64)
    for s, y in _parts(rows):
        own = []
        for k in s.words.keys:
            found = [(h, f) for f in features_of(k) if (h := xxhash.xxh64_intdigest(f)) in wanted]
            names.update(found)
            own.append(np.array([h for h, _ in found], np.uint64))
        good += np.bincount(np.searchsorted(frequent, _once(s, own, ~y)), minlength=len(frequent))
    lift = (bad + 0.1) / label.sum() / ((good + 0.5) / (~label).sum())
    # half the likelihood ratio's statistic against a feature that is as frequent in both kinds
    share, total = label.mean(), np.maximum(bad + good, 1)
    proof = bad * np.log(np.maximum(bad / (total * share), 1e-9)) + good * np.log(np.maximum(good / (total * (1 - share)), 1e-9))
    chosen = np.flatnonzero((lift >= LIFT) & (proof >= PROOF))
    chosen = chosen[np.argsort(-(bad * np.log(np.maximum(lift, 1e-9)))[chosen], kind="stable")][:FEATURES]
    return [names[h] for h in frequent[chosen].tolist()]


def _occurrences(rows: pa.Table, chosen: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sentences with chosen features: each one's text, then pairs of sentence and feature; and each text's number of other sentences."""
    place = {f: i for i, f in enumerate(chosen)}
    docs, sentences, features, others = [], [], [], []
    n_doc = n_sentence = 0
    for s, y in _parts(rows):
        own = [[place[f] for f in features_of(k) if f in place] for k in s.words.keys]
        lens = np.fromiter(map(len, own), np.int64, len(own))
        off, joined = np.cumsum(lens) - lens, np.array([i for o in own for i in o], np.int64)
        at = np.flatnonzero(lens[s.words.codes]) if len(own) else np.zeros(0, np.int64)
        code = s.words.codes[at]
        n = lens[code]
        used, which = np.unique(s.of_word[at], return_inverse=True)
        sentences.append(np.repeat(which, n) + n_sentence)
        features.append(joined[np.repeat(off[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        docs.append(s.doc[used] + n_doc)
        others.append(np.bincount(s.doc, minlength=len(y)) - np.bincount(s.doc[used], minlength=len(y)))
        n_doc, n_sentence = n_doc + len(y), n_sentence + len(used)
    return np.concatenate(docs), np.concatenate(sentences), np.concatenate(features), np.concatenate(others)


def fit(rows: pa.Table) -> Model:
    label = rows.column("label").to_numpy().astype(bool)
    chosen = _chosen(rows, label) if label.any() and not label.all() else []
    if not chosen:
        return Model({}, 20.0 if len(label) and label.all() else -20.0)
    doc, sentence, feature, others = _occurrences(rows, chosen)
    count, y = len(doc), label
    weight = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    theta, bias = np.full(len(chosen), 0.5), -6.0
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, STEPS + 1):
        z = bias + np.bincount(sentence, theta[feature], count)
        p, alone = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        total = np.bincount(doc, np.logaddexp(0, z), len(y)) + others * np.logaddexp(0, bias)
        by_doc = np.where(y, -1 / np.maximum(np.expm1(np.minimum(total, 50.0)), 1e-6), 1.0) * weight
        dz = by_doc[doc] * p
        g = np.append(np.bincount(feature, dz[sentence], len(chosen)) + DECAY * theta, dz.sum() + (by_doc * others).sum() * alone)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta, bias = theta - step[:-1], min(bias - step[-1], -5.0)
    return Model({f: float(x) for f, x in zip(chosen, theta.tolist(), strict=True) if abs(x) > 1e-3}, float(bias))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and the place of the worst sentence (``worst_start``, ``worst_end`` in bytes)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in blocks(batches, "text"):
            s, z = sent.value.sentences(block.column("text"))
            n = block.num_rows
            start, end = np.full(n, -1), np.full(n, -1)
            if len(z):
                ends = np.append(s.words.starts[s.first[1:]], len(s.words.data))
                order = np.lexsort((np.arange(len(z)), -z, s.doc))
                top = order[np.append(True, np.diff(s.doc[order]) > 0)]
                start[s.doc[top]] = s.words.starts[s.first[top]] - s.words.offsets[s.doc[top]]
                end[s.doc[top]] = ends[top] - s.words.offsets[s.doc[top]]
            none = start < 0
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(sent.value.combined(s, z, n)), pa.array(start, pa.int64(), mask=none), pa.array(end, pa.int64(), mask=none)], ["doc_id", "score", "worst_start", "worst_end"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double, worst_start long, worst_end long")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fitted(sample(docs, labels, "toxic", ~held_out(5, 0), SAMPLE), fit)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score(docs, train(docs, labels))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "worst_start", "worst_end")
