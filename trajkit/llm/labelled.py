"""Bounded training samples and word arrays that the text classifiers share."""

from __future__ import annotations

import pickle
import subprocess
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import flat, key_list, safe_cuts, segments


def held_out(mod: int, rest: int):
    """Whether a row's labels may not be learnt from: crc32 of doc_id as text, by its remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: str, allowed, per_class: dict[int, int]) -> DataFrame:
    """``doc_id``, ``text`` and ``label`` of at most so many documents of each class, the first by a hash of doc_id.

    ``allowed`` is the condition on doc_id under which a label may be learnt from. A doc_id gives one
    row: of several texts the smallest counts, and an id with contradicting labels gives none.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(allowed & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter(F.col("label") == F.col("most")).drop("most")
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    parts = [known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in sorted(per_class.items())]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # chosen ids are bounded by per_class, and repeated rows of an id meet before they leave their task
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")


_CHILD = "import sys, pickle; sys.path[:0] = pickle.load(sys.stdin.buffer); from trajkit.llm.labelled import _answer; _answer()"
#: Seconds after which a fit is given up.
FIT_LIMIT = 3600


def _answer() -> None:
    """In a fresh interpreter: fit the function and table that stdin holds and write the pickled model to stdout."""
    fit, raw = pickle.load(sys.stdin.buffer)
    with pa.ipc.open_stream(raw) as stream:
        sys.stdout.buffer.write(pickle.dumps(fit(stream.read_all())))


def _apart(fit: Callable[[pa.Table], object], table: pa.Table) -> bytes:
    """The pickled result of a fresh interpreter: what fitting takes of memory goes with it, and the worker stays small."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    sent = pickle.dumps(sys.path) + pickle.dumps((fit, sink.getvalue().to_pybytes()))
    done = subprocess.run([sys.executable, "-c", _CHILD], input=sent, capture_output=True, timeout=FIT_LIMIT)
    if done.returncode:
        raise RuntimeError("fitting failed: " + done.stderr.decode("utf-8", "replace")[-2000:])
    return done.stdout


def fitted(rows: DataFrame, fit: Callable[[pa.Table], object]) -> object:
    """What ``fit`` makes of a bounded sample's ``text, label``, in order, in one task of an executor.

    The driver gets the model only; a lost executor means that the task runs again, to the same model.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).select(["text", "label"])
        return pa.table({"model": pa.array([_apart(fit, table)], pa.binary())})

    found = rows.groupBy().applyInArrow(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit(pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.int32())}))


class Words:
    """The words of a block of texts: distinct ones, each word's number and text."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = flat(texts)
        n = len(self.data)
        mask = np.zeros(n + 1, bool)
        mask[safe_cuts(self.data)] = True
        mask[self.offsets] = True
        mask[n] = False
        self.starts = np.flatnonzero(mask)
        if len(self.starts):
            found = segments(self.data, self.starts)
            self.codes, self.keys = found.indices.to_numpy().astype(np.int64), key_list(found)
        else:
            self.codes, self.keys = np.zeros(0, np.int64), []
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.bounds))
