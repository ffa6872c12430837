"""Sum-of-squares packing of tokenized documents into sequences of a fixed length.

A document longer than a sequence is cut so that all its pieces but the first are full.  Each piece
goes where the sum over all gaps of (open bins with that gap) squared becomes smallest; ties go to
the tightest bin.  Whether to open a bin is a choice of the same rule in the strict form; in the
other form (``reluctant``) the rule chooses among the open bins and a new one is opened only where
none of them fits.  ``fewest`` packs in several fixed orders and both forms and keeps the packing
with the fewest bins.  Longest first in the reluctant form is tried first and nearly always wins
(482 bins against 487 of the strict form where 481 is the least possible, 4936 against 4947 at the
least possible 4936): where few sequences matter more than the rule's letter, that is a departure
from the strict form.

Pieces are dealt by a hash into shards of about ``SHARD_PIECES``, and each shard packs its own,
longest first; what a shard wastes is a few bins out of thousands, so the total stays next to the
least possible at every size.  A shard's task holds lengths only; ids, if asked for, are joined to
the places afterwards.

Null texts count as empty: such a document has its end id alone.  Without an end id an empty
document gives one piece of length 0.  Very long texts are cut and packed whole.  Repeated rows and
repeated or null ids are packed as often as they occur; pieces of equal length are told apart by
doc_id and their place in the table.  An empty table gives an empty result.  Other columns are left
out, whatever their names.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks, encoder, flat
from trajkit.session import written

SHARD_PIECES = 65_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids; with ``keep_ids`` their ids too, as little-endian uint32."""

    def run(batches):
        tool = encoder(tokenizer, max_words=400_000)  # beside other stages' workers
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for block in blocks(batches, "text", 4 << 20):
            ids, at = tool.encode(*flat(block.column("text")))
            raw, bounds = ids.astype("<u4").tobytes(), (at * 4).tolist()
            doc, piece, start, length, crc, own = [], [], [], [], [], []
            for i in range(block.num_rows):
                data = raw[bounds[i] : bounds[i + 1]] + end
                n = len(data) // 4
                k = max(1, -(-n // capacity))
                first = n - (k - 1) * capacity
                for j in range(k):
                    a, b = (0, first) if j == 0 else (first + (j - 1) * capacity, first + j * capacity)
                    part = data[4 * a : 4 * b]
                    doc.append(i)
                    piece.append(j)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        own.append(part)
            columns = [block.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(own, pa.binary())] * keep_ids, [x.split()[0] for x in schema.split(", ")])

    schema = PIECES + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int, reluctant: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item, placed in the given order; ``reluctant``: a bin is opened only where no open one fits."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        # half the change of the sum, less 1, for the open bins of gaps s .. capacity - 1; an exact
        # fit, which leaves no gap behind, has 1/2 less and so wins every tie by coming first
        gain = count[0 : capacity - s] - count[s:capacity] if s else np.zeros(capacity, np.int64)
        gain = np.where(count[s:capacity] > 0, gain, far)
        at = int(gain.argmin()) if len(gain) else 0
        # a new bin changes half the sum by count[capacity - s] + 1/2
        if len(gain) and gain[at] < far and (reluctant or gain[at] + 1 <= count[capacity - s]):
            gap = s + at
            b = waiting[gap].pop()
            count[gap] -= 1
        else:
            gap, b, n = capacity, n, n + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap - s > 0:
            waiting[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets


def fewest(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Of several fixed orders of items that come longest first, the packing with the fewest bins.

    Orders: longest first, and the longer ones as dealt by a fixed shuffle with the shorter ones
    kept for the end.  The shuffle's seed is fixed, so a task that runs again packs the same.
    """
    best = None
    least = -(-int(lengths.sum()) // capacity)
    for shuffled, reluctant in ((0.0, True), (0.0, False), (0.9, False), (0.8, False), (0.9, True), (0.8, True)):
        k = int(len(lengths) * shuffled)
        order = np.concatenate([np.random.default_rng(7).permutation(k), np.arange(k, len(lengths))]).astype(np.int64)
        bins, offsets = sum_of_squares(lengths[order], capacity, reluctant)
        n = int(bins.max()) + 1 if len(bins) else 0
        if best is None or n < best[0]:
            back = np.argsort(order)
            best = n, bins[back], offsets[back]
        if n <= least:
            break
    return best[1:]


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """``parts`` (a written table with doc_id, piece, length and row, a number of its own) with sequence_id and offset."""
    shards = max(1, math.ceil(parts.count() / SHARD_PIECES))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["shard"]).sort_by([("length", "descending"), ("doc_id", "ascending"), ("row", "ascending")])
        bins, offsets = fewest(rows.column("length").to_numpy(), capacity)
        return rows.append_column("sequence_id", pa.array(bins + (key[0].as_py() << 40))).append_column("offset", pa.array(offsets))

    slim = parts.drop("ids")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema)
    dealt = slim.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    placed = dealt.groupBy("shard").applyInArrow(run, f"{schema}, sequence_id long, offset long")
    return placed.join(parts.select("row", "ids"), "row") if "ids" in parts.columns else placed


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, with ``ids`` if they are kept."""
    parts = pieces(docs, tokenizer, capacity, end_id, keep_ids=keep_ids).withColumn("row", F.monotonically_increasing_id())
    return pack(written(parts, "packing-pieces"), capacity).drop("row")
