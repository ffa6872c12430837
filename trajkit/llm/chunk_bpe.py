"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last 32 bytes cuts texts into chunks that depend on content only, so a
passage that many documents share gives the same chunks wherever it stands.  Each distinct chunk is
encoded once, as if it were a text of its own, while it stays in a worker's bounded store; words of
new chunks come from a bounded store of words.

The ids at a chunk's ends are not those of the whole text, so each join of two chunks is repaired:
a window of the text around the join, out to safe cuts (``blocks.safe_cuts``) and a word more on
each side, is encoded in one piece by the tokenizer itself.  The ids of the words at both ends of
the window must be the very ids that the two chunks have there, at the same places; where they are
not, the window grows, twice as far each time, until they agree or it reaches the text's end.
Windows that meet become one.  The window's ids then take the place of the chunks' ids.

Reuse is by worker and not global on purpose: to gather equal chunks of all documents would
shuffle the whole text and all ids, which costs more than to encode a chunk once in each worker.

Null texts count as empty and have no ids; very long texts are encoded whole.  Null and repeated
``doc_id`` are kept as they are; all columns but the named two are left out, so clashing names do no
harm.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import SlotStore, WordEncoder, blocks, encoder, flat, key_list, safe_cuts, segments

WINDOW = 32
CHUNK_BITS = 9
_GEAR = np.random.default_rng(20240229).integers(0, 2**32, 256, dtype=np.uint32)


def chunk_starts(data: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Where the rolling hash of the last 32 bytes has ``bits`` zero bits on top."""
    h, k = _GEAR[data], 1
    while k < WINDOW:
        more = h[:-k] << np.uint32(k)
        h = h.copy()
        h[k:] += more
        k *= 2
    return np.flatnonzero(h < np.uint32(1 << (32 - bits))) + 1


def whole_characters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places, each moved on to the next beginning of a UTF-8 character."""
    for _ in range(3):
        inside = (at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
        at = at + inside
    return at


def marked(n: int, *places: np.ndarray) -> np.ndarray:
    """The places below n, each once, in order."""
    there = np.zeros(n, bool)
    for p in places:
        there[p[p < n]] = True
    return np.flatnonzero(there)


class ChunkEncoder:
    """Ids of whole texts; chunks seen before are not encoded again."""

    def __init__(self, words: WordEncoder, lens: np.ndarray, max_chunks: int = 100_000, max_bytes: int = 64 << 20, bits: int = CHUNK_BITS):
        self.words, self.lens, self.bits = words, lens, bits
        self.store, self.joins = SlotStore(max_chunks, max_bytes), SlotStore(max_chunks, max_bytes // 4)
        self.reused = self.encoded = self.widened = 0

    def _fresh(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, at = self.words.encode(np.frombuffer(b"".join(keys), np.uint8), np.append(0, np.cumsum([len(k) for k in keys])).astype(np.int64))
        return ids, np.diff(at)

    def _windows(self, raw: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the windows joined, each id's place in the text, and its window."""
        keys = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        if new := [k for k in dict.fromkeys(keys) if k not in self.joins.slot]:
            self.words.learn(new, self.joins)
        ids, at = self.joins.expand(np.fromiter(map(self.joins.slot.__getitem__, keys), np.int64, len(keys)))
        of = np.repeat(np.arange(len(keys)), np.diff(at))
        size = self.lens[ids]
        before = np.cumsum(size) - size
        return ids, begin[of] + before - before[at[:-1]][of], of

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if not n:
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        self.store.trim()
        self.joins.trim()
        docs = marked(n, offsets)
        starts = marked(n, offsets, whole_characters(data, chunk_starts(data, self.bits)))
        parts = segments(data, starts)
        keys, codes = key_list(parts), parts.indices.to_numpy()
        new = [k for k in keys if k not in self.store.slot]
        self.encoded += len(new)
        self.reused += len(codes) - len(new)
        if new:
            self.store.add(new, *self._fresh(new))
        ids, _ = self.store.expand(np.fromiter(map(self.store.slot.__getitem__, keys), np.int64, len(keys))[codes])
        place = np.cumsum(self.lens[ids]) - self.lens[ids]
        inner = starts[~np.isin(starts, docs, assume_unique=True)]
        if len(inner):
            ids, place = self._repaired(data, docs, inner, ids, place)
        return ids, np.searchsorted(place, offsets)

    def _repaired(self, data: np.ndarray, docs: np.ndarray, inner: np.ndarray, ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' ids and places with those around the joins at ``inner`` replaced."""
        n, raw = len(data), data.tobytes()
        cuts = marked(n + 1, docs, safe_cuts(data), np.array([n]))
        doc = np.searchsorted(docs, inner, "right") - 1
        at_doc = np.searchsorted(cuts, np.append(docs, n))
        first, last = at_doc[doc], at_doc[doc + 1]  # the text's ends, as numbers of cuts like all that follows
        lo, hi = np.searchsorted(cuts, inner, "left") - 1, np.searchsorted(cuts, inner, "right")
        left, right, step = np.maximum(lo - 1, first), np.minimum(hi + 1, last), 1
        while True:
            apart = np.flatnonzero(np.append(True, left[1:] >= np.maximum.accumulate(right)[:-1]))
            left, lo, first, last = left[apart], lo[apart], first[apart], last[apart]
            right, hi = (np.maximum.reduceat(x, apart) for x in (right, hi))
            begin, end = cuts[left], cuts[right]
            own, where, of = self._windows(raw, begin, end)
            base = np.minimum(np.searchsorted(place, where), len(place) - 1)
            same = (place[base] == where) & (ids[base] == own)
            a, b = cuts[lo], cuts[hi]
            count = lambda mask: np.bincount(of[mask], minlength=len(begin))
            wrong_left = (count(~same & (where < a[of])) > 0) | (count(where == a[of]) == 0)
            wrong_right = (count(~same & (where >= b[of])) > 0) | ((count(where == b[of]) == 0) & (b < end))
            wrong_left, wrong_right = wrong_left & (left > first), wrong_right & (right < last)
            if not (wrong_left | wrong_right).any():
                break
            self.widened += int((wrong_left | wrong_right).sum())
            left = np.where(wrong_left, np.maximum(left - step, first), left)
            right = np.where(wrong_right, np.minimum(right + step, last), right)
            # what did not agree is no margin any more
            lo, hi, step = np.where(wrong_left, np.maximum(lo - step, first), lo), np.where(wrong_right, np.minimum(hi + step, last), hi), 2 * step
        gone = np.zeros(len(ids) + 1, np.int64)
        np.add.at(gone, np.searchsorted(place, begin), 1)
        np.add.at(gone, np.searchsorted(place, end), -1)
        kept = np.cumsum(gone[:-1]) == 0
        ids, place = ids[kept], place[kept]
        at = np.searchsorted(place, where)
        wide = np.result_type(ids, own)
        return np.insert(ids.astype(wide, copy=False), at, own), np.insert(place, at, where)


_chunkers: dict[str, ChunkEncoder] = {}


def chunker(path: str) -> ChunkEncoder:
    if path not in _chunkers:
        _chunkers[path] = ChunkEncoder(encoder(path), decoder(path).len)
    return _chunkers[path]


class Decoder:
    """``Tokenizer.decode(ids, skip_special_tokens=False)`` of a byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
        byte = {c: b for b, c in _byte_chars().items()}
        self.table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.table[i] = bytes(byte[c] for c in token)
        self.len = np.fromiter(map(len, self.table), np.int64, len(self.table))
        self.off = np.cumsum(self.len) - self.len
        self.data = np.frombuffer(b"".join(self.table), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens' bytes joined, and where each token begins."""
        lens = self.len[ids]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.off[ids] - (ends - lens), lens) + np.arange(total)], np.append(ends - lens, total)


def _byte_chars() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_decoders: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _decoders:
        _decoders[path] = Decoder(path)
    return _decoders[path]


def encode_blocks(batches: Iterator[pa.RecordBatch], text_col: str, path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each block of rows with its ids joined and the rows' offsets."""
    for block in blocks(batches, text_col):
        yield block, *chunker(path).encode(*flat(block.column(text_col)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids array<int>`` of every row."""

    def run(batches):
        for block, ids, at in encode_blocks(batches, "text", path):
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])

    return _two(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` from what ``encode`` returned; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            rows = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            off = rows.offsets.to_numpy()
            data, at = decoder(path).bytes_of(rows.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]])
            at = at[off - off[0]]
            texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.mapInArrow(run, "doc_id long, text string")


def _two(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every row in one pass and return digests of both."""

    def run(batches):
        tool = decoder(path)
        decimal = [b"%d" % i for i in range(len(tool.table))]
        for block, ids, at in encode_blocks(batches, "text", path):
            data, where = tool.bytes_of(ids)
            where = where[at].tolist()
            out_ids, out_text, bounds = [], [], at.tolist()
            for i in range(block.num_rows):
                run_ids = ids[bounds[i] : bounds[i + 1]].tolist()
                out_ids.append(hashlib.sha256(b",".join(map(decimal.__getitem__, run_ids))).hexdigest())
                text = data[where[i] : where[i + 1]].tobytes().decode("utf-8", "replace")
                out_text.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(np.diff(at)), pa.array(out_ids), pa.array(out_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _two(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
