"""Exact tokenizer encoding of whole Arrow blocks through a bounded cache of words.

A text may be cut before an ASCII space that follows a character which is not white space: both
vocabularies used here end a pre-token there, look no further back, and start the rest afresh, so
the pieces' ids joined are the ids of the whole.  Each distinct piece of a block is encoded by the
tokenizers library once; the rest is array work.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 8 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0x80:] = True
_encoders: dict[str, WordEncoder] = {}


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string column, null as empty, and the rows' offsets (one more than rows)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        off = flat(batch.column(column))[1]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end
    release()


def release() -> None:
    """Give free memory back to the system, so that workers which wait don't hold it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Positions before which a text may be cut without changing its ids."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(_SPACE[data[1:]] & _SOLID[data[:-1]]) + 1
    p1 = data[at - 1]
    odd = np.flatnonzero(p1 >= 0x80)
    if len(odd):  # white space beyond ASCII ends in these bytes
        i = at[odd]
        a, b, c = data[i - 1], data[np.maximum(i - 2, 0)], data[np.maximum(i - 3, 0)]
        white = (b == 0xC2) & ((a == 0x85) | (a == 0xA0))
        white |= (c == 0xE1) & (((b == 0x9A) & (a == 0x80)) | ((b == 0xA0) & (a == 0x8E)))
        white |= (c == 0xE2) & (b == 0x80) & ((a <= 0x8B) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))
        white |= (c == 0xE2) & (b == 0x81) & (a == 0x9F)
        white |= (c == 0xE3) & (b == 0x80) & (a == 0x80)
        at = np.delete(at, odd[white])
    return at


def segments(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The stretches of ``data`` from each start to the next, dictionary-encoded."""
    off = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()


def key_list(parts: pa.DictionaryArray) -> list[bytes]:
    """The distinct stretches as bytes."""
    _, off, data = parts.dictionary.buffers()
    off = np.frombuffer(off, np.int32)[: len(parts.dictionary) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]


class SlotStore:
    """Id runs by key bytes; emptied when it has grown past its bounds."""

    def __init__(self, max_keys: int, max_bytes: int):
        self.max_keys, self.max_bytes = max_keys, max_bytes
        self.clear()

    def clear(self) -> None:
        self.slot: dict[bytes, int] = {}
        self.bytes = 0
        self.n_ids = 0
        self.ids = np.zeros(1 << 16, np.uint16)
        self.off = np.zeros(1 << 12, np.int64)
        self.len = np.zeros(1 << 12, np.int64)

    def trim(self) -> None:
        if len(self.slot) > self.max_keys or self.bytes > self.max_bytes:
            self.clear()

    def add(self, keys: list[bytes], fresh: np.ndarray, lens: np.ndarray) -> None:
        """``fresh`` holds the keys' runs joined, ``lens`` their lengths."""
        total, n = len(fresh), len(self.slot)
        if len(fresh) and fresh.max() > np.iinfo(self.ids.dtype).max:
            self.ids = self.ids.astype(np.uint32)
        while self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(keys) > len(self.off):
            self.off, self.len = (np.concatenate([x, np.zeros_like(x)]) for x in (self.off, self.len))
        self.ids[self.n_ids : self.n_ids + total] = fresh
        self.off[n : n + len(keys)] = self.n_ids + np.cumsum(lens) - lens
        self.len[n : n + len(keys)] = lens
        self.slot.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.n_ids += total
        self.bytes += sum(map(len, keys)) + total * self.ids.itemsize

    def expand(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of the slots joined, and the offset of each."""
        lens = self.len[slots]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.off[slots] - (ends - lens), lens) + np.arange(total)]
        return ids, np.append(ends - lens, total)


class WordEncoder:
    """``Tokenizer.encode(text, add_special_tokens=False).ids`` for many texts at once."""

    def __init__(self, path: str, max_words: int = 1_200_000, max_bytes: int = 96 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.store = SlotStore(max_words, max_bytes)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip or t.normalized)]
        self.mark = special[-1] if special else None

    def raw(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The keys' ids joined, and their numbers; one call a key."""
        runs = [e.ids for e in self.tokenizer.encode_batch_fast([k.decode("utf-8", "replace") for k in keys], add_special_tokens=False)]
        return np.array([i for r in runs for i in r], np.uint32), np.fromiter(map(len, runs), np.int64, len(runs))

    def learn(self, keys: list[bytes], store: SlotStore) -> None:
        """Encode the keys, each as a text of its own, into a store.

        A special token splits a text before all else, so keys with one between them are encoded as
        if each stood alone, in far fewer calls; keys that hold the token's string go one by one.
        """
        mark = self.mark.encode() if self.mark else b""
        odd = [k for k in keys if mark in k]
        if odd:
            store.add(odd, *self.raw(odd))
            keys = [k for k in keys if mark not in k]
        end = self.tokenizer.token_to_id(self.mark) if self.mark else None
        for i in range(0, len(keys), 20_000):
            part = keys[i : i + 20_000]
            texts = [mark.join([*part[j : j + 500], b""]).decode("utf-8", "replace") for j in range(0, len(part), 500)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = np.flatnonzero(ids == end)
            if len(ends) == len(part):
                store.add(part, ids[ids != end], np.diff(ends, prepend=-1) - 1)
            else:
                store.add(part, *self.raw(part))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows joined, and the rows' offsets into them."""
        self.store.trim()
        mask = np.zeros(len(data) + 1, bool)
        mask[safe_cuts(data)] = True
        mask[offsets] = True
        mask[len(data)] = False
        starts = np.flatnonzero(mask)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        words = segments(data, starts)
        keys = key_list(words)
        have = self.store.slot
        if new := [k for k in keys if k not in have]:
            self.learn(new, self.store)
        slots = np.fromiter(map(have.__getitem__, keys), np.int64, len(keys))[words.indices.to_numpy()]
        ids, at = self.store.expand(slots)
        return ids, at[np.searchsorted(starts, offsets)]


def encoder(path: str, max_words: int = 1_200_000) -> WordEncoder:
    """One encoder per file, size of its cache and Python worker; workers outlive tasks."""
    key = f"{path}:{max_words}"
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, max_words)
    return _encoders[key]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
