"""Operators on token ids against the tokenizers library, on texts chosen and random."""

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trajkit.llm import blocks, chunk_bpe, packing, records
from trajkit.session import fresh_path

BYTE, WORD = blocks.vocabulary("byte_bpe_50k.json"), blocks.vocabulary("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens string"
_PASSAGE = "the shared passage of many words that comes again and again, " * 40


def texts():
    rnd = random.Random(3)
    letters = list(" \t\n\r  　abcXYZ'sS12.,!é日🙂́\x85\x1c") + ["<|endoftext|>", "'ll", "  "]
    odd = ["", " ", None, "  a  b ", "a  b", "日本語 テスト　 全角", "a<|endoftext|>b <|endoftext|>", "it's we'll DON'T", "\n\n a\t\tb\r\n", "Σίσυφος ΣΑΣ", "᠎ x", "x" * 5000, "no-space" * 2000, "word " * 3000]
    odd += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    return odd + [_PASSAGE, "start " + _PASSAGE + "end", "other" + _PASSAGE]


def frame_of(spark, values):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(values)], SCHEMA)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_word_encoder_equals_library(path):
    tool, t = Tokenizer.from_file(path), [x or "" for x in texts()]
    ids, at = blocks.WordEncoder(path, max_words=50).encode(*blocks.flat(pa.array(t)))
    for i, x in enumerate(t):
        assert ids[at[i] : at[i + 1]].tolist() == tool.encode(x, add_special_tokens=False).ids, x


LENS = chunk_bpe.decoder(BYTE).len


def same_as_library(own, t):
    tool = Tokenizer.from_file(BYTE)
    ids, at = own.encode(*blocks.flat(pa.array(t)))
    for i, x in enumerate(t):
        assert ids[at[i] : at[i + 1]].tolist() == tool.encode(x, add_special_tokens=False).ids, x


@pytest.mark.parametrize("bits", [3, 6, 9])
def test_chunk_encoder_equals_library(bits):
    t = [x or "" for x in texts()]
    own = chunk_bpe.ChunkEncoder(blocks.WordEncoder(BYTE), LENS, bits=bits, max_chunks=100)
    for _ in range(2):
        same_as_library(own, t)
    assert own.reused > 0 and own.widened == 0


def test_joins_are_repaired_until_they_agree():
    """Chunks whose ids are wrong far from their ends: windows grow until they meet ids that agree."""
    own = chunk_bpe.ChunkEncoder(blocks.WordEncoder(BYTE), LENS, bits=9)
    fresh = own._fresh

    def spoilt(keys):
        out = []
        for k in keys:
            cut = min(len(k), 40)
            parts = [bytes([c]) for c in k[:cut]] + ([k[cut:-cut]] if len(k) > 2 * cut else []) + [bytes([c]) for c in k[max(cut, len(k) - cut) :]]
            out.append(np.concatenate([fresh([p])[0] for p in parts if p]))
        return np.concatenate(out), np.array([len(x) for x in out])

    own._fresh = spoilt
    rnd = random.Random(9)
    plain = [" ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(4000)) for _ in range(3)]
    ids, at = own.encode(*blocks.flat(pa.array(plain)))
    assert own.widened > 0
    tool = Tokenizer.from_file(BYTE)
    for i, x in enumerate(plain):
        # a text's own ends are no joins, so there the wrong ids stay
        got, want = ids[at[i] : at[i + 1]].tolist(), tool.encode(x, add_special_tokens=False).ids
        assert str(want[60:-60])[1:-1] in str(got)


def test_chunk_query_digests(spark):
    tool, t = Tokenizer.from_file(BYTE), texts()
    rows = {r.doc_id: r for r in chunk_bpe.digests(frame_of(spark, t), BYTE).collect()}
    for i, x in enumerate(t):
        ids = tool.encode(x or "", add_special_tokens=False).ids
        back = tool.decode(ids, skip_special_tokens=False)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_encode_decode_round_trip(spark):
    t = texts()
    back = {r.doc_id: r.text for r in chunk_bpe.decode(chunk_bpe.encode(frame_of(spark, t), BYTE), BYTE).collect()}
    assert back == {i: x or "" for i, x in enumerate(t)}


def test_empty_tables(spark):
    none = frame_of(spark, [])
    assert chunk_bpe.digests(none, BYTE).count() == 0
    assert records.write_and_read(none, WORD).count() == 0
    assert packing.pack_documents(none, BYTE).count() == 0


def test_records_hold_all_ids_in_order(spark):
    tool, t = Tokenizer.from_file(WORD), texts()
    docs = frame_of(spark, t).repartition(3)
    manifest = records.write(docs, fresh_path(spark, "t"), WORD, end_id=1)
    rows = sorted(records.read(spark, manifest).collect(), key=lambda r: r.doc_id)
    start = 0
    for i, x in enumerate(t):
        ids = [*tool.encode(x or "", add_special_tokens=False).ids, 1]
        assert (rows[i].doc_id, rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    part = manifest.orderBy("file_no").first()
    index = records.read_index(part.path)
    order = list(range(len(index)))[::-7]
    for i, ids in zip(order, records.read_at(part.path, part.width, [int(index["place"][i]) for i in order]), strict=True):
        assert ids.tolist() == [*tool.encode(t[int(index["doc_id"][i])] or "", add_special_tokens=False).ids, 1]


def test_records_null_and_repeated_ids(spark):
    docs = spark.createDataFrame([(None, "b"), (5, "a"), (5, "a"), (None, None)], "doc_id long, text string")
    rows = records.write_and_read(docs, WORD).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["5", "5", "None", "None"] and sorted(r.start for r in rows) in ([0, 1, 3, 5], [0, 2, 3, 5])


def test_damaged_record_is_told():
    good = records.frame(b"abcdef")
    assert records.read_record(io.BytesIO(good)) == b"abcdef" and records.read_record(io.BytesIO(b"")) is None
    for i in range(len(good)):
        bad = bytearray(good)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            records.read_record(io.BytesIO(bytes(bad)))
    with pytest.raises(ValueError):
        records.read_record(io.BytesIO(good[:-1]))


def check_packing(rows, lengths, capacity):
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_bin.setdefault(r.sequence_id, []).append(r)
    for doc, n in lengths.items():
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == n
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert all(r.length == capacity for r in own[1:]) and (n > capacity or len(own) == 1)
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: (r.offset, r.length)):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_bin)


def test_packing_is_gapless_and_tight(spark):
    tool, t = Tokenizer.from_file(BYTE), texts()
    ids = {i: [*tool.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(t)}
    rows = packing.pack_documents(frame_of(spark, t), BYTE, capacity=128).collect()
    bins = check_packing(rows, {i: len(x) for i, x in ids.items()}, 128)
    assert bins <= -(-sum(map(len, ids.values())) // 128) * 1.01 + 1
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())


def test_sum_of_squares_picks_least():
    rng = np.random.default_rng(2)
    items, cap = rng.integers(1, 20, 300), 20
    bins, offsets = packing.sum_of_squares(items, cap)
    gaps = {}
    for s, b, o in zip(items.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        def cost(choice, s=s):
            g = dict(gaps)
            g[choice] = g.get(choice, cap) - s
            n = np.bincount([x for x in g.values() if 0 < x < cap], minlength=cap + 1)
            return int((n**2).sum())
        costs = {c: cost(c) for c in [*(k for k, g in gaps.items() if g >= s), len(gaps)]}
        assert costs[b] == min(costs.values()) and o == cap - gaps.get(b, cap)
        gaps[b] = gaps.get(b, cap) - s
