import hashlib
import zlib

import numpy as np
import pytest

from trajkit.llm import media


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1024, 1025, 3000])
def test_lossless_and_standard_decoder_agrees(n):
    payload = media.payload_of(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes())
    avi = media.Avi(media.encode_avi(payload))
    assert media.read_payload(avi) == payload
    frames = np.stack([media.decode_frame(avi.data[p : p + s]) for p, s in avi.frames.tolist()])
    assert (frames == avi.greys()).all()


def test_frames_without_index_and_damage():
    data = media.encode_avi(media.payload_of(b"abc" * 1000))
    at = data.index(b"idx1")
    cut = data[:4] + (at - 8).to_bytes(4, "little") + data[8:at]
    assert (media.Avi(cut).greys() == media.Avi(data).greys()).all()
    with pytest.raises(ValueError):
        media.Avi(b"RIFF")
    with pytest.raises(ValueError):
        media.Avi(data[:100])


def test_shots_follow_content():
    greys = np.concatenate([np.full((5, 64), 20), np.full((7, 64), 200), np.full((3, 64), 90)]).astype(np.uint8)
    assert [(a, n) for _, a, n, _, _ in media.shots(greys, 25.0)] == [(0, 5), (5, 7), (12, 3)]
    assert media.shots(np.zeros((0, 0), np.uint8), 25.0) == []


def test_query_rows(spark):
    texts = ["", None, "a", "é" * 40, "x" * 100_000, "x" * 100_000, "日本" * 3000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, feature string")
    rows = {r.doc_id: r for r in media.digests(df).collect()}
    for i, t in enumerate(texts):
        p = media.payload_of((t or "").encode())
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r.media_sha256 == hashlib.sha256(media.encode_avi(p)).hexdigest()
    assert rows[4][1:] == rows[5][1:]
    assert media.digests(df.limit(0)).count() == 0
    files = media.media(df)
    assert files.count() == len(texts) and media.clips(files).filter("error is not null").count() == 0
    broken = spark.createDataFrame([(1, None), (2, bytearray(b"nonsense"))], "doc_id long, media binary")
    assert media.clips(broken).filter("error is not null").count() == 2
