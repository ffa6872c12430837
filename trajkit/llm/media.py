"""AVI files of motion-JPEG frames: write, parse, decode, and cut into timed shots.

A payload byte becomes one 8x8 block of constant grey, kept exactly by baseline JPEG: a block's DC
coefficient divided by a quantiser of 8 is its grey minus 128, and all other coefficients are 0.
The DC code table gives a difference of category c a code of 10 - c bits, so code and extra bits
are always 10 bits, and a block ends with the 2-bit end-of-block code: 12 bits a block, three
bytes for two blocks, of which none is ever 255.  Frames of such a stream have one size and are
encoded and decoded as arrays; other baseline grey frames go through the bit-by-bit decoder.

A file: RIFF 'AVI ' with the usual header lists, a 'plen' chunk with the payload's length, the
'movi' list of '00dc' chunks, and the 'idx1' index.  The last frame is filled up with zero bytes.

Shots: frames' 16-bin grey histograms; where the difference of two neighbours exceeds the mean of
the differences before it in the shot by ``FACTOR`` times (and ``FLOOR`` of the pixels), a new shot
begins.  Rows of clips: number, first frame, frames, start and end in seconds.

Null texts count as empty; empty texts have a payload of 64 zero bytes.  Null and repeated ids are
kept; other columns are left out, whatever their names; very long texts are stored whole, in as many
frames as they need.  Equal texts give equal files.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks, flat

WIDTH_BLOCKS = 8
MAX_ROWS = 128
FPS = 25
BINS, FACTOR, FLOOR = 16, 2.0, 0.10


def _codes() -> np.ndarray:
    """The 12 bits of a block by its difference + 255."""
    out = np.zeros(511, np.uint32)
    for d in range(-255, 256):
        c = abs(d).bit_length()
        # canonical code of category c (length 10 - c): a zero, 8 - c ones, a zero
        code = 0 if c == 8 else ((1 << (8 - c)) - 1) << 1
        extra = d if d >= 0 else d + (1 << c) - 1
        out[d + 255] = ((code << c) | extra) << 2
    return out


CODES = _codes()
DIFFS = np.full(4096, -999, np.int16)
DIFFS[CODES] = np.arange(-255, 256)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def frame_head(rows: int) -> bytes:
    """Everything of a frame before its coded data."""
    dqt = bytes([0]) + bytes([8]) + bytes([1]) * 63
    sof = struct.pack(">BHHBBBB", 8, rows * 8, WIDTH_BLOCKS * 8, 1, 1, 0x11, 0)
    dc = bytes([0x00]) + bytes([0, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0]) + bytes([8, 7, 6, 5, 4, 3, 2, 1, 0])
    ac = bytes([0x10]) + bytes([0, 1] + [0] * 14) + bytes([0])
    sos = bytes([1, 1, 0x00, 0, 63, 0])
    return b"\xff\xd8" + _segment(0xDB, dqt) + _segment(0xC0, sof) + _segment(0xC4, dc) + _segment(0xC4, ac) + _segment(0xDA, sos)


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def encode_avi(payload: bytes) -> bytes:
    """The file of a payload whose length is a positive multiple of 64."""
    if not payload or len(payload) % 64:
        raise ValueError("a payload's length is a positive multiple of 64")
    per = min(len(payload), WIDTH_BLOCKS * MAX_ROWS)
    rows, n = per // WIDTH_BLOCKS, -(-len(payload) // per)
    grey = np.zeros(n * per, np.int16)
    grey[: len(payload)] = np.frombuffer(payload, np.uint8)
    grey = grey.reshape(n, per) - 128
    diff = grey.copy()
    diff[:, 1:] -= grey[:, :-1]
    pair = CODES[diff + 255].reshape(n, per // 2, 2)
    bits = (pair[:, :, 0] << 12) | pair[:, :, 1]
    head = frame_head(rows)
    size = len(head) + per * 3 // 2 + 2
    even = size + size % 2
    movi = np.zeros((n, 8 + even), np.uint8)
    movi[:, :8] = np.frombuffer(b"00dc" + struct.pack("<I", size), np.uint8)
    movi[:, 8 : 8 + len(head)] = np.frombuffer(head, np.uint8)
    data = movi[:, 8 + len(head) : 8 + len(head) + per * 3 // 2].reshape(n, per // 2, 3)
    data[:, :, 0], data[:, :, 1], data[:, :, 2] = bits >> 16, bits >> 8 & 255, bits & 255
    movi[:, 8 + size - 2 : 8 + size] = (0xFF, 0xD9)
    index = np.zeros(n, np.dtype([("id", "S4"), ("flags", "<u4"), ("place", "<u4"), ("size", "<u4")]))
    index["id"], index["flags"], index["size"] = b"00dc", 16, size
    index["place"] = 4 + np.arange(n) * (8 + even)
    w, h = WIDTH_BLOCKS * 8, rows * 8
    avih = struct.pack("<14I", 1_000_000 // FPS, size * FPS, 0, 0x10, n, 0, 1, size, w, h, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, size, 0xFFFFFFFF, 0, 0, 0, w, h)
    strf = struct.pack("<IiiHH4sIiiII", 40, w, h, 1, 24, b"MJPG", w * h * 3, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    body = b"AVI " + hdrl + _chunk(b"plen", struct.pack("<Q", len(payload))) + _chunk(b"LIST", b"movi" + movi.tobytes()) + _chunk(b"idx1", index.tobytes())
    return _chunk(b"RIFF", body)


class Avi:
    """The parts of an AVI file: frame rate, payload length if told, and each frame's place and size."""

    def __init__(self, data: bytes):
        if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
            raise ValueError("not an AVI file")
        self.data, self.fps, self.payload = data, float(FPS), None
        self.width = self.height = 0
        movi, index = None, None
        stack = [(12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0]))]
        while stack:
            at, end = stack.pop()
            while at + 8 <= end:
                name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
                body = at + 8
                if body + size > end:
                    raise ValueError("a chunk is cut off")
                if name == b"LIST" and data[body : body + 4] == b"movi":
                    movi = (body, body + size)
                elif name == b"LIST":
                    stack.append((body + 4, body + size))
                elif name == b"avih":
                    if step := struct.unpack_from("<I", data, body)[0]:
                        self.fps = 1e6 / step
                    self.width, self.height = struct.unpack_from("<II", data, body + 32)
                elif name == b"idx1":
                    index = (body, size // 16)
                elif name == b"plen":
                    self.payload = struct.unpack_from("<Q", data, body)[0]
                at = body + size + size % 2
        if movi is None:
            raise ValueError("no movi list")
        self.frames: np.ndarray
        if index:
            rows = np.frombuffer(data, np.dtype([("id", "S4"), ("flags", "<u4"), ("place", "<u4"), ("size", "<u4")]), index[1], index[0])
            rows = rows[np.isin(rows["id"], (b"00dc", b"00db"))]
            # places count from the word 'movi', in some files from the file's start
            base = movi[0] if not len(rows) or data[movi[0] + int(rows["place"][0]) :][:4] == rows["id"][0] else 0
            self.frames = np.stack([rows["place"].astype(np.int64) + base + 8, rows["size"].astype(np.int64)], 1)
        else:
            found, at = [], movi[0] + 4
            while at + 8 <= movi[1]:
                size = struct.unpack_from("<I", data, at + 4)[0]
                if data[at : at + 4] in (b"00dc", b"00db"):
                    found.append((at + 8, size))
                at += 8 + size + size % 2
            self.frames = np.array(found, np.int64).reshape(-1, 2)

    def greys(self) -> np.ndarray:
        """Mean grey of every block, one row a frame."""
        if not len(self.frames):
            return np.zeros((0, 0), np.uint8)
        place, size = int(self.frames[0, 0]), int(self.frames[0, 1])
        head = self.data[place : place + size]
        rows = self.height // 8
        own = frame_head(rows)
        per = rows * WIDTH_BLOCKS
        steps = np.diff(self.frames[:, 0])
        if head.startswith(own) and size == len(own) + per * 3 // 2 + 2 and (self.frames[:, 1] == size).all() and (len(steps) == 0 or (steps == steps[0]).all() and steps[0] >= size):
            n, step = len(self.frames), int(steps[0]) if len(steps) else size
            raw = np.frombuffer(self.data, np.uint8, (n - 1) * step + size, place)
            shape = np.lib.stride_tricks.as_strided(raw, (n, size), (step, 1))
            if (shape[:, : len(own)] == np.frombuffer(own, np.uint8)).all():
                b = shape[:, len(own) : len(own) + per * 3 // 2].reshape(n, per // 2, 3).astype(np.uint16)
                diff = np.empty((n, per), np.int16)
                diff[:, 0::2] = DIFFS[(b[:, :, 0] << 4) | (b[:, :, 1] >> 4)]
                diff[:, 1::2] = DIFFS[((b[:, :, 1] & 15) << 8) | b[:, :, 2]]
                if (diff == -999).any():
                    raise ValueError("a frame is damaged")
                return (np.cumsum(diff, 1, dtype=np.int16) + 128).astype(np.uint8)
        return np.stack([decode_frame(self.data[p : p + s]) for p, s in self.frames.tolist()])


def decode_frame(data: bytes) -> np.ndarray:
    """Mean grey of each block of one baseline grey JPEG frame, bit by bit."""
    quant, tables, at = {}, {}, 2
    width = height = restart = 0
    scan = chosen = None
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    while scan is None:
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            i = 0
            while i < len(body):
                wide, key = body[i] >> 4, body[i] & 15
                quant[key] = struct.unpack_from(">64H" if wide else ">64B", body, i + 1)
                i += 129 if wide else 65
        elif marker == 0xC0:
            _, height, width, parts = struct.unpack_from(">BHHB", body)
            if parts != 1:
                raise ValueError("only grey frames are decoded")
            key = body[8]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("only baseline frames are decoded")
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                counts, code, k, table = body[i + 1 : i + 17], 0, i + 17, {}
                for length, count in enumerate(counts, 1):
                    for _ in range(count):
                        table[(length, code)] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                tables[body[i]] = table
                i = k
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            chosen, scan = body[2], at
    rows, cols = -(-height // 8), -(-width // 8)
    out, bit, last, level = np.zeros(rows * cols, np.uint8), 0, 0, 0
    raw = bytearray()
    marks = []
    i = scan
    while i < len(data):
        if data[i] == 0xFF:
            if data[i + 1] == 0:
                raw.append(0xFF)
                i += 2
                continue
            if 0xD0 <= data[i + 1] <= 0xD7:
                marks.append(len(raw) * 8)
                i += 2
                continue
            break
        raw.append(data[i])
        i += 1
    bits = np.unpackbits(np.frombuffer(bytes(raw), np.uint8)).tolist()

    def take(n: int) -> int:
        nonlocal bit
        v = 0
        for x in bits[bit : bit + n]:
            v = v << 1 | x
        bit += n
        return v

    def symbol(table: dict) -> int:
        nonlocal bit
        code = length = 0
        while length < 16:
            code, length, bit = code << 1 | bits[bit], length + 1, bit + 1
            if (length, code) in table:
                return table[length, code]
        raise ValueError("a code is unknown")

    def signed(n: int) -> int:
        v = take(n)
        return v if not n or v >> (n - 1) else v - (1 << n) + 1

    dc, ac = tables[chosen >> 4], tables[0x10 | chosen & 15]
    for block in range(rows * cols):
        if restart and block and block % restart == 0:
            last, bit = 0, marks[block // restart - 1]
        last += signed(symbol(dc))
        k = 1
        while k < 64:  # the other coefficients don't change a block's mean
            s = symbol(ac)
            if s == 0:
                break
            k += (s >> 4) + 1
            take(s & 15)
        level = last * quant[key][0] / 8 + 128
        out[block] = min(255, max(0, round(level)))
    return out


def read_payload(avi: Avi) -> bytes:
    data = avi.greys().tobytes()
    return data if avi.payload is None else data[: avi.payload]


def shots(greys: np.ndarray, fps: float) -> list[tuple[int, int, int, float, float]]:
    """Clip rows: number, first frame, frames, start and end in seconds."""
    n, per = greys.shape if greys.size else (0, 1)
    if not n:
        return []
    hist = np.bincount((np.arange(n)[:, None] * BINS + (greys >> 4)).ravel(), minlength=n * BINS).reshape(n, BINS)
    moved = np.abs(np.diff(hist, axis=0)).sum(1) / (2.0 * per)
    cuts, first, total = [0], 1, 0.0
    for i, d in enumerate(moved.tolist(), 1):
        seen = i - first
        if d > FLOOR and d > FACTOR * (total / seen if seen else FLOOR):
            cuts.append(i)
            first, total = i + 1, 0.0
        else:
            total += d
    ends = cuts[1:] + [n]
    return [(k, a, b - a, a / fps, b / fps) for k, (a, b) in enumerate(zip(cuts, ends, strict=True))]


def payload_of(text: bytes) -> bytes:
    return text + b"\0" * (-len(text) % 64 if text else 64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


MEDIA = "doc_id long, n_bytes long, media binary"


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the text's bytes and its file."""

    def run(batches):
        for block in blocks(batches, "text"):
            data, off = flat(block.column("text"))
            raw = data.tobytes()
            files = [encode_avi(payload_of(raw[a:b])) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(np.diff(off)), pa.array(files, pa.binary())], ["doc_id", "n_bytes", "media"])

    return _texts(docs, id_col, text_col).mapInArrow(run, MEDIA)


def clips(files: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row for each shot of each file; a null or damaged file gives one row with ``error``."""

    def run(batches):
        for batch in batches:
            out = []
            for key, data in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist(), strict=True):
                try:
                    avi = Avi(data or b"")
                    out += [{"doc_id": key, "clip": k, "first_frame": a, "n_frames": n, "start_s": s, "end_s": e, "error": None} for k, a, n, s, e in shots(avi.greys(), avi.fps)]
                except (ValueError, IndexError, KeyError, struct.error) as e:
                    out.append({"doc_id": key, "clip": None, "first_frame": None, "n_frames": None, "start_s": None, "end_s": None, "error": str(e) or type(e).__name__})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("doc_id", pa.int64()), ("clip", pa.int32()), ("first_frame", pa.int64()), ("n_frames", pa.int64()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("error", pa.string())]))

    return files.select(F.col(id_col).cast("long").alias("doc_id"), F.col(media_col).alias("media")).mapInArrow(run, "doc_id long, clip int, first_frame long, n_frames long, start_s double, end_s double, error string")


def read_back(files: DataFrame) -> DataFrame:
    """Digests of the payloads in the files of ``media``, of the files themselves, and the shots as a string."""
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for batch in batches:
            out = []
            for data in batch.column("media"):
                file = data.as_py()
                avi = Avi(file)
                greys = avi.greys()
                back = greys.tobytes()[: avi.payload]
                feature = ";".join(f"{s:.2f}-{e:.2f}" for _, _, _, s, e in shots(greys, avi.fps))
                out.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(list(x)) for x in zip(*out, strict=True))], ["doc_id", "n_bytes", *names])

    return files.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's file as a column, and what is read back from that column."""
    return read_back(media(docs, id_col, text_col))
