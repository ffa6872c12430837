"""Token ids in length-delimited binary record files with masked checksums and an offset index.

A record is: length of the payload (unsigned 64 bits), masked CRC-32 of those eight bytes
(unsigned 32 bits), payload, masked CRC-32 of the payload; all little-endian.  The payload is one
document's ids as unsigned 16-bit integers where the whole vocabulary fits, else 32-bit.  The mask
rotates a CRC right by 15 bits and adds ``MASK``, so checksums of data that holds checksums stay
sound.  Beside each ``.rec`` file an ``.idx`` file has, per record, doc_id (signed 64 bits), a flag
for a null doc_id, the record's place and its number of ids: any record can be read by itself.

Files follow each other by ascending doc_id (null first, equal ids by a hash of the text), as do the
records in them; an id that many rows share may span several files.  A task writes to a name of its own and only the names in the manifest count, so a task that
runs twice does no harm.  Null texts count as empty; such a document still has its end id.
Repeated rows are written as often as they occur; very long texts are written whole; an empty table
gives an empty manifest and no file.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks, encoder, flat
from trajkit.session import fresh_path, written

#: Fixed value of the masking rule.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("place", "<u8"), ("n", "<u4")])
MANIFEST = "file_no long, path string, width int, n_docs long, n_ids long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload))))


def read_record(stream) -> bytes | None:
    """The payload at the stream's place; None at its end; ValueError where a checksum disagrees."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("a record's head is cut off")
    length, crc = HEAD.unpack(head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length is damaged")
    body = stream.read(length + TAIL.size)
    if len(body) < length + TAIL.size or masked(body[:length]) != TAIL.unpack(body[length:])[0]:
        raise ValueError("a record's payload is damaged")
    return bytes(body[:length])


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents' ids below ``folder``; the manifest, one row a file, as a written table."""

    def run(batches):
        from pyspark import TaskContext

        store = where = out = None
        base, index, place, total, tool = "", [], 0, 0, encoder(tokenizer)
        width = 2 if tool.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        for block in blocks(batches, "text"):
            if out is None:
                store, where = _store(folder)
                store.create_dir(where, recursive=True)
                base = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                out = store.open_output_stream(f"{where}/{base}.rec")
            ids, at = tool.encode(*flat(block.column("text")))
            ids = ids.astype(f"<u{width}", copy=False)
            end = np.array([] if end_id is None else [end_id], ids.dtype).tobytes()
            raw, bounds, parts, places = ids.tobytes(), (at * width).tolist(), [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                parts.append(frame(raw[a:b] + end))
                places.append(place)
                place += len(parts[-1])
            out.write(b"".join(parts))
            rows = np.zeros(block.num_rows, INDEX)
            key = block.column("doc_id")
            rows["doc_id"], rows["null"] = key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False)
            rows["place"], rows["n"] = places, np.diff(at) + (end_id is not None)
            index.append(rows.tobytes())
            total += int(rows["n"].sum())
        if out is not None:
            out.close()
            with store.open_output_stream(f"{where}/{base}.idx") as f:
                f.write(b"".join(index))
            n = sum(map(len, index)) // INDEX.itemsize
            yield pa.RecordBatch.from_pydict({"file_no": [TaskContext.get().partitionId()], "path": [f"{folder}/{base}"], "width": pa.array([width], pa.int32()), "n_docs": [n], "n_ids": [total]})

    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # an id that very many rows share spreads over several files, by its texts and then by the rows themselves
    by = two.select("*", F.xxhash64("text").alias("of_text"), F.monotonically_increasing_id().alias("row"))
    ordered = by.repartitionByRange("doc_id", "of_text", "row").sortWithinPartitions("doc_id", "of_text", "row").drop("of_text", "row")
    return written(ordered.mapInArrow(run, MANIFEST), "records-manifest")


def read_index(path: str) -> np.ndarray:
    store, where = _store(f"{path}.idx")
    with store.open_input_stream(where) as f:
        return np.frombuffer(f.read(), INDEX)


def read_at(path: str, width: int, places: list[int]) -> Iterator[np.ndarray]:
    """The ids of single records, in any order, through their places in the index."""
    store, where = _store(f"{path}.rec")
    with store.open_input_file(where) as f:
        for place in places:
            f.seek(place)
            yield np.frombuffer(read_record(f), f"<u{width}")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every record of the files: doc_id, start (ids before it), n_tokens, ids_crc32, file_no, place."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                index = read_index(row["path"])
                store, where = _store(f"{row['path']}.rec")
                crcs = np.zeros(len(index), np.int64)
                with store.open_input_stream(where, buffer_size=4 << 20) as f:
                    for i in range(len(index)):
                        ids = np.frombuffer(read_record(f), f"<u{row['width']}")
                        if len(ids) != index["n"][i]:
                            raise ValueError("index and records disagree")
                        crcs[i] = zlib.crc32(ids.astype("<u4"))
                    if read_record(f) is not None:
                        raise ValueError("a record is missing from the index")
                n = index["n"].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["doc_id"], mask=index["null"].astype(bool)), pa.array(row["base"] + np.cumsum(n) - n), pa.array(n), pa.array(crcs), pa.array(np.full(len(index), row["file_no"])), pa.array(index["place"].astype(np.int64))],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "file_no", "place"],
                )

    files = manifest.count()
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")
    placed = manifest.select("*", before).repartition(max(1, files))
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file_no long, place long")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int | None = 1) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, fresh_path(spark, "records"), tokenizer, end_id))
