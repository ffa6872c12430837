"""Map extracts in the PBF format as a table of nodes, ways and relations."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENTS = "kind string, id long, lat double, lon double, tags map<string,string>, refs array<long>, members array<struct<kind:string,ref:long,role:string>>"
_TYPES = pa.schema(
    [
        ("kind", pa.string()),
        ("id", pa.int64()),
        ("lat", pa.float64()),
        ("lon", pa.float64()),
        ("tags", pa.map_(pa.string(), pa.string())),
        ("refs", pa.list_(pa.int64())),
        ("members", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.int64()), ("role", pa.string())]))),
    ]
)
_KINDS = ("node", "way", "relation")


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[i]
        i += 1
        n |= (x & 127) << shift
        if x < 128:
            return n, i
        shift += 7


def fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message: number and value, unread."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = b[i : i + n], i + n
        yield tag >> 3, value


def _packed(b: bytes) -> list[int]:
    out, i = [], 0
    while i < len(b):
        n, i = _varint(b, i)
        out.append(n)
    return out


def _signed(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def _running(b: bytes) -> list[int]:
    out, at = [], 0
    for n in _packed(b):
        at += _signed(n)
        out.append(at)
    return out


def _blobs(content: bytes) -> Iterator[bytes]:
    """The data blobs of a file, still packed."""
    i = 0
    while i < len(content):
        (n,) = struct.unpack(">I", content[i : i + 4])
        head = dict(fields(content[i + 4 : i + 4 + n]))
        i += 4 + n
        if head[1] == b"OSMData":
            yield content[i : i + head[3]]
        i += head[3]


def _elements(blob: bytes) -> Iterator[tuple]:
    parts = dict(fields(blob))
    block = zlib.decompress(parts[3]) if 3 in parts else parts[1]
    words: list[str] = []
    groups, scale, lat0, lon0 = [], 100, 0, 0
    for n, v in fields(block):
        if n == 1:
            words = [x.decode("utf-8", "replace") for _, x in fields(v)]
        elif n == 2:
            groups.append(v)
        elif n == 17:
            scale = v
        elif n in (19, 20):
            v = v - (1 << 64) if v >> 63 else v
            lat0, lon0 = (v, lon0) if n == 19 else (lat0, v)
    deg = lambda x, base: (base + scale * x) / 1e9
    tags = lambda f: [(words[k], words[v]) for k, v in zip(_packed(f.get(2, b"")), _packed(f.get(3, b"")), strict=True)]
    for group in groups:
        for n, v in fields(group):
            f = dict(fields(v))
            if n == 1:
                yield "node", _signed(f[1]), deg(_signed(f[8]), lat0), deg(_signed(f[9]), lon0), tags(f), None, None
            elif n == 2:
                pairs, at = _packed(f.get(10, b"")), 0
                for id_, lat, lon in zip(_running(f[1]), _running(f[8]), _running(f[9]), strict=True):
                    own = []
                    while at < len(pairs) and pairs[at]:
                        own.append((words[pairs[at]], words[pairs[at + 1]]))
                        at += 2
                    at += 1
                    yield "node", id_, deg(lat, lat0), deg(lon, lon0), own, None, None
            elif n == 3:
                yield "way", f[1], None, None, tags(f), _running(f.get(8, b"")), None
            elif n == 4:
                found = zip(_packed(f.get(10, b"")), _running(f.get(9, b"")), _packed(f.get(8, b"")), strict=True)
                yield "relation", f[1], None, None, tags(f), None, [{"kind": _KINDS[k], "ref": r, "role": words[w]} for k, r, w in found]


def elements(spark: SparkSession, path: str) -> DataFrame:
    """``kind, id, lat, lon, tags, refs, members`` of every element of the extracts at ``path``.

    A file is cut into its blobs in one pass (Spark reads files of up to 2 GB whole), the blobs are dealt
    out and decoded on all executors. Keys that repeat in an element keep their last value.
    """

    def cut(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                for blob in _blobs(content):
                    yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    def decode(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                rows = [(*r[:4], list(dict(r[4]).items()), *r[5:]) for r in _elements(blob)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], schema=_TYPES)

    blobs = spark.read.format("binaryFile").load(path).select("content").mapInArrow(cut, "blob binary")
    return blobs.repartition(spark.sparkContext.defaultParallelism * 4).mapInArrow(decode, ELEMENTS)


def restrictions(found: DataFrame) -> DataFrame:
    """``from_way, via, to_way`` of turn restrictions of the forbidding kind that name all three members."""
    one = lambda role, kind: F.expr(f"filter(members, m -> m.role = '{role}' AND m.kind = '{kind}')[0].ref")
    rows = found.filter("kind = 'relation' AND startswith(tags['restriction'], 'no_')")
    return rows.select(one("from", "way").alias("from_way"), one("via", "node").alias("via"), one("to", "way").alias("to_way")).dropna()


def tag_counts(found: DataFrame, key: str) -> DataFrame:
    """``kind, value, n`` of a tag over all elements."""
    return found.filter(F.col("tags")[key].isNotNull()).groupBy("kind", F.col("tags")[key].alias("value")).agg(F.count("*").alias("n"))


def members_in_order(found: DataFrame) -> DataFrame:
    """``relation, place, kind, ref, role`` of every relation's members, the first of each that repeats."""
    rows = found.filter("kind = 'relation'").select(F.col("id").alias("relation"), F.posexplode("members").alias("place", "m"))
    return rows.groupBy("relation", F.col("m.kind").alias("kind"), F.col("m.ref").alias("ref")).agg(F.min("place").alias("place"), F.min_by("m.role", "place").alias("role")).select("relation", "place", "kind", "ref", "role")
