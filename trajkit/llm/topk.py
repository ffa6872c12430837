"""Exact top-k inner-product search through a pivot-distance index.

A vector x gets one more component, sqrt(M - |x|^2) with M the largest squared norm, a query gets
0 there; then the squared Euclidean distance is |q|^2 + M - 2<q, x>, and the largest inner products
are the nearest points.  Each point is keyed by its nearest pivot and its distance to it.  For a
query and a pivot the triangle inequality gives every point at pivot distance d a distance of at
least |d(q, p) - d|: pivots are taken from the nearest outwards, points from the annulus around
d(q, p) outwards, and a pivot is left when the next annulus is farther than the k-th best so far.
Every task starts from the k-th best among the rows that the pivots were fitted on, so more tasks
don't prune less.  The bounds only leave out points that are strictly worse (with a margin over
rounding), so ties are kept; scores are exact integers.  How much the bounds save depends on the
vectors: where all distances are alike (random directions in many dimensions) every product is taken.

Layout: rows are dealt by a hash of their id into shards, so a vector that a third of all rows
share is spread evenly; inside a shard rows are sorted by pivot and distance and packed into blocks
of binary columns, written once to the shared folder.  Pivots are fitted on at most ``SAMPLE``
rows (fewer where these would pass ``ROUND_BYTES``); every row is indexed.  Queries are read in rounds of about ``ROUND_ROWS`` and sent to all
executors, checked against ``ROUND_BYTES``; each index task returns at most k rows a query, and each
round's result is written before the next one begins.

Vectors that are null, empty, or hold null or non-finite components take no part.  Vectors of several
lengths are searched length by length: a query's candidates are the vectors of its own length, for no
other has a product with it (more than ``LENGTHS`` lengths are taken for an error).  Components are
packed in 32 bits, or in 64 where one needs it; a component or a score beyond 64 bits raises an error.
Rows with the query's own id are not its candidates; null ids take no part.  Query rows that agree in
id and vector are answered once; candidate rows count as often as they occur, and ties go to the
smaller id.  An empty table gives an empty result.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajkit.session import fresh_path, written

PIVOTS = 48
SAMPLE = 4096
BLOCK_ROWS = 4096
RING = 512
ROUND_ROWS = 50_000
ROUND_BYTES = 256 << 20
LENGTHS = 64
RESULT = "query_id long, rank int, vec_id long, score long"
INDEX = "shard int, pivot int, n int, near double, far double, dist binary, ids binary, vectors binary"


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """``vec_id`` and ``vec array<long>`` of the rows that take part."""
    ok = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    beyond = F.raise_error(F.lit("components go beyond 64 bits")).cast("long")
    vec = F.transform("v", lambda x: F.when(F.abs(x) * scale < float(1 << 63), F.floor(F.lit(scale) * x).cast("long")).otherwise(beyond))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & ok).select("vec_id", vec.alias("vec"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exact_product(a: np.ndarray, b: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Integer products of all rows of a with all of b; in doubles only where these are exact. Those of ``skip`` are no scores and may be anything."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most >= 2**63:
        full = np.where(skip, 0, a.astype(object) @ b.astype(object).T)
        if any(not -(2**63) < s < 2**63 for s in full.ravel()):
            raise OverflowError("scores go beyond 64 bits")
        return full.astype(np.int64)
    return a @ b.T


def fit_pivots(x: np.ndarray, n_pivots: int) -> np.ndarray:
    """Centres of a few rounds of k-means on the sample's vectors."""
    x = np.unique(x.astype(np.float64), axis=0)
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), min(n_pivots, len(x)), replace=False)]
    for _ in range(5):
        near = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        centres = np.stack([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
    return centres


def pivot_distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    both = np.concatenate([x.astype(np.float64), lift[:, None]], 1)
    p = np.concatenate([pivots, pivot_lift[:, None]], 1)
    return np.sqrt(np.maximum((both**2).sum(1)[:, None] + (p**2).sum(1) - 2 * both @ p.T, 0))


def build_index(vectors: DataFrame, dim: int, big: float, pivots: np.ndarray, wide: bool) -> DataFrame:
    """Blocks of the index, as a written table; components take 64 bits if ``wide``, else 32."""
    kind = "<i8" if wide else "<i4"
    pivot_lift = np.sqrt(np.maximum(big - (pivots**2).sum(1), 0))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vec"), dim)
            lift = np.sqrt(np.maximum(big - (x.astype(np.float64) ** 2).sum(1), 0))
            d = pivot_distances(x, lift, pivots, pivot_lift)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near]), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary())],
                ["vec_id", "pivot", "dist", "packed"],
            )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in INDEX.split(", ")]
        held: list[pa.RecordBatch] = []

        def out(rows: pa.Table) -> pa.RecordBatch:
            d = rows.column("dist").to_numpy()
            raw = b"".join(rows.column("packed").to_pylist())
            row = [rows.column("shard")[0].as_py(), rows.column("pivot")[0].as_py(), rows.num_rows, float(d[0]), float(d[-1]), d.tobytes(), rows.column("vec_id").to_numpy().tobytes(), raw]
            types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            key = t.column("shard").to_numpy().astype(np.int64) << 32 | t.column("pivot").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), t.num_rows]
            held.clear()
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                while b - a > BLOCK_ROWS or (a < b and (last or i < len(bounds) - 2)):
                    end = min(b, a + BLOCK_ROWS)
                    yield out(t.slice(a, end - a))
                    a = end
                if a < b:
                    held.extend(t.slice(a, b - a).to_batches())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(x.num_rows for x in held) >= 2 * BLOCK_ROWS:
                    yield from flush(False)
        yield from flush(True)

    shards = F.pmod(F.xxhash64("vec_id", "packed"), F.lit(1 << 20)).cast("int")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vectors.mapInArrow(keyed, "vec_id long, pivot int, dist double, packed binary").withColumn("shard", F.pmod(shards, F.lit(n)).cast("int"))
    ordered = dealt.repartition(n, "shard").sortWithinPartitions("shard", "pivot", "dist", "vec_id")
    return written(ordered.mapInArrow(packed, INDEX), "topk-index")


class Best:
    """The k best scores of each query so far, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def worst(self, rows: np.ndarray) -> np.ndarray:
        return self.score[rows, -1]

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        # only what may enter: at least the k-th best of the row (ties go on, the id decides)
        floor = self.score[rows, -1]
        if scores.shape[1] > k:
            floor = np.maximum(floor, np.partition(scores, -k, 1)[:, -k])
        r, c = np.nonzero(scores >= floor[:, None])
        if not len(r):
            return
        taken = scores[r, c] > np.iinfo(np.int64).min
        r, c = r[taken], c[taken]
        touched = np.unique(r)
        row = np.concatenate([np.repeat(touched, k), r])
        score = np.concatenate([self.score[rows[touched]].ravel(), scores[r, c]])
        own = np.concatenate([self.id[rows[touched]].ravel(), ids[c]])
        order = np.lexsort((own, -score.astype(np.float64), row)) if np.abs(score[score > np.iinfo(np.int64).min]).max(initial=0) < 2**53 else np.array(sorted(range(len(row)), key=lambda i: (row[i], -int(score[i]), own[i])))
        row, score, own = row[order], score[order], own[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
        keep = rank < k
        self.score[rows[row[keep]], rank[keep]] = score[keep]
        self.id[rows[row[keep]], rank[keep]] = own[keep]


class Seed:
    """Rows of the index that are known beforehand; each query's k-th best of them bounds what may enter."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k

    def bound(self, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """A score for each query that its k-th best reaches at least; the least possible where the rows are too few."""
        out = np.full(len(q), np.iinfo(np.int64).min)
        if len(self.ids) > self.k:
            for a in range(0, len(q), 2048):
                same = ids[a : a + 2048, None] == self.ids
                scores = exact_product(q[a : a + 2048], self.x, same)
                scores[same] = np.iinfo(np.int64).min
                out[a : a + 2048] = np.partition(scores, -self.k, 1)[:, -self.k]
        return out


def search_blocks(batches: Iterator[pa.RecordBatch], ids: np.ndarray, q: np.ndarray, pivots: np.ndarray, big: float, k: int, count: list[int] | None = None, seed: Seed | None = None) -> Best:
    """Best of all blocks of an index for the queries; ``count`` gets [products taken, products possible].

    A batch's pivots are visited by each query from the nearest outwards, and a pivot's rings likewise.
    """
    dim = q.shape[1]
    pivot_lift = np.sqrt(np.maximum(big - (pivots**2).sum(1), 0))
    q_sq = (q.astype(np.float64) ** 2).sum(1)
    to_pivot = pivot_distances(q, np.zeros(len(q)), pivots, pivot_lift)
    best, floor = Best(len(q), k), seed.bound(ids, q) if seed else np.full(len(q), np.iinfo(np.int64).min)
    margin = 1e-6 * (np.sqrt(big) + np.sqrt(q_sq.max(initial=0)) + 1)
    every = np.arange(len(q))

    def radius(rows: np.ndarray) -> np.ndarray:
        """Distance of the k-th best: what is farther can't enter."""
        worst = np.maximum(best.worst(rows), floor[rows]).astype(np.float64)
        return np.where(worst < -9e18, np.inf, np.sqrt(np.maximum(q_sq[rows] + big - 2 * worst, 0))) + margin

    def ring(x: np.ndarray, own: np.ndarray, rows: np.ndarray) -> None:
        if count is not None:
            count[0] += len(rows) * len(own)
        same = ids[rows][:, None] == own
        scores = exact_product(q[rows], x, same)
        scores[same] = np.iinfo(np.int64).min
        best.add(rows, scores, own)

    for batch in batches:
        blocks: dict[int, list[tuple]] = {}
        for pivot, n, dist, own, packed in zip(*(batch.column(c).to_pylist() for c in ("pivot", "n", "dist", "ids", "vectors")), strict=True):
            blocks.setdefault(pivot, []).append((np.frombuffer(dist), np.frombuffer(own, np.int64), np.frombuffer(packed, "<i8" if len(packed) == 8 * n * dim else "<i4").reshape(n, dim)))
            if count is not None:
                count[1] += len(q) * n
        if not blocks:
            continue
        # a pivot's rings: (inner, outer, block, from, to)
        rings = {p: [(d[a], d[min(a + RING, len(d)) - 1], i, a, min(a + RING, len(d))) for i, (d, _, _) in enumerate(own) for a in range(0, len(d), RING)] for p, own in blocks.items()}
        names = np.array(sorted(rings))
        lo, hi = (np.array([f(r[j] for r in rings[p]) for p in names.tolist()]) for f, j in ((min, 0), (max, 1)))
        mid = to_pivot[:, names]
        away = np.maximum(np.maximum(lo - mid, mid - hi), 0)
        visit = np.lexsort((mid, away), axis=1)
        for turn in range(len(names)):
            at_pivot = visit[:, turn]
            near = np.flatnonzero(away[every, at_pivot] <= radius(every))
            for p in np.unique(at_pivot[near]):
                rows, own = near[at_pivot[near] == p], rings[int(names[p])]
                inner, outer = np.array([r[0] for r in own]), np.array([r[1] for r in own])
                m = mid[rows, p][:, None]
                gap = np.maximum(np.maximum(inner - m, m - outer), 0)
                order = gap.argsort(1, kind="stable")
                for step in range(len(own)):
                    at = order[:, step]
                    live = gap[np.arange(len(rows)), at] <= radius(rows)
                    if not live.any():
                        break
                    for r in np.unique(at[live]):
                        _, _, i, a, b = own[r]
                        _, keys, x = blocks[int(names[p])][i]
                        ring(x[a:b].astype(np.int64), keys[a:b], rows[live & (at == r)])
    return best


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0, n_pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's k best rows of ``vectors``."""
    spark = vectors.sparkSession
    base = written(quantised(vectors, id_col, vec_col, scale), "topk-vectors")
    lengths = [r.d for r in base.groupBy(F.size("vec").alias("d")).count().orderBy("d").limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    asked = written(quantised(queries, id_col, vec_col, scale).dropDuplicates(["vec_id", "vec"]).select(F.col("vec_id").alias("query_id"), "vec"), "topk-queries")
    path = fresh_path(spark, "topk-found")
    spark.createDataFrame([], RESULT).write.parquet(path)
    for dim in lengths:
        _search_length(base.filter(F.size("vec") == dim), asked.filter(F.size("vec") == dim), dim, k, n_pivots, path)
    return spark.read.schema(RESULT).parquet(path)


def _search_length(base: DataFrame, asked: DataFrame, dim: int, k: int, n_pivots: int, path: str) -> None:
    """Append the answers to the queries of one length to the table at ``path``."""
    spark, n_asked = base.sparkSession, asked.count()
    if not n_asked:
        return
    norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    big, low, high = base.select(F.max(norm), F.min(F.array_min("vec")), F.max(F.array_max("vec"))).first()
    rows = base.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(min(SAMPLE, max(k + 1, ROUND_BYTES // (dim * 8)))).toArrow()
    sample = matrix(rows.column("vec").combine_chunks(), dim)
    pivots, seed = fit_pivots(sample, n_pivots), Seed(rows.column("vec_id").to_numpy(), sample, k)
    big = max(big, float((pivots**2).sum(1).max()))
    index = build_index(base, dim, big, pivots, low < -(1 << 31) or high >= 1 << 31)
    n_rounds = -(-n_asked // max(1, min(ROUND_ROWS, ROUND_BYTES // (dim * 24))))
    for r in range(n_rounds):
        part = asked.filter(F.pmod(F.xxhash64("query_id", "vec"), F.lit(n_rounds)) == r).toArrow()
        if part.nbytes > 2 * ROUND_BYTES:
            raise ValueError("a round of queries is over its bound")
        if not part.num_rows:
            continue
        sent = spark.sparkContext.broadcast((part.column("query_id").to_numpy(), matrix(part.column("vec").combine_chunks(), dim).astype(np.int64), seed))

        def run(batches, sent=sent):
            ids, q, seed = sent.value
            best = search_blocks(batches, ids, q, pivots, big, k, seed=seed)
            r, c = np.nonzero(best.score > np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_arrays([pa.array(ids[r]), pa.array(r.astype(np.int64)), pa.array(best.id[r, c]), pa.array(best.score[r, c])], ["query_id", "query_row", "vec_id", "score"])

        local = index.mapInArrow(run, "query_id long, query_row long, vec_id long, score long")
        own = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
        top = local.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        top.write.mode("append").parquet(path)
        sent.destroy()
