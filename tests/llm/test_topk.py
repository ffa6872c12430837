import math
import random

import numpy as np
import pyarrow as pa
import pytest

from trajkit.llm import topk


def brute(vectors, queries, k):
    out = set()
    for qi, q in queries:
        scored = sorted((-int(np.dot(q, v)), i) for i, v in vectors if i != qi)
        out |= {(qi, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_equals_brute_force_with_ties_hot_vector_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, (rng.integers(-3, 4, 6) / 4).tolist()) for i in range(700)]
    good += [(i, [0.25] * 6) for i in range(700, 1200)] + [(1200, [0.0] * 6)]
    bad = [(2000, None), (2001, [0.1, None, 0.2, 0.1, 0.0, 0.0]), (2002, [float("nan")] * 6), (2100, [float("inf")] + [0.0] * 5), (2003, [1.0, 2.0]), (2004, []), (None, [0.5] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in good + bad], "vec_id long, embedding array<double>, score string, rank int").repartition(5)
    got = {tuple(r) for r in topk.search(df, df.filter("vec_id % 100 = 0"), k=10, n_pivots=8).collect()}
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in good]
    assert got == brute(ints, [x for x in ints if x[0] % 100 == 0], 10)


def test_lengths_are_searched_apart(spark):
    rng = np.random.default_rng(2)
    rows = [(i, np.round(rng.normal(size=2 + i % 3), 2).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = set().union(*(brute([x for x in ints if len(x[1]) == n], [x for x in ints if len(x[1]) == n and x[0] % 10 == 0], 4) for n in (2, 3, 4)))
    assert {tuple(r) for r in topk.search(df, df.filter("vec_id % 10 = 0"), k=4).collect()} == want


def test_large_components_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROUND_ROWS", 2)
    rows = [(0, [1.0, 1.0]), (1, [2.5e6, 1.0]), (2, [1.0, 2.0]), (3, [-2.5e6, 5.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    assert {tuple(r) for r in topk.search(df, df, k=3).collect()} == brute([(i, np.array(v, object)) for i, v in ints], [(i, np.array(v, object)) for i, v in ints], 3)


def test_fewer_rows_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.1, -0.2]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    low = 512 * sum(int(np.floor(1024 * float(np.float32(x)))) for x in (0.1, -0.2))
    assert {tuple(r) for r in topk.search(df, df.filter("vec_id = 0")).collect()} == {(0, 1, 2, 524288), (0, 2, 1, low)}
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0


def test_annuli_are_skipped():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1000, (20, 16))
    x = np.rint(np.repeat(centres, 300, 0) + rng.normal(0, 20, (6000, 16))).astype(np.int64)
    big = float((x.astype(float) ** 2).sum(1).max())
    lift = np.sqrt(big - (x.astype(float) ** 2).sum(1))
    d = topk.pivot_distances(x, lift, centres, np.sqrt(np.maximum(big - (centres**2).sum(1), 0)))
    near, rows = d.argmin(1), []
    for p in range(20):
        own = np.flatnonzero(near == p)
        own = own[d[own, p].argsort()]
        rows.append({"pivot": p, "n": len(own), "dist": d[own, p].tobytes(), "ids": own.astype(np.int64).tobytes(), "vectors": x[own].astype("<i4").tobytes()})
    held = np.arange(0, 6000, 7)
    taken = []
    for seed in (None, topk.Seed(held, x[held], 5)):
        count = [0, 0]
        best = topk.search_blocks(iter([pa.RecordBatch.from_pylist(rows)]), np.arange(30) * 200, x[::200], centres, big, 5, count, seed)
        for r, q in enumerate(x[::200]):
            s = x @ q
            s[r * 200] = np.iinfo(np.int64).min
            assert best.score[r].tolist() == sorted(s.tolist(), reverse=True)[:5]
        taken.append(count[0] / count[1])
    assert taken[1] <= taken[0] < 0.25, taken


def test_top_k_keeps_vectors_with_large_finite_components(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.uniform(-9, 9) for _ in range(3)]) for i in range(60)] + [(100, [3e6, 0.5, -1.0]), (101, [float(1 << 21), -2.0, 4.0]), (102, [-2.5e6, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    want = set()
    for q in (7, 100):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), i) for i, v in ints.items() if i != q)
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(best[:10], 1)}
    assert {tuple(r) for r in topk.search(df, df.filter("vec_id IN (7, 100)"), n_pivots=4).collect()} == want
    more = df.union(df.filter("vec_id = 100").selectExpr("vec_id + 100", "embedding"))
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.search(more, more.filter("vec_id = 100")).collect()
