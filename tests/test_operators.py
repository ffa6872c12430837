"""Operators on small hand-made tables."""

import random

import pytest

from trajkit import session
from trajkit.operators import graph


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 240)] + [(300, 299), (299, 301), (400, 400), (None, 7)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 240)]}, 299: 299, 300: 299, 301: 299, 400: 400}


def test_scratch_folder_must_be_shared_on_a_cluster(spark, tmp_path, monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster)
    monkeypatch.setattr(session, "run_dir", lambda _: f"file://{tmp_path}/run")
    df = session.written(spark.range(5), "x")
    assert df.count() == 5 and session.clean(spark) and not (tmp_path / "run").exists()


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    for n, m in ((30, 20), (200, 180), (200, 260)):
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]
        top = list(range(n))
        for _ in range(n):
            for a, b in edges:
                top[a] = top[b] = min(top[a], top[b])
        got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got == {x: top[x] for e in edges for x in e}
