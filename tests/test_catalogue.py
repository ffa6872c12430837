"""Every query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from trajkit.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i] + 0.0 if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_equals_sql(spark, duck, sf, name):
    df = catalogue.QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = duck.execute(catalogue.ORACLE_SQL[name])
    assert got == rows_of([c[0] for c in found.description], found.fetchall())


def test_spatial_join_equals_brute_force_on_random_points(spark):
    import math
    import random

    from trajkit.operators.spatial import within

    rnd = random.Random(2)
    a = [(i, rnd.uniform(59, 60), rnd.uniform(9, 11)) for i in range(200)]
    b = [(i, rnd.uniform(59, 60), rnd.uniform(9, 11)) for i in range(200)]

    def dist(p, q):
        h = math.sin(math.radians(q[1] - p[1]) / 2) ** 2 + math.cos(math.radians(p[1])) * math.cos(math.radians(q[1])) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    frame = lambda rows: spark.createDataFrame(rows, "id long, lat double, lon double")
    got = {(r.left_id, r.right_id) for r in within(frame(a), frame(b), 5000.0).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if dist(p, q) <= 5000}


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())
