"""Near duplicates against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from trajkit.llm import neardup
from trajkit.session import table


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets[i] = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), top(i), top(i) == i) for i in ids}


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 5)))
    out = ["", None, " \t\n", "one", "ONE", "one two", "One\x0bTwo", "two one", "x\x1cy z", "é É", "é é"]
    for size in (8, 30, 120, 400):
        for _ in range(6):
            base = [word() for _ in range(size)]
            out.append(" ".join(base))
            for _ in range(rnd.choice((1, 3, 25))):
                w = base[:]
                for _ in range(rnd.randint(0, max(1, size // 12))):
                    w[rnd.randrange(size)] = word()
                out.append("  ".join(w).upper() if rnd.random() < 0.2 else " ".join(w))
    chain = [word() for _ in range(60)]
    for i in range(12):
        out.append(" ".join(chain))
        chain[i * 5 : i * 5 + 2] = [word(), word()]
    shared = " ".join(word() for _ in range(40))
    out += [shared + " " + " ".join(word() for _ in range(rnd.randint(8, 60))) for _ in range(60)]
    return list(enumerate(out))


@pytest.mark.parametrize("width", [1, 2, 5])
def test_equals_brute_force(spark, width):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, rep int, comp string").repartition(3)
    got = {tuple(r) for r in neardup.near_duplicates(df, width=width, percent=80).collect()}
    want = brute(rows, width, 80)
    assert got == want, sorted(got ^ want)[:10]


def test_equals_brute_force_on_documents(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {tuple(r) for r in neardup.near_duplicates(docs, width=2, percent=80).collect()} == brute(rows, 2, 80)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (3, "a b c"), (3, "a b c"), (9, None), (None, None)], "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in neardup.near_duplicates(df, width=2).collect())))
    assert got == sorted(map(str, [(None, 2, None, True), (4, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (9, 0, 9, True), (None, 0, None, True)]))
    assert neardup.near_duplicates(df.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in neardup.drop_near_duplicates(df, 2).collect()) == ["3", "3", "9", "None", "None"]


def templated(n, seed=3):
    """Texts that share a template of 60 words and have 12 words of their own: no two link."""
    rnd = random.Random(seed)
    return [(i, " ".join([f"t{j}" for j in range(60)] + [f"u{rnd.randrange(10**9)}" for _ in range(12)])) for i in range(n)]


def test_a_shared_template_gives_few_pairs(spark, monkeypatch):
    tested, own = [], neardup.confirmed
    monkeypatch.setattr(neardup, "confirmed", lambda docs, pairs, *a: (tested.append(pairs.count()), own(docs, pairs, *a))[1])
    for n in (500, 2000, 8000):
        tested.clear()
        df = spark.createDataFrame(templated(n), "doc_id long, text string")
        assert neardup.near_duplicates(df, width=2).filter("kept").count() == n
        # each bucket of the template pairs a class with the first of its group; nothing else is tested
        assert sum(tested) <= n * neardup.BANDS, (n, tested)


def test_template_with_links_and_a_large_group(spark):
    """Texts of one template, a few of which link, beside 300 copies that differ in a word each."""
    rnd = random.Random(8)
    rows = templated(250)
    for i in range(250, 290):
        w = rows[rnd.randrange(250)][1].split()
        w[rnd.randrange(60, 72)] = f"v{i}"
        rows.append((i, " ".join(w)))
    base = [f"g{j}" for j in range(100)]
    for i in range(290, 590):
        w = base[:]
        w[rnd.randrange(100)] = f"w{i}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {tuple(r) for r in neardup.near_duplicates(df, width=2).collect()}
    want = brute(rows, 2, 80)
    assert got == want, sorted(got ^ want)[:10]


def test_prefix_keeps_all_links(spark):
    """Every pair that reaches the threshold is among the pairs of rare shingles, whatever its signatures say."""
    rows = [(i, t) for i, t in corpus() if t]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = neardup.full_sets(docs, docs.select("doc_id"), 2).filter("size(set) > 0").selectExpr("doc_id AS rep", "doc_id AS comp", "set")
    sigs = neardup.features(docs, 2).selectExpr("doc_id AS rep", "sig")
    got = {tuple(r) for r in neardup.rare_pairs(sets, sigs, 80, -1.0).collect()}
    held = [(r.rep, set(r.set)) for r in sets.collect()]
    want = {(min(i, j), max(i, j)) for k, (i, x) in enumerate(held) for j, y in held[k + 1 :] if 100 * len(x & y) >= 80 * len(x | y)}
    assert want and want <= got


def test_one_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(5, a), (5, b), (2, a + " x"), (3, b + " y"), (9, "else where")], "doc_id long, text string")
    got = sorted(tuple(r) for r in neardup.near_duplicates(df, width=2).collect())
    assert got == [(2, 30, 2, True), (3, 40, 2, False), (5, 29, 2, False), (5, 39, 2, False), (9, 1, 9, True)]


def test_estimate_is_close(spark):
    df = spark.createDataFrame([(1, " ".join(map(str, range(500)))), (2, " ".join(map(str, range(50, 550))))], "doc_id long, text string")
    a, b = neardup.features(df, 1).orderBy("doc_id").collect()
    pair = spark.createDataFrame([(a.sig, b.sig)], "x array<long>, y array<long>")
    assert abs(pair.select(neardup.estimate(F.col("x"), F.col("y")).alias("e")).first().e - 450 / 550) < 0.15
