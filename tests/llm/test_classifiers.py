"""Held-out accuracy, edge cases, and the pipeline as a whole."""

import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trajkit.llm import quality, queries, toxicity
from trajkit.llm.labelled import sample
from trajkit.session import table


def labelled(spark, n=900):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows, labels = [], []
    for i in range(n):
        junk, bad = rnd.random() < 0.3, rnd.random() < 0.3
        w = [word() + ("$$$" if junk else "") for _ in range(rnd.randint(5, 60))]
        if bad:
            w[rnd.randrange(len(w))] = "vilezz"
        rows.append((i, " ".join(w) + ".", "en"))
        labels.append((i, int(not junk), int(bad)))
    rows += [(n, "", "x"), (n + 1, None, "x"), (None, "abc", "x"), (n + 2, "word " * 30000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {a: (q, t) for a, q, t in labels}


def test_held_out_accuracy(spark):
    docs, labels, truth = labelled(spark)
    for k, module, mod, rest in ((0, quality, 3, 1), (1, toxicity, 5, 0)):
        rows = module.classify(docs, labels).collect()
        assert len(rows) == 904 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        held = [r for r in rows if r.held_out and r.doc_id in truth]
        assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % mod == rest}
        assert sum(r.predicted == truth[r.doc_id][k] for r in held) / len(held) > 0.95


def test_worst_sentence_is_found():
    rows = pa.table({"text": ["Good day here. You vilezz thing. Bye now.", "All is well. Fine."] * 20, "label": [1, 0] * 20})
    model = toxicity.fit(rows)
    s, z = model.sentences(rows.column("text").combine_chunks())
    assert [i for i in range(3) if z[i] == max(z[:3])] == [1] and model.scores(pa.array(["", "All is well."])).max() < 0.1


def test_votes_equal_a_plain_loop():
    """Nearest neighbours and their votes, one document at a time in doubles."""
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(("ab", "cde", "f!!", "GH", "12")) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    texts += texts[:40]  # ties
    labels = [i % 2 for i in range(len(texts))]
    model = quality.fit(pa.table({"text": texts, "label": labels}))
    asked = pa.array([*texts[:100], "", None])
    z = model.latent(quality.counts(asked))
    want = []
    for row in z:
        near = sorted((-round(float(row @ v) * 1e9), i) for i, v in enumerate(model.vectors))[: quality.NEIGHBOURS]
        weight = [max(-s / 1e9, 0.0) ** quality.POWER + 1e-9 for s, _ in near]
        want.append(sum(w * labels[i] for w, (_, i) in zip(weight, near, strict=True)) / sum(weight))
    got = model.scores(asked)
    assert max(abs(a - b) for a, b in zip(got, want, strict=True)) < 1e-9
    # the same scores in blocks of other sizes
    assert max(abs(float(model.scores(asked[i : i + 1])[0]) - got[i]) for i in range(0, 102, 7)) < 1e-9


def test_noisy_or_equals_a_plain_loop():
    model = toxicity.Model({"vile": 4.0, "vil-": 1.5, "nice": -3.0}, -5.0)
    texts = ["Vile day. Nice nice! vilest\nvile", "", None, "nothing here", "vile " * 2000, "a" * 9000 + "vile vil"]

    def plain(text):
        kept = 1.0
        for part in re.split(r"(?<=[.!?])(?=\s)|(?=\n)", text or ""):
            if part.strip():
                z = -5.0 + sum(model.weights.get(f, 0.0) for w in part.split() for f in toxicity.features_of(w.encode()))
                kept *= 1 / (1 + math.exp(min(z, 700.0)))
        return 1 - kept

    got = model.scores(pa.array(texts))
    assert max(abs(g - plain(t)) for g, t in zip(got, texts, strict=True)) < 1e-9


def test_training_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("7L AS doc_id", "concat('text ', id % 50) AS text").unionByName(spark.createDataFrame([(8, "b"), (9, "c")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 1), (9, 0)], "doc_id long, quality int")
    rows = sample(docs, labels, "quality", F.lit(True), {0: 10, 1: 10}).collect()
    assert sorted(tuple(r) for r in rows) == [(7, "text 0", 1), (8, "b", 0)]


def test_without_labels(spark):
    docs, labels, _ = labelled(spark, 30)
    none = labels.limit(0)
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    bad = labels.selectExpr("doc_id", "1 AS toxic")
    assert {r.score for r in toxicity.classify(docs, bad).collect()} == {1.0}
    assert quality.classify(docs.limit(0), labels).count() == 0 and toxicity.classify(docs.limit(0), labels).count() == 0


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    docs = table(spark, sf, "documents")
    columns, n = docs.columns, docs.count()
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns, name
        m = docs.count()
        assert 0 < m <= n
        n = m
    rows = p.run(spark, sf).collect()
    by_bin = {}
    for r in rows:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(x[1] for x in own) <= 2048 for own in by_bin.values())
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}


def test_pipeline_stages_on_odd_tables(spark, sf):
    """Empty tables, null and repeated rows, and columns whose names the operators use themselves."""
    import corpus_pipeline as p

    odd = [(i, f"good text number {i} about many quiet things. a@b{i}.com", "en", "s", 9, "x", "y", 1) for i in range(1, 6)]
    odd += [odd[0], (None, "no id at all, a@b.com", None, None, None, None, None, None), (7, None, "en", "s", None, "f", None, 0), (8, "", "en", "s", 0, None, "b", 2)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, found string, score string, shard int")
    kept = {"personal data": 9, "near duplicates": 9}
    for name, stage in p.STAGES:
        rows = stage(spark, docs, sf).collect()
        if name != "packing":
            assert stage(spark, docs, sf).columns == docs.columns
            assert len(rows) == kept.get(name, len(rows)) and {r.found for r in rows} <= {r[5] for r in odd}
        else:
            assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd)
        assert stage(spark, docs.limit(0), sf).count() == 0
    clean = {r.doc_id: r.text for r in p.redact_private(spark, docs, sf).collect()}
    assert clean[3] == "good text number 3 about many quiet things. [EMAIL]" and clean[7] is None and clean[8] == ""


COLUMNS = {
    "op1": "query_id rank vec_id score",
    "op2": "doc_id start n_tokens ids_crc32",
    "op3": "doc_id held_out score predicted",
    "op4": "doc_id held_out score predicted",
    "op5": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7": "doc_id n_shingles component_id kept",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    rows = df.collect()
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns) and rows
    if name in queries.ORACLE_SQL:
        import duckdb

        con = duckdb.connect()
        for t in ("embeddings", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
        found = con.execute(queries.ORACLE_SQL[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r[c] for c in columns)) for r in rows)
    elif "doc_id" in df.columns and "piece" not in df.columns:
        ids = [r.doc_id for r in table(spark, sf, "documents").select("doc_id").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
