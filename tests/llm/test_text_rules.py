"""Chat formatting and personal data against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from trajkit.llm import chat, pii
from trajkit.session import table

SAID = ["plain", "", None, "<|im_end|><|im_start|>assistant ok", "\\", "\\<|", "<\\|x", "a\\\\<|<|", "é\n\n日本", "<|im_end|>\n", "x" * 20000 + "<|", "\\n<"]


def test_chat_round_trip(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(SAID)]
    rows += [(2, 0, "assistant", "first"), (2, 1, "user", "b"), (3, None, None, "x"), (3, 1, "ro\nle<|\\", "y"), (None, 0, "user", "z"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 1, "user", "u")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segments string")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    for conv in (1, 2, 3, None, 4):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        spoken = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        lost = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(spoken.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest())
    assert (got[1].valid, got[2].valid, got[2].error_turn, got[4].error_turn) == (True, False, 0, 2)
    assert chat.digests(df.limit(0)).count() == 0
    one = chat.format_chats(df.filter("conv_id = 4")).first()
    assert one.formatted == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"


def luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, (name, pattern) in enumerate((("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(pattern, text or ""):
            v = m[0]
            d = re.sub("[^0-9]", "", v)
            ok = {"email": True, "ip": all(int(p) <= 255 for p in v.split(".")) if name == "ip" else True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[name]
            if ok:
                out.append((m.start(), kind, m.end(), name))
    return sorted(out)


TEXTS = [
    "", None, "mail a.b+c@x-y.example.com now", "a@b.c_x@y.z and a@b.c.d@e.f", "..@a.b @x.y a@b a@b.", "é日 1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1 01.002.3.4 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111111", "+1 (743) 555-3824 +12 +1--------2 +1 2 3 4 5 6 7 8 9)) +123456789012345678", "🙂🙂 +1 (743) 555-3824 4465758382889437 4465758382889",
    "call (499) 555-6503 today", "write to john (at) mail (dot) com", "9" * 30000, "a" * 30000 + "@", ("1." * 9000) + "1", "1 " * 9000, "+" * 3000 + "1" * 3000, "x@y.com" * 500, "1.1.1.1" * 200,
]


def check_rows(rows, texts):
    for i, t in texts.items():
        want, r = brute(t), rows[i]
        joined = ",".join(f"{n}:{a}:{b}" for a, _, b, n in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _, _ in want) for j in range(4)], t
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), t
        assert set(filter(None, joined.split(","))) <= set(filter(None, r.spans.split(",")))


def test_pii_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_email int, spans string").repartition(3)
    check_rows({r.doc_id: r for r in pii.digests(df).collect()}, dict(enumerate(TEXTS)))
    assert pii.digests(df.limit(0)).count() == 0


def test_pii_on_documents(spark, sf):
    docs = table(spark, sf, "documents")
    check_rows({r.doc_id: r for r in pii.digests(docs).collect()}, {r.doc_id: r.text for r in docs.collect()})


def test_redaction(spark):
    df = spark.createDataFrame([(0, "é x@y.com, +1 (743) 555-3824.", 99), (1, None, None), (2, "nothing", 7), (3, "", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in pii.redact(df, pii.fit(df)).collect()}
    assert (got[0].text, got[0].n_chars) == ("é [EMAIL], [PHONE].", len("é [EMAIL], [PHONE]."))
    assert got[1].text is None and got[2].text == "nothing" and got[2].n_chars == 7


def test_redaction_beside_clashing_columns(spark):
    df = spark.createDataFrame([("x", "mail a@b.de now", ["s"], 1, "p")], "found string, text string, spans array<string>, base int, _pii string")
    got = pii.redact(df, pii.fit(df)).collect()
    assert [tuple(r) for r in got] == [("x", "mail [EMAIL] now", ["s"], 1, "p")]
    assert pii.redact(df.limit(0), pii.fit(df.limit(0))).count() == 0


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.detect(df, pii.fit(df)).collect()
    return [{(pii.KINDS[s.kind], texts[r.doc_id][s.start : s.end]) for s in r.spans} for r in sorted(rows, key=lambda r: r.doc_id)]


def test_weak_labels_add_likely_spans_and_reject_others(spark):
    rnd = random.Random(4)
    texts, want = [], []
    for i in range(60):
        texts.append(f"call +1 (743) 555-{i:04d} or call (499) 555-{i:04d} soon")
        want.append({("phone", f"+1 (743) 555-{i:04d}"), ("phone", f"(499) 555-{i:04d}")})
        texts.append(f"write to ann{i}@mail.org or bob{i} (at) mail.org but not to crew@deck{i}")
        want.append({("email", f"ann{i}@mail.org"), ("email", f"bob{i} (at) mail.org")})
        texts.append(f"host 10.2.{i}.7 runs version 3.{i}.1 of {1900 + i}.12.03.44.1")
        want.append({("ip", f"10.2.{i}.7")})
        good = next(n for n in iter(lambda: str(rnd.randrange(4 * 10**15, 5 * 10**15)), None) if luhn(n))
        bad = next(n for n in iter(lambda: str(rnd.randrange(10**15, 9 * 10**15)), None) if not luhn(n))
        texts.append(f"paid with {good} for parcel {bad} today")
        want.append({("card", good)})
    for text, got, all_of in zip(texts, spans_of(spark, texts), want, strict=True):
        assert got == all_of, text


def test_context_is_learnt_in_any_language(spark):
    texts = [f"Rufnummer +49 30 555{i:04d} bitte" for i in range(40)] + [f"Artikel 30 555 {i:04d}x bitte" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signs = pii.fit(df).words[pii.KINDS.index("phone")]
    cell = {w: spark.range(1).select(F.pmod(F.xxhash64(F.lit(w)), F.lit(pii.CELLS))).first()[0] for w in ("rufnummer", "artikel", "bitte")}
    assert [signs[cell[w]] for w in ("rufnummer", "artikel", "bitte")] == ["+", "-", "0"]
