"""Personal data in texts by weak supervision; DataFrame functions only.

Base spans come from the strict patterns below and always stay.  Looser patterns propose further
spans: all other number-like and address-like runs (dotted numbers of three parts and more, long
IP forms, digit runs as long as a card's, digits in groups without a plus sign, addresses without a
dotted domain or spelled out).  Five labelers vote yes, no or nothing on every span: a check of its
digits or parts, a gazetteer of endings, prefixes and ranges, what touches it, its form, and the
word before it.  Which words speak for or against a kind is learnt, in any language: by counts of
base spans and proposals behind each word, a word being one of ``CELLS`` cells of a hash.

Per kind the votes' patterns are counted over all documents.  Expectation-maximisation over these
counts takes base spans for right and estimates, for right and for wrong spans apart, how often each
labeler says yes and no, and a probability for each pattern of votes; a logistic classifier of a
span's votes and form is trained on these probabilities.  A proposal is added where the classifier
gives it ``ADD`` or more and it meets no base span; of proposals that meet, the likelier one stays
(then the earlier one, then the kind listed first).

Places are code points from 0, the end exclusive.  Null texts count as empty and have no spans;
very long texts are read whole.  Null and repeated ids are kept.  Other columns are left out, but
``redact`` keeps them all, whatever their names.  An empty table gives an empty result.  Patterns
are written without nested backtracking, so long runs of digits or letters take linear time and no
stack.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajkit.session import written

KINDS = ("email", "ip", "card", "phone")
ADD = 0.9
ROUNDS = 40

_LOCAL = "A-Za-z0-9._%+-"
#: (kind, pattern, cheap necessary condition).  The guards at the front only spare starts that can't be the leftmost.
STRICT = (
    ("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){11}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
)
LOOSE = (
    ("email", r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{0,63}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z]{2,24}){1,4}", r"(?:\(at\)|\[at\])"),
    ("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++", "@"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", "(?:[0-9A-Fa-f]{1,4}:){7}"),
    ("ip", r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+", r"[0-9]\.[0-9]++\.[0-9]"),
    ("card", r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])", r"[0-9](?:[\x20./-]?[0-9]){11}"),
    ("phone", r"(?<![0-9+])\(?[0-9][0-9().\x20/-]{5,18}[0-9](?![0-9])", r"[0-9][0-9().\x20/-]{5}"),
)
#: Gazetteers: fixed values.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
LABELERS = ("check", "gazetteer", "edges", "form", "context")
BEFORE = 24
#: Cells of the words before spans; at most ``len(KINDS) * CELLS`` counts come to the driver.
CELLS = 4096
#: Fewest spans behind a word that let it vote, and the share of base spans that means yes (or its rest no).
HEARD, SURE = 3, 0.8


def _places(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of a pattern's matches, from the lengths between and in them."""
    gaps, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + F.length(x["gap"])
        e = s + F.length(x["hit"])
        return F.struct(e.alias("at"), F.array_append(a["out"], F.struct(s.alias("start"), e.alias("end"), x["hit"].alias("value"))).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("gap"), hits.alias("hit"))
    pairs = F.transform(pairs, lambda x: F.struct(x["gap"].alias("gap"), x["hit"].alias("hit")))
    return F.aggregate(pairs, start, step, lambda a: a["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _holds(kind: str, v: Column) -> Column:
    """What a strict match must also fulfil."""
    n = F.length(_digits(v))
    if kind == "ip":
        return v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(v))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _checked(kind: str, v: Column) -> Column:
    if kind == "email":
        return v.rlike(r"(?i)[.\]) ][a-z]{2,24}$")
    if kind == "ip":
        return v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$|:")
    if kind == "card":
        return F.when(F.length(_digits(v)).between(12, 19), luhn(_digits(v))).otherwise(False)
    return F.length(_digits(v)).between(9, 13) | v.startswith("(")


def _gazetteer(kind: str, v: Column) -> Column:
    if kind == "email":
        end = F.lower(F.regexp_extract(v, r"[.\]) ]([A-Za-z]+)$", 1))
        return F.when(end == "", -1).when(end.isin(*ENDINGS), 1).otherwise(0)
    if kind == "ip":
        return _vote(~v.rlike(r"^(?:0|255)\."))
    if kind == "card":
        return _vote(v.rlike("^[3-6]"))
    return _vote(_digits(v).rlike("^[01]{0,2}[2-9]") | v.startswith("+"))


def _formed(kind: str, v: Column) -> Column:
    if kind == "email":
        return v.rlike(r"(?i)(?:@|at[)\]])[^@]*(?:\.|dot)")
    if kind == "ip":
        return v.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$|:")
    if kind == "card":
        return v.rlike(r"^[0-9]{12,19}$|^[0-9]{4}(?:([\x20./-])[0-9]{4})(?:\1[0-9]{4}){1,2}$")
    return v.rlike(r"^\+|^\([0-9]{2,4}\)|^[0-9]{2,5}([\x20./-])[0-9]{2,4}(?:\1[0-9]{2,4})+$")


def _vote(yes: Column) -> Column:
    return F.when(yes, 1).otherwise(-1)


SPAN = "struct<start:int,end:int,kind:int,base:boolean,votes:array<int>,cell:int,size:int,digits:int>"


def _spans(text: Column, kind: str, pattern: str, need: str, strict: bool) -> Column:
    """Array of spans of one kind with votes, the cell of the word before (-1: none) and form."""

    def judged(s: Column) -> Column:
        v = s["value"]
        before = F.substring(text, F.greatest(s["start"] - BEFORE + 1, F.lit(1)), F.least(s["start"], F.lit(BEFORE)))
        word = F.lower(F.regexp_extract(before, r"([^\s:=#(]+)[\s:=#(]*$", 1))
        first, last = F.substring(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0)), F.substring(text, s["end"] + 1, F.lit(1))
        touched = first.rlike("[A-Za-z0-9_]") | last.rlike("[A-Za-z0-9_]")
        votes = [_vote(_checked(kind, v)), _gazetteer(kind, v), _vote(~touched), _vote(_formed(kind, v))]
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind"),
            F.lit(strict).alias("base"),
            F.array(*(x.cast("int") for x in votes)).alias("votes"),
            F.when(word == "", -1).otherwise(F.pmod(F.xxhash64(word), F.lit(CELLS))).cast("int").alias("cell"),
            F.least(F.length(v) / 8, F.lit(5)).cast("int").alias("size"),
            (F.length(_digits(v)) * 4 / F.length(v)).cast("int").alias("digits"),
        )

    kept = F.filter(_places(text, pattern), lambda s: _holds(kind, s["value"])) if strict else _places(text, pattern)
    has = text.contains(need) if need == "@" else text.rlike(need)
    return F.when(has, F.transform(kept, judged)).otherwise(F.array().cast(f"array<{SPAN}>"))


def _meet(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def annotate(text: Column) -> Column:
    """Struct of a text's ``base`` spans and of the proposals (``more``) that may meet them."""
    text = F.coalesce(text, F.lit(""))
    base = F.concat(*(_spans(text, *x, strict=True) for x in STRICT))
    more = F.concat(*(_spans(text, *x, strict=False) for x in LOOSE))
    return F.struct(base.alias("base"), more.alias("more"))


def _name(docs: DataFrame) -> str:
    """A column name that the table doesn't have."""
    name, taken = "_pii", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def candidates(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` and a column ``name``: all base spans and the proposals that meet none of them."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    found = docs.select(*keep, annotate(F.col(f"`{text_col}`")).alias(name))
    base, more = F.col(name)["base"], F.col(name)["more"]
    apart = F.filter(more, lambda p: ~F.exists(base, lambda b: _meet(b, p)))
    return found.select(*keep, F.concat(base, apart).alias(name))


FEATURES = (*(f"v{i}" for i in range(len(LABELERS))), "size", "digits")


class Model:
    """Per kind: the classifier's weights by feature and value, its bias, and the votes of the words' cells; plain numbers."""

    def __init__(self, weights: dict[int, dict[tuple[str, int], float]], bias: dict[int, float], words: dict[int, str], rates: dict[int, list[tuple[float, float]]]):
        self.weights, self.bias, self.words, self.rates = weights, bias, words, rates

    def context(self, s: Column) -> Column:
        return _context(self.words, s)

    def probability(self, s: Column) -> Column:
        out = F.lit(0.0)
        for k, w in self.weights.items():
            z = F.lit(self.bias[k])
            for name in FEATURES:
                place = int(name[1:]) if name[0] == "v" else None
                value = s[name] if place is None else self.context(s) if place == LABELERS.index("context") else F.element_at(s["votes"], place + 1)
                term = F.lit(0.0)
                for v, x in [(v, x) for (n, v), x in sorted(w.items()) if n == name]:
                    term = F.when(value == v, x).otherwise(term)
                z = z + term
            out = F.when(s["kind"] == k, 1 / (1 + F.exp(-z))).otherwise(out)
        return out


def _context(words: dict[int, str], s: Column) -> Column:
    """The vote of the word before a span: its cell's sign in the kind's string."""
    out = F.lit(0)
    for k, signs in words.items():
        sign = F.substring(F.lit(signs), s["cell"] + 1, F.lit(1))
        out = F.when((s["kind"] == k) & (s["cell"] >= 0), F.when(sign == "+", 1).when(sign == "-", -1).otherwise(0)).otherwise(out)
    return out


def _words(counted: list[tuple[int, int, int, int]]) -> dict[int, str]:
    """By kind a sign for each cell, from (kind, cell, base spans, all spans)."""
    signs = {k: ["0"] * CELLS for k in range(len(KINDS))}
    for kind, cell, base, n in counted:
        if n >= HEARD:
            signs[kind][cell] = "+" if base >= SURE * n else "-" if base <= (1 - SURE) * n else "0"
    return {k: "".join(x) for k, x in signs.items()}


def _em(rows: list[tuple[tuple[int, ...], bool, int]]) -> tuple[list[tuple[float, float]], dict[tuple[tuple[int, ...], bool], float]]:
    """How often each labeler says yes to right and to wrong spans, and the probability of each pattern of votes, from (votes, base, count)."""
    m = len(LABELERS)
    post = {(v, b): 1.0 if b else (1 + sum(x > 0 for x in v)) / (2 + sum(x != 0 for x in v)) for v, b, _ in rows}
    rates = [(0.8, 0.2)] * m
    for _ in range(ROUNDS):
        for i in range(m):
            heard = [(v[i] > 0, post[v, b], n) for v, b, n in rows if v[i]]
            # a few imagined votes keep a labeler that is never contradicted from certainty
            right, wrong = 2.0 + sum(n * p for _, p, n in heard), 2.0 + sum(n * (1 - p) for _, p, n in heard)
            rates[i] = (1.6 + sum(n * p for y, p, n in heard if y)) / right, (0.4 + sum(n * (1 - p) for y, p, n in heard if y)) / wrong
        loose = [(post[v, b], n) for v, b, n in rows if not b]
        prior = (1.0 + sum(n * p for p, n in loose)) / (2.0 + sum(n for _, n in loose))
        for v, b, _ in rows:
            if not b:
                z = math.log(prior / (1 - prior))
                for x, (yes, no) in zip(v, rates, strict=True):
                    z += math.log(yes / no) if x > 0 else math.log((1 - yes) / (1 - no)) if x < 0 else 0.0
                post[v, b] = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
    return rates, post


def _logistic(rows: list[tuple[dict[str, int], float, int]]) -> tuple[dict[tuple[str, int], float], float]:
    """Weights of a logistic classifier by gradient steps on soft labels and counts; right and wrong spans weigh alike."""
    w: dict[tuple[str, int], float] = {}
    bias = 0.0
    yes, no = sum(n * p for _, p, n in rows) or 1.0, sum(n * (1 - p) for _, p, n in rows) or 1.0
    for _ in range(400):
        grad: dict[tuple[str, int], float] = {}
        g0 = 0.0
        for x, p, n in rows:
            z = bias + sum(w.get(f, 0.0) for f in x.items())
            q = 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
            d = q * (1 - p) * n / no / 2 - (1 - q) * p * n / yes / 2
            g0 += d
            for f in x.items():
                grad[f] = grad.get(f, 0.0) + d
        bias -= 2 * g0
        for f, g in grad.items():
            w[f] = w.get(f, 0.0) - 2 * (g + 1e-4 * w.get(f, 0.0))
    return w, bias


def learn(spans: DataFrame) -> Model:
    """Learn from a written table of ``s``, one span a row; only counts by cells, and by patterns of votes and forms, come to the driver."""
    cells = spans.filter("s.cell >= 0").groupBy("s.kind", "s.cell").agg(F.sum(F.col("s.base").cast("long")).alias("base"), F.count("*").alias("n"))
    words = _words([tuple(r) for r in cells.collect()])
    votes = F.concat("s.votes", F.array(_context(words, F.col("s")))).alias("votes")
    counted = spans.groupBy("s.kind", "s.base", votes, "s.size", "s.digits").count().collect()
    weights, bias, rates = {}, {}, {}
    for kind in range(len(KINDS)):
        own = [r for r in counted if r["kind"] == kind]
        if not own:
            continue
        by_votes: dict[tuple[tuple[int, ...], bool], int] = {}
        for r in own:
            key = tuple(r["votes"]), r["base"]
            by_votes[key] = by_votes.get(key, 0) + r["count"]
        rates[kind], post = _em([(*k, n) for k, n in sorted(by_votes.items())])
        rows = [({f"v{i}": v for i, v in enumerate(r["votes"])} | {"size": r["size"], "digits": r["digits"]}, post[tuple(r["votes"]), r["base"]], r["count"]) for r in own]
        weights[kind], bias[kind] = _logistic(sorted(rows, key=str))
    return Model(weights, bias, words, rates)


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Learn from all documents; their spans are written once."""
    text = docs.select(F.col(f"`{text_col}`").alias("text"))
    return learn(written(candidates(text, "spans").select(F.explode("spans").alias("s")), "pii-spans"))


def _judged(spans: Column, model: Model) -> tuple[Column, Column]:
    """Base spans, and all spans, of an array of candidates: arrays of (start, kind, end) in order."""
    plain = lambda xs: F.array_sort(F.transform(xs, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    base = F.filter(spans, lambda s: s["base"])
    if not model.weights:
        return plain(base), plain(base)
    scored = F.transform(F.filter(spans, lambda s: ~s["base"]), lambda s: F.struct(model.probability(s).alias("p"), (-s["start"]).alias("back"), (-s["kind"]).alias("last"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    likely = F.filter(scored, lambda s: s["p"] >= ADD)
    rank = lambda s: F.struct(s["p"], s["back"], s["last"], s["end"])
    alone = F.filter(likely, lambda s: ~F.exists(likely, lambda r: _meet(r, s) & (rank(r) > rank(s))))
    return plain(base), F.array_sort(F.concat(plain(base), plain(alone)))


def detect(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of (start, kind, end) in order."""
    two = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    base, spans = _judged(F.col("found"), model)
    return candidates(two, "found").select("doc_id", base.alias("base"), spans.alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans; texts are searched once, and what is found is written."""
    two = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = written(candidates(two, "found").select("doc_id", "found"), "pii-found")
    base, spans = _judged(F.col("found"), learn(found.select(F.explode("found").alias("s"))))
    out = found.select("doc_id", base.alias("base"), spans.alias("spans"))

    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; overlapping spans become one."""
    name, text = _name(docs), F.col(f"`{text_col}`")
    spans = _judged(F.col(name), model)[1]
    d = candidates(docs, name, text_col).withColumn(name, spans)
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = F.array(F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["out"], fresh)).otherwise(a["out"]).alias("out"))

    clean = F.aggregate(F.col(name), start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    keep = [F.col(f"`{c}`") for c in docs.columns]
    d = d.select(*keep, F.when(text.isNotNull() & (F.size(name) > 0), clean).alias(name))  # null where the text stays
    out = []
    for f, c in zip(docs.schema, keep, strict=True):
        if f.name == text_col:
            c = F.coalesce(F.col(name), c).alias(f.name)
        elif f.name == "n_chars":
            c = F.coalesce(F.length(name).cast(f.dataType), c).alias(f.name)
        out.append(c)
    return d.select(*out)
