"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. One narrow pass gives each document its number of distinct word shingles, a 128-bit fingerprint
   of the set, ``BANDS`` band keys of ``ROWS`` minima each, and a signature of the low ``BITS`` bits of all
   minima packed into longs.  Documents with equal sets become one class; only its smallest doc_id
   goes on.
2. In each band bucket every class is paired with the bucket's centre, the class that shares buckets
   with the most others (copies of one text link with that text rather than with each other).  The
   packed signatures' bit counts estimate the similarity, corrected for chance collisions; pairs far
   below the threshold go no further, the others are confirmed on their full sets.  Confirmed links
   give a first set of components.
3. In buckets that still hold two or more components every class is open.  Two open classes of
   different components can only link if they share a shingle among the rarest ones of both (the
   prefix bound of set-similarity joins, with rarity counted among the open classes), at places that
   leave enough shingles behind them.  Such pairs go through the estimate and the confirmation as
   before.  So every pair that shares a bucket is in one component, was tested, or cannot reach the
   threshold; texts that share a template, but no rare shingle, are never paired at all.
4. Components are contracted by smallest neighbour until no link joins two.

With 32 bands of 4 rows a pair of similarity 0.8 shares no bucket with probability 5e-8, and the
estimate's margin is six standard deviations.  Keys that many rows share (a centre and other classes
with many pairs, a rare shingle of a large group) are dealt into blocks of about ``BLOCK``.
Left with many pairs: classes made only of shingles that many open classes of other components share.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z in lower case.  Shingles are
compared by 64-bit hashes.  A document with fewer words than a shingle has one shingle, its whole
sequence; a null text or one without words has an empty set and links with nothing.  Very long
texts are read whole.  Rows with null doc_id take no part in links: their component is null and
they are kept.  Repeated rows give repeated results; rows of one doc_id with different texts are
one document in links (it links where any of its texts does), each with its own n_shingles.  An
empty table gives an empty result.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajkit.llm.blocks import blocks, flat, key_list, segments
from trajkit.operators.graph import connected_components
from trajkit.session import sent_if_small, written

BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
LONGS = MINIMA * BITS // 64
BLOCK = 512
#: Cells of the table of shingle counts that is sent to all executors: 2 MB at any size of the input.
CELLS = 1 << 18
_FACTORS = np.random.default_rng(97).integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' distinct shingle hashes, sorted within each row, and the rows' offsets."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    data = _LOWER[data]
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets] = True
    solid = ~_BREAK[data]
    prev = np.zeros(len(data), bool)
    prev[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~prev | begin[:-1]))
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    # from one word's start to the next; what follows the word is cut from the distinct ones
    runs = segments(data[start[0] :], start - start[0])
    keys = key_list(runs)
    hashes = np.fromiter((xxhash.xxh64_intdigest(k.split(maxsplit=1)[0] if k[-1:].isspace() else k) for k in keys), np.uint64, len(keys))
    h = hashes[runs.indices.to_numpy()]
    bounds = np.searchsorted(start, offsets)
    count = np.diff(bounds)
    doc = np.repeat(np.arange(n), count)
    left = np.repeat(bounds[1:], count) - np.arange(len(h))  # words from here to the row's end
    place = np.arange(len(h)) - np.repeat(bounds[:-1], count)
    whole = count[doc] < width
    out = h.copy()
    for i in range(1, width):
        nxt = np.append(h[i:], np.zeros(min(i, len(h)), np.uint64))
        there = left > i
        out = np.where(there, _mixed(out * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(i)), out)
    keep = np.where(whole, place == 0, left >= width)
    out, doc = _mixed(out[keep]), doc[keep]
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.append(True, (out[1:] != out[:-1]) | (doc[1:] != doc[:-1]))
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(n + 1))


def features(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, fp1, fp2, sig array<long>, bands array<long>`` of every row."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 20):
            h, at = shingles(block.column("text"), width)
            n = block.num_rows
            size = np.diff(at)
            full = np.flatnonzero(size)
            first = at[:-1][full]
            minima = np.zeros((n, MINIMA), np.uint32)
            fp = np.zeros((n, 2), np.uint64)
            if len(full):
                for k in range(MINIMA):
                    minima[full, k] = np.minimum.reduceat((h * _FACTORS[k]) >> np.uint64(32), first)
                fp[full, 0], fp[full, 1] = np.add.reduceat(h, first), np.add.reduceat(_mixed(h + np.uint64(1)), first)
            rows = minima.reshape(n, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS))
            for r in range(ROWS):
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
            low = (minima & ((1 << BITS) - 1)).astype(np.uint64).reshape(n, LONGS, 64 // BITS)
            sig = (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(2, dtype=np.uint64)
            lists = lambda x, m: pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * m, m, dtype=np.int32)), pa.array(np.ascontiguousarray(x).view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(fp[:, 0].copy().view(np.int64)), pa.array(fp[:, 1].copy().view(np.int64)), lists(sig, LONGS), lists(key, BANDS)],
                ["doc_id", "n_shingles", "fp1", "fp2", "sig", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sig array<long>, bands array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for low bits that agree by chance."""
    ones = int("1" * (64 // BITS) if BITS == 1 else ("0" * (BITS - 1) + "1") * (64 // BITS), 2)
    differ = F.lit(0)
    for i in range(1, LONGS + 1):
        x = F.element_at(a, i).bitwiseXOR(F.element_at(b, i))
        s = 1
        while s < BITS:
            x = x.bitwiseOR(F.shiftrightunsigned(x, s))
            s *= 2
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(ones)))
    chance = 2.0**-BITS
    return (1 - differ / float(MINIMA) - chance) / (1 - chance)


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``doc_id, set array<long>`` of the documents of ``ids``, as a written table."""

    def run(batches):
        for block in blocks(batches, "text", 1 << 20):
            h, at = shingles(block.column("text"), width)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))], ["doc_id", "set"])

    few = docs.join(sent_if_small(ids), "doc_id", "left_semi")
    return written(few.mapInArrow(run, "doc_id long, set array<long>").dropDuplicates(["doc_id", "set"]), "neardup-sets")


def each_part(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def part_of(key: str, n: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col(n)).cast("int")


class Dealt:
    """Pairs (a, b) whose ends are dealt into parts, at most about ``BLOCK`` pairs each, to be joined with rows of doc_ids."""

    def __init__(self, pairs: DataFrame):
        ends = pairs.select("a").union(pairs.select("b")).groupBy(F.col("a").alias("doc_id")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
        self.ends = written(ends, "neardup-ends")
        self.hot = sent_if_small(written(self.ends.filter("n > 1"), "neardup-hot"))
        for x, y in ("ab", "ba"):
            pairs = pairs.join(self.hot.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}")), x, "left")
            pairs = pairs.withColumn(f"part_{x}", F.coalesce(part_of(y, f"n_{x}"), F.lit(0))).drop(f"n_{x}")
        self.pairs = pairs

    def join(self, rows: DataFrame, value: str) -> DataFrame:
        """The pairs with the value of both ends, from rows of doc_id and value."""
        held, out = rows.join(self.hot, "doc_id", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1))), self.pairs
        for x in "ba":
            out = out.join(held.select(F.col("doc_id").alias(x), F.col("part").alias(f"part_{x}"), F.col(value).alias(f"{value}_{x}")), [x, f"part_{x}"])
        return out


def likely(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose signatures' estimate is ``least`` or more, as a written table."""
    both = Dealt(written(pairs, "neardup-star")).join(sigs.select(F.col("rep").alias("doc_id"), "sig"), "sig")
    return written(both.filter(estimate(F.col("sig_a"), F.col("sig_b")) >= least).select("a", "b").distinct(), "neardup-pairs")


def confirmed(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of a written table whose full sets reach the threshold, as a written table."""
    dealt = Dealt(pairs)
    both = dealt.join(full_sets(docs, dealt.ends.select("doc_id"), width), "set")
    common = F.size(F.array_intersect("set_a", "set_b"))
    linked = 100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)
    return written(both.filter(linked).select("a", "b").distinct(), "neardup-links")


def met_by_band(rows: DataFrame, values: DataFrame, how: str = "inner") -> DataFrame:
    """Rows (``band, rep, n``; n: rows of the bucket) with the values of their buckets (``band, n``), one row a band; large buckets are dealt into parts."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rows.withColumn("parts", parts).withColumn("part", part_of("rep", "parts")).drop("parts")
    each = values.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    return dealt.join(each, ["band", "part"], how).drop("part")


def centred(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each row of ``band, rep, n`` with its bucket's centre."""
    weight = members.groupBy("rep").agg(F.sum("n").alias("w"))
    centre = members.join(weight, "rep").groupBy("band").agg(F.max(F.struct("w", (-F.col("rep")).alias("back"))).alias("c"), F.max("n").alias("n")).select("band", "n", (-F.col("c.back")).alias("centre"))
    both = met_by_band(members, centre).filter("rep <> centre")
    return both.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()


def rarity(sets: DataFrame) -> np.ndarray:
    """How often shingles occur in the sets, by the cell that a shingle's low bits name; any such table gives a valid order."""

    def run(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            own = batch.column("set").flatten().to_numpy(zero_copy_only=False)
            total += np.bincount(own & (CELLS - 1), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    found = sets.select("set").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``rep, comp, token, size, pos, indexed``: of each set (``rep, comp, set``) the rarest shingles that a link must share.

    A larger set must share one of its ``size - ceil(t size) + 1`` rarest with one of the smaller set's
    ``size - ceil(2 t / (1 + t) size) + 1`` rarest (``indexed``), t being the threshold, whatever the order.
    """
    sent = sets.sparkSession.sparkContext.broadcast(rarity(sets))

    def run(batches):
        for batch in batches:
            own = batch.column("set")
            off = own.offsets.to_numpy().astype(np.int64)
            values = own.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]]
            size = np.diff(off)
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((values, sent.value[values & (CELLS - 1)], row))
            pos = np.arange(len(values)) - np.repeat(off[:-1] - off[0], size)
            probe, index = size - -(-percent * size // 100) + 1, size - -(-2 * percent * size // (100 + percent)) + 1
            keep = pos < probe[row]
            at = row[keep]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(at)), batch.column("comp").take(pa.array(at)), pa.array(values[order][keep]), pa.array(size[at].astype(np.int32)), pa.array(pos[keep].astype(np.int32)), pa.array((pos < index[row])[keep])],
                ["rep", "comp", "token", "size", "pos", "indexed"],
            )

    return sets.mapInArrow(run, "rep long, comp long, token long, size int, pos int, indexed boolean")


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many minima's low bits the packed signatures differ, row by row."""
    x = a ^ b
    s = 1
    while s < BITS:
        x = x | (x >> np.uint64(s))
        s *= 2
    ones = np.uint64(int(("0" * (BITS - 1) + "1") * (64 // BITS), 2))
    return np.bitwise_count(x & ones).sum(1)


class Cells:
    """Rows in the order of their cells, in each cell first those that are found, by component, then those that ask."""

    def __init__(self, rows: pa.Table, percent: int, least: float):
        self.rows, self.percent = rows, percent
        self.most = math.floor(MINIMA * (1 - least - (1 - least) * 2.0**-BITS) + 1e-9)
        col = lambda n: rows.column(n).to_numpy()
        keys = np.stack([col("token"), col("px").astype(np.int64), col("py").astype(np.int64)])
        self.cell = np.cumsum(np.append(0, (keys[:, 1:] != keys[:, :-1]).any(0)))
        self.rep, self.comp, self.size, self.pos, self.asks = col("rep"), col("comp"), col("size").astype(np.int64), col("pos").astype(np.int64), col("asks")
        self.sig = rows.column("sig").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, LONGS)

    def pairs(self, at_once: int = 1 << 20) -> Iterator[np.ndarray]:
        """Pairs of rows of one cell, one that asks and one that is found, of different components, that may link."""
        y, x = np.flatnonzero(~self.asks), np.flatnonzero(self.asks)
        if not len(x) or not len(y):
            return
        names, code = np.unique(self.comp, return_inverse=True)
        key = self.cell * len(names) + code
        lo, hi = np.searchsorted(key[y], key[x], "left"), np.searchsorted(key[y], key[x], "right")
        first, last = np.searchsorted(self.cell[y], self.cell[x], "left"), np.searchsorted(self.cell[y], self.cell[x], "right")
        count = last - first - (hi - lo)
        ends = np.cumsum(count)
        a = 0
        while a < len(x):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] - count[a] + at_once, "right")))
            n = count[a:b]
            i = np.repeat(np.arange(a, b), n)
            j = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            j += np.where(j >= lo[i], hi[i] - lo[i], 0)  # passes over the row's own component
            p, q = x[i], y[j]
            sp, sq = self.size[p], self.size[q]
            ok = (sq < sp) | ((sq == sp) & (self.rep[q] < self.rep[p]))
            ok &= 100 * sq >= self.percent * sp
            ok &= (100 + self.percent) * np.minimum(sp - self.pos[p], sq - self.pos[q]) >= self.percent * (sp + sq)
            p, q = p[ok], q[ok]
            near = differing(self.sig[p], self.sig[q]) <= self.most
            found = np.stack([self.rep[p[near]], self.rep[q[near]]])
            yield np.unique(np.sort(found, 0), axis=1)
            a = b


def rare_pairs(sets: DataFrame, sigs: DataFrame, percent: int, least: float) -> DataFrame:
    """Pairs (a, b) of different components that may link by their rarest shingles and by their signatures.

    Rows meet in cells of a shingle; a shingle of more than ``BLOCK`` rows is dealt into cells of about
    ``BLOCK`` rows a side. Rows of one component don't meet, so a large group costs what others ask of it.
    """
    rows = written(prefixes(sets, percent), "neardup-prefixes")
    tokens = rows.groupBy("token").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    rows = written(rows.join(tokens.select("token", "n"), "token").join(sigs, "rep"), "neardup-shared")
    mine = ["rep", "comp", "size", "pos", "sig"]
    x = rows.select("token", part_of("rep", "n").alias("px"), each_part("n").alias("py"), F.lit(True).alias("asks"), *mine)
    y = rows.filter("indexed").select("token", each_part("n").alias("px"), part_of("rep", "n").alias("py"), F.lit(False).alias("asks"), *mine)
    cell = ["token", "px", "py"]

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            # the last cell may go on in the next batch
            ends = np.flatnonzero(np.logical_or.reduce([np.diff(rows.column(c).to_numpy()) != 0 for c in cell]))
            cut = int(ends[-1]) + 1 if len(ends) else 0
            held = rows.slice(cut)
            if cut:
                yield from out(rows.slice(0, cut))
        if held is not None and held.num_rows:
            yield from out(held)

    def out(rows: pa.Table):
        for found in Cells(rows.combine_chunks(), percent, least).pairs():
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    dealt = x.unionByName(y).repartition(*cell).sortWithinPartitions(*cell, "asks", "comp")
    return dealt.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links need ``percent`` of the union in common."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    feats = written(features(docs, width), "neardup-features")
    key = ["fp1", "fp2", "n_shingles"]
    classes = written(feats.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("rep")), "neardup-classes")
    reps = feats.withColumnRenamed("doc_id", "rep").join(classes, [*key, "rep"], "left_semi").dropDuplicates([*key, "rep"]).select("rep", "sig", "bands")
    reps = written(reps, "neardup-reps")
    least = percent / 100 - 6 * math.sqrt(percent / 100 * (1 - percent / 100) / MINIMA) - 2.0 ** (1 - BITS) / 10

    banded = reps.select("rep", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo <> hi").select("band", "n")
    members = written(banded.join(shared, "band"), "neardup-members")
    near = likely(centred(members), reps, least)
    links = confirmed(docs, near, width, percent)
    comps = connected_components(links, "a", "b")

    # classes of the buckets that the first links left in several components
    comp = F.coalesce("component", "rep").alias("comp")
    placed = written(members.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", "n", comp), "neardup-placed")
    split = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max("n").alias("n")).filter("lo <> hi").select("band", "n")
    waiting = written(met_by_band(placed, split, "left_semi").select("rep", "comp").distinct(), "neardup-open")
    if not waiting.isEmpty():
        sets = full_sets(docs, waiting.select(F.col("rep").alias("doc_id")), width).withColumnRenamed("doc_id", "rep")
        sets = written(sets.join(waiting, "rep").select("rep", "comp", "set"), "neardup-opensets")
        rest = rare_pairs(sets, reps.select("rep", "sig"), percent, least).join(near, ["a", "b"], "left_anti")
        more = confirmed(docs, written(rest, "neardup-rest"), width, percent)
        if not more.isEmpty():
            comps = connected_components(links.unionByName(more), "a", "b")
    comps = comps.withColumnRenamed("component", "comp")

    out = feats.select("doc_id", *key).join(classes, key, "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).select("*", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the smallest doc_id of each group only; of rows that repeat a doc_id all stay."""
    found = near_duplicates(docs, width, percent)
    gone = written(found.filter("NOT kept").select("doc_id").distinct(), "neardup-gone")
    return docs.join(sent_if_small(gone), "doc_id", "left_anti").select(*docs.columns)
