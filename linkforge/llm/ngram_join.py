"""Exact Jaccard join of word n-gram sets: universe partition, pigeonhole, one-deletion neighbourhoods."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, materialize, parts_for
from .components import components
from .hashing import Words, lowered, mix, pieces, runs

#: Sets that a task remembers so as not to index them again.
SEEN = 50_000
#: Documents of a block, and bytes of its fingerprints, at most.
BLOCK, BLOCK_BYTES = 2048, 1 << 18
#: Bytes of a document's fingerprint: a power of two about half its set's size, between these.
LEAST_PRINT, MOST_PRINT = 64, 1 << 13
#: A bucket is worth its cost if a member meets no more than so many of other components, on average.
HOT = 32
#: Rounds in which each set is compared with one bucket mate, and rounds of a level's verification, each
#: but the last of which takes one pair a set; what either joins needs no further comparison.
LEADS, ROUNDS = 1, 2
#: So few pairs are verified in one round. Pairs for a task that verifies, at least, and documents for one
#: that packs blocks: small tables are not worth many tasks.
FEW, TASK_PAIRS, TASK_DOCS = 10_000, 250, 256
SALT = np.uint64(0xC2B2AE3D27D4EB4F)


class Level(NamedTuple):
    """How the universe is cut: segments as a multiple of the units that a set needs, and whether
    one-deletion neighbourhoods are indexed."""

    share: float
    less: bool


#: Whole segments; larger ones with their one-deletion neighbourhoods; nearly single values.
LEVELS = (Level(1.2, False), Level(0.8, True), Level(24, False))


class Bands:
    """Size bands, each half as wide again as the one before; two sets that link meet in the band of
    the smaller."""

    def __init__(self, percent: int) -> None:
        if not 67 <= percent <= 100:
            raise ValueError("sets of a similarity under 67 % may lie more than a band apart")
        self.percent, low = percent, [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1] + 1, low[-1] * 3 // 2))
        self.low = np.array(low, np.int64)
        top = self.low[1:] - 1
        self.units = top * (100 - percent) // percent + 1

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1

    def segments(self, band: np.ndarray, level: Level) -> np.ndarray:
        return np.ceil(level.share * self.units[band]).astype(np.int64) + 2

    def meets_below(self, n: np.ndarray) -> np.ndarray:
        """Whether a set of n can link to a smaller one in the band below."""
        band = self.of(n)
        return (band > 0) & (100 * (self.low[band] - 1) >= self.percent * n)

    def need(self, n: np.ndarray, below: bool) -> np.ndarray:
        """One more than the greatest symmetric difference of a set of n and one that it links to in
        its own band, or in the band below."""
        if not below:
            return n * (100 - self.percent) // self.percent + 1
        return (n + self.low[self.of(n)] - 1) * (100 - self.percent) // (100 + self.percent) + 1


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, where each text's begin): the distinct k-word shingles of each text, sorted; a text
    of fewer words is one shingle, one without words has none."""
    words = Words(lowered(data), bounds)
    h, count = words.hashes(), np.diff(words.first)
    grams = runs(h, k)
    at = np.arange(len(grams))
    text = np.searchsorted(words.first, at, "right") - 1
    inside = at + k <= words.first[text + 1] if len(at) else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < k))
    whole = np.array([int(runs(h[words.first[i] : words.first[i + 1]], int(count[i]))[0]) for i in short], np.uint64)
    values, owner = np.r_[grams[inside], mix(whole + SALT) if len(whole) else whole], np.r_[text[inside], short]
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])] if len(values) else np.zeros(0, bool)
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(len(bounds)))


def index(values: np.ndarray, start: np.ndarray, bands: Bands, number: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, signature, info) of every document's segments at level ``number``, in its own band
    and, if it can link downwards, in the one below. Empty segments have no signature.

    A segment that holds values is worth a unit, as two sets can agree in it; where one-deletion
    neighbourhoods are indexed, a segment of two or more values is worth two, as they can also
    differ in one value there. Two sets that link differ in fewer values than either needs units (see
    Bands.need), so if the segments of either are worth as much, some segment that holds values agrees
    to within its worth: the sets share a signature. info packs what a set can spare beyond its need
    (spare, from bit 5), whether the need isn't met (bit 4), the units lost without the signature (two
    bits), whether it is a deletion (bit 1), and the band (bit 0: the one below)."""
    level, n = LEVELS[number], np.diff(start)
    for below in (False, True):
        # Sets that only an equal one can link to needn't be indexed.
        some = np.flatnonzero((n > 0) & (bands.need(n, below) > 1) & (bands.meets_below(n) | (not below)))
        if not len(some):
            continue
        mine = np.zeros(len(n), bool)
        mine[some] = True
        v, band, need = values[np.repeat(mine, n)], bands.of(n[some]) - below, bands.need(n[some], below)
        m = bands.segments(band, level)
        base, doc = np.r_[0, np.cumsum(m)], np.repeat(np.arange(len(some)), m)
        cell = np.repeat(base[:-1], n[some]) + (mix(v ^ mix(SALT + np.uint64(number))) % np.repeat(m, n[some]).astype(np.uint64)).astype(np.int64)
        mixed, sums = mix(v + SALT), np.zeros(base[-1], np.uint64)
        np.add.at(sums, cell, mixed)
        count = np.bincount(cell, minlength=base[-1])
        name = mix((np.arange(base[-1]) - base[doc] + (band[doc] << 34)).astype(np.uint64) + (np.uint64(number) << np.uint64(60)))
        worth = np.minimum(count, 2 if level.less else 1)
        spare = np.add.reduceat(worth, base[:-1]) - need
        info = (np.maximum(spare, 0) << 5) + below
        kept = np.flatnonzero(count)
        yield some[doc[kept]], mix(sums[kept] ^ name[kept]), info[doc[kept]] + (worth[kept] << 2)
        if level.less:
            t = np.flatnonzero(count[cell] >= 2)
            yield some[doc[cell[t]]], mix((sums[cell[t]] - mixed[t]) ^ name[cell[t]]), info[doc[cell[t]]] + (1 << 2) + 2
        poor = np.flatnonzero(spare < 0)
        if len(poor):
            yield some[poor], mix(values[start[some[poor]]] ^ name[base[poor]]), np.full(len(poor), 16 + below)


def identities(values: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for each set, the same for equal sets."""
    total = lambda x: np.diff(np.r_[np.zeros(1, np.uint64), np.cumsum(x)][start]).view(np.int64)
    return total(mix(values)), total(mix(values ^ SALT))


def measurer(k: int):
    """A row a document: the size of its set, and the set's identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                values, start = shingle_sets(data, bounds, k)
                yield pa.RecordBatch.from_arrays([*rows.columns[:2], pa.array(np.diff(start), pa.int64()), *map(pa.array, identities(values, start))], ["doc_id", "th", "n", "h1", "h2"])

    return run


def indexer(k: int, percent: int, number: int):
    """(h1, h2, sig, info): what index() gives for each text; a set that the task has seen before is
    left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in batches:
            for _, data, bounds in pieces(batch, "text"):
                values, start = shingle_sets(data, bounds, k)
                h1, h2 = identities(values, start)
                new = np.zeros(len(h1), bool)
                for i, x in enumerate(zip(h1.tolist(), h2.tolist(), strict=True)):
                    if x not in seen:
                        seen.add(x)
                        new[i] = True
                if len(seen) > SEEN:
                    seen = set()
                values, size = values[np.repeat(new, np.diff(start))], np.diff(start)[new]
                h1, h2 = h1[new], h2[new]
                for doc, sig, info in index(values, np.r_[0, np.cumsum(size)], bands, number):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h1[doc], h2[doc], sig.view(np.int64), info.astype(np.int64))], ["h1", "h2", "sig", "info"])

    return run


def spare() -> Column:
    return F.shiftright("info", 5)


def is_poor() -> Column:
    return F.col("info").bitwiseAND(16) != 0


def units() -> Column:
    return F.shiftright("info", 2).bitwiseAND(3)


def is_less() -> Column:
    return F.col("info").bitwiseAND(2) != 0


def below() -> Column:
    return F.col("info").bitwiseAND(1)


def unique(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """sets (h1, h2, ...) with sid, a number of their own: h1, unless another set has that too."""
    sets, turn = scratch(sets.withColumn("sid", F.col("h1")), "sets"), 0
    while not (twice := sets.groupBy("sid").agg(F.count("*").alias("c"), F.min(F.struct("h1", "h2")).alias("first_")).where("c > 1")).isEmpty():
        turn += 1
        marked = sets.join(twice.select(F.col("sid").alias("s_"), "first_"), F.col("sid") == F.col("s_"), "left")
        again = F.col("first_").isNotNull() & (F.struct("h1", "h2") != F.col("first_"))
        sets = scratch(marked.select(*[c for c in sets.columns if c != "sid"], F.when(again, F.xxhash64("h1", "h2", F.lit(turn))).otherwise(F.col("sid")).alias("sid")), "sets")
    return sets


def linked(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def verifier(k: int, percent: int):
    """Compare the word sequences themselves."""

    def shingles(text: str) -> set:
        words = text.encode().lower().split()
        return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)} if words else set()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, set] = {}
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hits = []
            for i, (x, y) in enumerate(zip(a, b, strict=True)):
                if x not in kept:
                    if len(kept) > 8:
                        kept = {}
                    kept[x] = shingles(batch.column(2)[i].as_py())
                hits.append(linked(kept[x], shingles(batch.column(3)[i].as_py()), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.bool_())], ["a", "b", "hit"])

    return run


def fingerprint(values: np.ndarray) -> np.ndarray:
    """A byte for each segment of a set: the exclusive or of its values' hashed bytes. Two sets that
    differ in d values differ in at most d bytes, also after both are folded to fewer."""
    size = LEAST_PRINT
    while size < MOST_PRINT and size * 2 < len(values):
        size *= 2
    out = np.zeros(size, np.uint8)
    np.bitwise_xor.at(out, (mix(values ^ SALT) & np.uint64(size - 1)).astype(np.int64), (mix(values + SALT) >> np.uint64(56)).astype(np.uint8))
    return out


def folded(prints: np.ndarray, size: int) -> np.ndarray:
    while prints.shape[-1] > size:
        half = prints.shape[-1] // 2
        prints = prints[..., :half] ^ prints[..., half:]
    return prints


def packer(k: int):
    """Blocks of sorted (cluster, n, sid, root, text) rows, never of two clusters, with fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, held, cluster = TaskContext.get().partitionId(), 0, [], None

        def close() -> pa.RecordBatch:
            nonlocal made
            made += 1
            sids, roots, sizes, prints = zip(*held, strict=True)
            row = [cluster, f"{task}-{made}", min(sizes), max(sizes), min(roots), max(roots), *(np.array(x, np.int64).tobytes() for x in (sids, roots, sizes)), b"".join(folded(x, len(prints[0])).tobytes() for x in prints)]
            held.clear()
            kinds = [pa.int64(), pa.string(), *[pa.int64()] * 4, *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["cluster", "block", "lo", "hi", "root_lo", "root_hi", "sids", "roots", "sizes", "prints"])

        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                values, start = shingle_sets(data, bounds, k)
                for i, (c, sid, root, n) in enumerate(zip(*(rows.column(x).to_pylist() for x in ("cluster", "sid", "root", "n")), strict=True)):
                    if held and (c != cluster or len(held) == BLOCK or len(held) * len(held[0][3]) >= BLOCK_BYTES):
                        yield close()
                    cluster = c
                    held.append((sid, root, n, fingerprint(values[start[i] : start[i + 1]])))
        if held:
            yield close()

    return run


def possible(a: dict, b: dict, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two blocks, in different components, that may link: not those whose fingerprints
    differ in more bytes than the sets of a link can differ in values."""
    size = min(a["prints"].shape[1], b["prints"].shape[1])
    prints_a, prints_b = folded(a["prints"], size), folded(b["prints"], size)
    out_a, out_b = [], []
    for i in range(len(a["sids"])):
        n, m = a["sizes"][i], b["sizes"]
        some = np.flatnonzero((b["roots"] != a["roots"][i]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
        if len(some):
            differ = (prints_b[some] != prints_a[i]).sum(axis=1)
            some = some[differ * (100 + percent) <= (n + m[some]) * (100 - percent)]
            out_a.append(np.full(len(some), a["sids"][i]))
            out_b.append(b["sids"][some])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def comparer(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sides = [{x: np.frombuffer(row[f"{x}_{s}"], np.int64) for x in ("sids", "roots", "sizes")} | {"prints": np.frombuffer(row[f"prints_{s}"], np.uint8).reshape(len(row[f"sids_{s}"]) // 8, -1)} for s in "ab"]
                x, y = possible(*sides, percent)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    return run


def in_tasks(df: DataFrame, n: int, each: int) -> DataFrame:
    """df, of n rows, in a task for every ``each`` of them, but four a core at least."""
    least = max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-n // each))
    return df.coalesce(least) if least < parts_for(df.sparkSession) else df


def cluster_pairs(open_: DataFrame, texts: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """a, b: pairs that may link and join components, among documents that share a bucket of open_ (sig,
    sid, root). Documents that buckets tie together form clusters, cut into blocks by set size; blocks
    of near sizes are compared as wholes by fingerprints, so what is shuffled is blocks, not pairs."""
    least = open_.groupBy("sig").agg(F.min("sid").alias("lead")).withColumnRenamed("sig", "sig_")
    ties = open_.join(least, F.col("sig") == F.col("sig_")).where("sid <> lead").select(F.col("sid").alias("a"), F.col("lead").alias("b"))
    clusters = components(scratch(ties, "ties"), scratch)
    roots = open_.groupBy(F.col("sid").alias("s_")).agg(F.min("root").alias("root"))
    rows = clusters.select("node", F.col("root").alias("cluster")).join(roots, F.col("node") == F.col("s_")).join(texts, F.col("node") == F.col("sid")).select("cluster", "n", "sid", "root", "text")
    schema = "cluster long, block string, lo long, hi long, root_lo long, root_hi long, sids binary, roots binary, sizes binary, prints binary"
    dealt = in_tasks(rows.repartitionByRange(parts_for(open_.sparkSession), "cluster", "n", "sid"), clusters.count(), TASK_DOCS)
    blocks = scratch(dealt.sortWithinPartitions("cluster", "n", "sid").mapInArrow(packer(k), schema), "blocks")
    meta = blocks.select("cluster", "block", "lo", "hi", "root_lo", "root_hi")
    left, right = meta.toDF("cluster", "a", "lo_a", "hi_a", "first_a", "last_a"), meta.toDF("cluster", "b", "lo_b", "hi_b", "first_b", "last_b")
    near = (F.col("a") <= F.col("b")) & (percent * F.col("lo_a") <= 100 * F.col("hi_b")) & (percent * F.col("lo_b") <= 100 * F.col("hi_a"))
    apart = F.least("first_a", "first_b") < F.greatest("last_a", "last_b")
    pairs = left.join(right, "cluster").where(near & apart).select("a", "b")
    data = blocks.select("block", "sids", "roots", "sizes", "prints")
    pairs = pairs.join(data.toDF("a", *[f"{c}_a" for c in data.columns[1:]]), "a").join(data.toDF("b", *[f"{c}_b" for c in data.columns[1:]]), "b")
    return pairs.mapInArrow(comparer(percent), "a long, b long").distinct()


class Join:
    """One run of the join: its tables, the links found so far and the components they make."""

    def __init__(self, docs: DataFrame, k: int, percent: int, scratch: Scratch) -> None:
        self.k, self.percent, self.scratch = k, percent, scratch
        base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
        self.scanned = scratch(base.mapInArrow(measurer(k), "doc_id long, th long, n long, h1 long, h2 long"), "scanned")
        live = self.scanned.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th")).alias("x"), F.min("n").alias("n"))
        self.sets = unique(live.select("h1", "h2", "n", F.col("x.doc_id").alias("doc_id"), F.col("x.th").alias("th")), scratch)
        changed = self.sets.where("sid <> h1").select(F.col("h1").alias("a_"), F.col("h2").alias("b_"), F.col("sid").alias("s_"))
        self.changed = None if changed.isEmpty() else changed
        self.buckets = self.indexed(base.where("doc_id is not null").select("text"), 0)
        some = self.buckets.select(F.col("sid").alias("s_")).distinct().join(self.sets, F.col("s_") == F.col("sid")).select("sid", "n", F.col("doc_id").alias("d_"), F.col("th").alias("t_"))
        # Rows equal in doc_id and text are one before they are shuffled.
        once = base.where("doc_id is not null").groupBy("doc_id", "th").agg(F.first("text").alias("text"))
        self.texts = scratch(some.join(once, (F.col("d_") == F.col("doc_id")) & (F.col("t_") == F.col("th"))).select("sid", "n", "text"), "texts")
        self.hits: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def indexed(self, texts: DataFrame, number: int) -> DataFrame:
        """sig, sid, info of the signatures that two sets share, and of sets whose needs aren't met."""
        entries = texts.mapInArrow(indexer(self.k, self.percent, number), "h1 long, h2 long, sig long, info long")
        if self.changed is not None:
            entries = entries.join(self.changed, (F.col("h1") == F.col("a_")) & (F.col("h2") == F.col("b_")), "left").withColumn("h1", F.coalesce("s_", "h1"))
        by_sig = Window.partitionBy("sig")
        entries = entries.select("sig", F.col("h1").alias("sid"), "info").withColumn("last", F.max("sid").over(by_sig)).withColumn("lead", F.min("sid").over(by_sig))
        return self.scratch(entries.where((F.col("lead") < F.col("last")) | is_poor()).select("sig", "sid", "info").distinct(), "buckets")

    def verify(self, pairs: DataFrame, n: int) -> None:
        """Compare pairs (a, b), of which there are n, word by word; what links is added to the links."""
        # The filter is always true; with it Spark holds the texts against a Bloom filter of the pairs,
        # and those of other sets are not shuffled.
        texts, pairs = self.texts, pairs.where("a <> b")
        with_a = pairs.join(texts.select("sid", "text").toDF("a", "text_a"), "a")
        both = with_a.join(texts.select("sid", "text").toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
        done = in_tasks(both, n, TASK_PAIRS).mapInArrow(verifier(self.k, self.percent), "a long, b long, hit boolean")
        self.hits.append(self.scratch(done.where("hit").select("a", "b"), "hits"))
        links = self.hits[0]
        for more in self.hits[1:]:
            links = links.unionAll(more)
        self.roots = components(links, self.scratch)

    def rooted(self, entries: DataFrame) -> DataFrame:
        if self.roots is None:
            return entries.withColumn("root", F.col("sid"))
        return entries.join(self.roots, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")

    def open(self, entries: DataFrame) -> DataFrame:
        """Entries with root, in buckets that hold different components, with the bucket's cost: how
        many of other components a member meets, on average; and minor: whether the entry is not of the
        component that has most members there."""
        rows = self.rooted(entries.where(~is_poor()))
        rows = rows if self.roots is None else self.scratch(rows, "rooted")
        sizes = rows.groupBy("sig", "root").agg(F.count("*").alias("c")).groupBy(F.col("sig").alias("sig_")).agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("q"), F.count("*").alias("parts"), F.max_by("root", "c").alias("main"))
        sizes = sizes.where("parts > 1").select("sig_", "main", ((F.col("c") * F.col("c") - F.col("q")) / (2 * F.col("c"))).alias("cost"))
        return self.scratch(rows.join(sizes, F.col("sig") == F.col("sig_")).withColumn("minor", F.col("root") != F.col("main")).drop("sig_", "main"), "open")

    def leads(self, entries: DataFrame) -> None:
        """Compare each set with one bucket mate of another component: of the buckets' least members
        that with which it shares most, if it is as many as a link must share."""
        order = F.xxhash64("sid", F.lit(len(self.hits)))
        lead = entries.groupBy(F.col("sig").alias("sig_")).agg(F.min(F.struct(order.alias("o"), "sid", "root")).alias("x")).select("sig_", F.col("x.sid").alias("lead"), F.col("x.root").alias("lead_root"))
        rows = entries.join(lead, F.col("sig") == F.col("sig_")).where("root <> lead_root")
        shared = rows.groupBy("sid", "lead", below().alias("below"), spare().alias("spare")).agg(F.count("*").alias("c")).where("c > spare")
        pairs = self.scratch(shared.groupBy(F.col("sid").alias("b")).agg(F.max_by("lead", F.struct("c", "lead")).alias("a")).select("a", "b"), "pairs")
        self.verify(pairs, pairs.count())

    def level(self, entries: DataFrame, number: int) -> DataFrame | None:
        """Find and verify the pairs of buckets that are worth their cost. The allocation is made set
        by set: a segment in a bucket that is not worth it counts nothing, and sets whose remaining
        ones are worth less than they need are given back (sid): they go to the next level."""
        open_ = self.open(entries)
        poor = entries.where(is_poor()).select("sid")
        if open_.isEmpty():
            return None if poor.isEmpty() else poor.distinct()
        # Summed by sid and then joined by it, so that the entries are dealt out once. Those in dear buckets are
        # only summed; one of them stays for each band in which a set fails, as it may have no others there.
        by_sid, dear = Window.partitionBy("sid"), F.col("cost") > HOT
        in_band = lambda f, x: F.when(below() == 0, f(F.when(below() == 0, x)).over(by_sid)).otherwise(f(F.when(below() == 1, x)).over(by_sid))
        lost, first = in_band(F.sum, F.when(dear, units()).otherwise(0)), in_band(F.min, F.when(dear, F.col("sig")))
        rows = open_.select("sig", "sid", "root", "minor", below().alias("below"), is_less().alias("less"), (spare() - lost).alias("left"), dear.alias("dear"), first.alias("first_"))
        rows = rows.where("not dear or (left < 0 and sig = first_)").drop("first_")
        rows = self.scratch(rows.join(self.sets.select(F.col("sid").alias("s_"), "n"), F.col("sid") == F.col("s_")).drop("s_"), "rows")
        cool = rows.where("not dear").drop("dear")
        # A bucket's main component may be nearly all of it, at little cost; its members aren't held against one
        # another, so that what meets is at most 4 times the pairs of different components.
        a, b = (cool.toDF("sig", *[f"{c}_{x}" for c in cool.columns[1:]]) for x in "ab")
        near = (~F.col("minor_b") | (F.col("sid_a") < F.col("sid_b"))) & (F.col("root_a") != F.col("root_b")) & ~(F.col("less_a") & F.col("less_b")) & (F.col("below_a") + F.col("below_b") < 2)
        near = near & (self.percent * F.col("n_a") <= 100 * F.col("n_b")) & (self.percent * F.col("n_b") <= 100 * F.col("n_a"))
        ends = F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b")
        pairs = a.where("minor_a").join(b, "sig").where(near).groupBy(*ends).agg(F.count("*").alias("c"), F.max(F.greatest("left_a", "left_b")).alias("left"))
        # Segments that differ use up what is spare, so that a link shares more than that; a shared deletion may be counted twice.
        self.settle(pairs.where("c > left").select("a", "b") if not LEVELS[number].less else pairs.select("a", "b"))
        failed = poor.unionAll(rows.where("left < 0").select("sid"))
        failed = self.scratch(failed.distinct(), "failed")
        return None if failed.isEmpty() else failed

    def settle(self, pairs: DataFrame) -> None:
        """Verify pairs, where they are many those first that give each set one partner; what that joins
        is done."""
        pairs = self.scratch(pairs, "candidates")
        for turn in range(ROUNDS):
            if not (n := pairs.count()):
                break
            if turn == ROUNDS - 1 or n <= FEW:
                self.verify(pairs, n)
                break
            some = self.scratch(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
            self.verify(some, some.count())
            rest = pairs.join(some, ["a", "b"], "left_anti").join(self.roots.toDF("a", "root_a"), "a", "left").join(self.roots.toDF("b", "root_b"), "b", "left")
            pairs = self.scratch(rest.where("coalesce(root_a, a) <> coalesce(root_b, b)").select("a", "b"), "candidates")

    def run(self) -> None:
        for _ in range(LEADS):
            open_ = self.open(self.buckets)
            if open_.isEmpty():
                break
            self.leads(open_)
        entries = self.buckets
        for number in range(len(LEVELS)):
            failed = self.level(entries, number)
            if failed is None:
                return
            of_failed = failed.withColumnRenamed("sid", "f_")
            if number + 1 < len(LEVELS):
                entries = self.indexed(self.texts.join(of_failed, F.col("sid") == F.col("f_")).select("text"), number + 1)
            else:
                rest = self.open(entries.join(of_failed, F.col("sid") == F.col("f_"), "left_semi"))
                if not rest.isEmpty():
                    self.settle(cluster_pairs(rest.select("sig", "sid", "root"), self.texts, self.k, self.percent, self.scratch))

    def result(self) -> DataFrame:
        named = self.rooted(self.sets.select("h1", "h2", "sid", "doc_id"))
        heads = self.scratch(named.groupBy("root").agg(F.min("doc_id").alias("component")).withColumnRenamed("root", "r_"), "heads")
        named = self.scratch(named.join(heads, F.col("root") == F.col("r_")).select(F.col("h1").alias("a_"), F.col("h2").alias("b_"), "component"), "named")
        on = (F.col("h1") == F.col("a_")) & (F.col("h2") == F.col("b_")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
        return self.scanned.join(named, on, "left").select("doc_id", "th", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def classes(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """What jaccard_components() gives, and th, the text's 64-bit hash."""
    with Scratch(docs.sparkSession) as scratch:
        join = Join(docs, k, percent, scratch)
        join.run()
        return materialize(join.result(), "classes")


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text): documents link if the
    Jaccard similarity of their sets of distinct k-word shingles (A-Z lower-cased) is percent/100 or
    more; component_id is the smallest doc_id that links reach.

    A text of fewer than k words is one shingle; null, empty and blank texts have none and link with
    nothing; rows with null doc_id link with nothing (component_id null); rows that repeat a doc_id
    link by their own texts; an empty table gives no rows; other columns are not looked at.

    Equal sets are one from the start. Sets are indexed by the signatures of their segments (see
    index). Each set is first compared with one bucket mate or two; what that joins needs no further
    comparison, so a large group of copies costs about its size. Then buckets that still hold
    different components give pairs, as long as they are worth their cost; segments in dearer buckets
    are left out, and sets that can't afford that are indexed again, by larger segments with
    one-deletion neighbourhoods, then by single values. Sets that even these leave short are compared in
    blocks (see cluster_pairs). Nothing but equal sets is taken as a link unverified; those are equal
    in 128 bits. Any
    HOT gives the same links. percent is from 67 to 100."""
    return classes(docs, k, percent).drop("th")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all their columns, less all but one document of each component: that with
    the smallest doc_id (then text hash) stays, once. Documents without words and rows without
    doc_id are in no group and stay."""
    found = classes(docs, k, percent).where("doc_id is not null")
    first = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "th")).alias("x")).select(F.col("x.doc_id").alias("d_"), F.col("x.th").alias("t_"), F.lit(True).alias("first_"))
    keyed = docs.withColumn("th_", F.xxhash64("text")).join(first, (F.col("doc_id") == F.col("d_")) & (F.col("th_") == F.col("t_")), "left")
    blank = F.coalesce(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")), F.lit("")) == ""
    once = F.row_number().over(Window.partitionBy("doc_id", "th_").orderBy("th_"))
    alone = keyed.where(F.col("doc_id").isNull() | blank)
    kept = keyed.where(F.col("doc_id").isNotNull() & ~blank & F.col("first_")).withColumn("once_", once).where("once_ = 1").drop("once_")
    return kept.unionByName(alone).select(*[F.col(c) for c in docs.columns])
