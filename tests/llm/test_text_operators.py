"""Joins, substring dedup and the pipeline against brute force."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkforge.llm import ngram_join, substring_dedup
from linkforge.llm.queries import default_tokenizer

SPACE = " \t\n\x0b\x0c\r"


def words(t):
    return [w for w in "".join(" " if c in SPACE else c for c in t or "").split(" ") if w]


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t, k):
    w = words(lowered(t))
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def classes(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near():
    rng = random.Random(4)
    vocab = [f"W{i}" for i in range(1500)]
    texts = []
    for _ in range(14):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 12, 30, 60, 120]))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 25))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            texts.append(rng.choice([" ", "\n", "\t "]).join(t))
    rows = list(enumerate(texts)) + [(500, None), (501, ""), (502, " \n"), (503, "a"), (504, "A"), (505, "a b"), (None, texts[0]), (None, "x"), (3, texts[3]), (3, texts[20]), (506, "É b c"), (507, "é b c"), (508, "q w e " * 5000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
@pytest.mark.parametrize("hot", [32, 0.4, 0])
def test_join(spark, near, monkeypatch, k, percent, hot):
    """With buckets that are never, sometimes or always too dear, so that all levels and the blocks run."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    if hot < 32:
        monkeypatch.setattr(ngram_join, "LEADS", 0)
        monkeypatch.setattr(ngram_join, "BLOCK", 8)
        monkeypatch.setattr(ngram_join, "LEAST_PRINT", 8)
    df = spark.createDataFrame([(*r, 1, "z") for r in near], "doc_id long, text string, n int, h1 string").repartition(4)
    want = collections.Counter(classes(near, k, percent))
    assert collections.Counter(tuple(r) for r in ngram_join.jaccard_components(df, k, percent).collect()) == want


@pytest.mark.parametrize(("few", "hot"), [(0, 32), (0, 0)])
def test_join_with_many_pairs_goes_by_rounds(spark, near, monkeypatch, few, hot):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "HOT", hot)
    df = spark.createDataFrame(near, "doc_id long, text string").repartition(4)
    want = collections.Counter(classes(near, 5, 80))
    assert collections.Counter(tuple(r) for r in ngram_join.jaccard_components(df, 5, 80).collect()) == want


@pytest.mark.parametrize("few", [3, 2])
def test_few_pairs_are_verified_in_one_round(spark, monkeypatch, few):
    if few < 3:
        monkeypatch.setattr(ngram_join, "FEW", few)
    join, seen = ngram_join.Join.__new__(ngram_join.Join), []
    join.scratch, join.roots = ngram_join.Scratch(spark), spark.createDataFrame([], "node long, root long")
    join.verify = lambda pairs, *n: seen.append(sorted(tuple(r) for r in pairs.collect()))
    join.settle(spark.createDataFrame([(1, 3), (1, 4), (2, 3)], "a long, b long"))
    assert seen == ([[(1, 3), (1, 4), (2, 3)]] if few == 3 else [[(1, 3), (1, 4)], [(2, 3)]])


def test_entries_of_dear_buckets_are_only_summed(spark, near, monkeypatch):
    """What a level joins with the sets' sizes: entries of buckets that it goes through, and two a set at most."""
    hot = 0.4
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "LEADS", 0)
    real, last, met = ngram_join.Scratch.__call__, {}, []

    def kept(self, df, name):
        last[name] = out = real(self, df, name)
        if name == "rows":
            open_ = last["open"]
            met.append((out.count(), open_.where(F.col("cost") <= hot).count() + 2 * open_.select("sid").distinct().count(), open_.count()))
        return out

    monkeypatch.setattr(ngram_join.Scratch, "__call__", kept)
    df = spark.createDataFrame(near, "doc_id long, text string").repartition(4)
    want = collections.Counter(classes(near, 5, 80))
    assert collections.Counter(tuple(r) for r in ngram_join.jaccard_components(df, 5, 80).collect()) == want
    assert met and all(n <= most for n, most, _ in met) and any(most < all_ for _, most, all_ in met)


def test_members_of_a_large_component_do_not_meet(spark, monkeypatch):
    """Near copies that are one component already, and two texts that share buckets with them."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]

    def changed(n):
        t = list(base)
        for i in rng.sample(range(200), n):
            t[i] = f"x{rng.randrange(10**6)}"
        return " ".join(t)

    frame, seen = type(spark.range(0)), []
    real = frame.join

    def join(self, other, on=None, how=None):
        if isinstance(on, str) and on == "sig":
            seen[-1] += real(self, other, on).count()
        return real(self, other, on, how)

    monkeypatch.setattr(frame, "join", join)
    for n in (40, 80):
        rows = list(enumerate([changed(7), changed(8)] + [changed(1) for _ in range(n)]))
        seen.append(0)
        got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        assert collections.Counter(tuple(r) for r in got) == collections.Counter(classes(rows, 3, 90))
        assert sorted({r["component_id"] for r in got}) == [0, 1, 2]
    assert 0 < seen[0] and seen[1] <= 3 * seen[0]


def test_join_where_identities_clash(spark, near, monkeypatch):
    """Sets whose first number is the same are still told apart."""
    real = ngram_join.identities
    monkeypatch.setattr(ngram_join, "identities", lambda v, s: (real(v, s)[0] % 7, real(v, s)[1]))
    monkeypatch.setattr(ngram_join, "SEEN", 3)
    df = spark.createDataFrame(near, "doc_id long, text string").repartition(3)
    want = collections.Counter(classes(near, 3, 90))
    assert collections.Counter(tuple(r) for r in ngram_join.jaccard_components(df, 3, 90).collect()) == want


def pairs_of_sets(rng, k, percent):
    """Pairs of sets of many sizes about the limit, as sorted values."""
    for _ in range(300):
        n = rng.choice([2, 4, 5, 7, 11, 20, 40, 90, 250])
        a = rng.sample(range(1 << 60), n)
        b = [x for x in a if rng.random() > rng.choice([0.02, 0.08, 0.15])]
        b += [rng.randrange(1 << 60) for _ in range(rng.randint(0, max(1, n // 8)))]
        both = len(set(a) & set(b))
        if b and 100 * both >= percent * (len(a) + len(b) - both):
            yield sorted(a), sorted(b)


@pytest.mark.parametrize("percent", [70, 80, 90])
@pytest.mark.parametrize("number", [0, 1, 2])
def test_linking_sets_share_what_the_pigeonhole_says(percent, number):
    """Whatever is too dear, the side whose other segments are worth its need shares one with the other."""
    rng, bands, checked = random.Random(percent), ngram_join.Bands(percent), 0
    for a, b in pairs_of_sets(rng, 3, percent):
        if a == b:
            continue
        values, start = np.array(a + b, np.uint64), np.array([0, len(a), len(a) + len(b)])
        rows = [(int(d), int(s), int(i)) for doc, sig, info in ngram_join.index(values, start, bands, number) for d, s, i in zip(doc, sig, info, strict=True)]
        sigs = [{s for d, s, i in rows if d == side and not i & 16} for side in (0, 1)]
        dear = set(rng.sample(sorted(sigs[0] & sigs[1]), len(sigs[0] & sigs[1]) // 3)) | set(rng.sample(sorted(sigs[0]), len(sigs[0]) // 20))
        for side in (0, 1):
            for below in (0, 1):
                mine = [(s, i) for d, s, i in rows if d == side and i & 1 == below]
                if any(i & 16 for _, i in mine) or not mine:
                    continue
                left = (mine[0][1] >> 5) - sum(i >> 2 & 3 for s, i in mine if s in dear)
                other = {s for d, s, i in rows if d != side and not i & 16}
                bands_meet = bands.of(np.array([len(a)]))[0] - bands.of(np.array([len(b)]))[0]
                if left >= 0 and (bands_meet == 0 and not below or abs(bands_meet) == 1 and (len((a, b)[side]) > len((a, b)[1 - side])) == bool(below)):
                    shared = {s for s, _ in mine} & other - dear
                    assert len(shared) > (left if number != 1 else 0)
                    checked += 1
    assert checked > 20


def test_unrelated_sets_share_nothing():
    """Empty segments have no signature, so sets of nothing in common meet in no bucket."""
    rng = np.random.default_rng(5)
    for n in (12, 94, 500, 2000):
        sets = np.sort(rng.integers(0, 1 << 60, (200, n)).astype(np.uint64), axis=1)
        for number in range(3):
            found = collections.Counter(s for _, sig, _ in ngram_join.index(sets.ravel(), np.arange(201) * n, ngram_join.Bands(80), number) for s in np.unique(sig).tolist())
            assert max(found.values()) <= (2 if number == 1 else 1) or number == 1


def test_join_edges(spark, near):
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert ngram_join.jaccard_components(df.limit(0)).count() == 0
    kept = ngram_join.one_of_each(df.withColumn("th_x", F.lit(1)), 3, 90)
    groups = classes(near, 3, 90)
    want = {c for d, n, c in groups if d is not None and n} | {d for d, n, _ in groups if d is not None and not n}
    got = [r.doc_id for r in kept.collect()]
    assert kept.columns == ["doc_id", "text", "th_x"] and collections.Counter(got) == collections.Counter([*want, None, None])


def test_substrings(spark, monkeypatch):
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(40)] + ["É", "x,"]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([8, 12, 20, 40]))] for _ in range(12)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randint(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocab) for _ in range(rng.randint(1, 15))]
        rows.append((i, rng.choice([" ", "  ", "\n", " \t"]).join(w)))
    rows += [(200, None), (201, ""), (202, " "), (None, rows[3][1]), (5, rows[5][1]), (5, rows[9][1]), (203, "w " * 20_000), (204, "w " * 30)]
    window, first = 10, {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            if d is not None:
                first[tuple(w[i : i + window])] = min(d, first.get(tuple(w[i : i + window]), d))
    want, texts = collections.Counter(), collections.Counter()
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - window + 1) for j in range(i, i + window) if d is not None and first[tuple(w[i : i + window])] < d}
        kept = [x for j, x in enumerate(w) if j not in gone]
        want[(d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())] += 1
        texts[(d, " ".join(kept) if gone else t)] += 1
    df = spark.createDataFrame([(*r, 1, 5) for r in rows], "doc_id long, text string, n_words int, n_chars int").repartition(4)
    for heavy in (20_000, 1):
        monkeypatch.setattr(substring_dedup, "HEAVY", heavy)
        assert collections.Counter(tuple(r) for r in substring_dedup.dedup(df, window, 4).collect()) == want
    out = substring_dedup.without_passages(df, window, 4)
    assert out.columns == df.columns and collections.Counter((r.doc_id, r.text) for r in out.collect()) == texts
    assert substring_dedup.dedup(df.limit(0)).count() == 0


def test_pipeline(spark, sf, tmp_path):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    step = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs.write.parquet(str(tmp_path / name))
        docs = step[name] = spark.read.parquet(str(tmp_path / name))
    assert list(stages) == ["toxicity", "near_duplicates", "substring_dedup", "mixing", "bpe"]
    rows = {name: [r.asDict() for r in df.collect()] for name, df in step.items()}
    for name in list(stages)[:-1]:
        assert step[name].columns == step["documents"].columns
    clean = [(r["doc_id"], r["text"]) for r in rows["toxicity"]]
    assert set(clean) <= {(r["doc_id"], r["text"]) for r in rows["documents"]}
    assert sorted(r["doc_id"] for r in rows["near_duplicates"]) == sorted({c if n else d for d, n, c in classes(clean, 5, 80)})
    first = {}
    for r in rows["near_duplicates"]:
        w = words(r["text"])
        for i in range(len(w) - 49):
            first[tuple(w[i : i + 50])] = min(r["doc_id"], first.get(tuple(w[i : i + 50]), r["doc_id"]))
    want = {}
    for r in rows["near_duplicates"]:
        w = words(r["text"])
        gone = {j for i in range(len(w) - 49) for j in range(i, i + 50) if first[tuple(w[i : i + 50])] < r["doc_id"]}
        want[r["doc_id"]] = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else r["text"]
    assert {r["doc_id"]: r["text"] for r in rows["substring_dedup"]} == want
    copies = collections.Counter(r["doc_id"] for r in rows["mixing"])
    assert max(copies.values()) <= 2 and all(r["text"] == want[r["doc_id"]] for r in rows["mixing"])
    tok = Tokenizer.from_file(default_tokenizer())
    counts = collections.Counter((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids)) for r in rows["mixing"])
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in rows["bpe"]) == counts
    assert corpus_pipeline.run(spark, sf).count() == len(rows["bpe"])


def test_repetitive_texts_share_a_bucket(spark, monkeypatch):
    """Texts of one repeated word have one minimiser and far more windows than a bucket may hold."""
    monkeypatch.setattr(substring_dedup, "HEAVY", 500)
    rows = [(i, "again " * (60 + 40 * i)) for i in range(12)] + [(20, "again " * 49), (21, "once " + "again " * 60 + "more")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {0: (60, 0), **{i: (60 + 40 * i, 60 + 40 * i) for i in range(1, 12)}, 20: (49, 0), 21: (62, 60)}


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_stages_on_odd_rows(spark, sf, kind):
    """The whole chain on nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    base = spark.read.parquet(f"{sf}/documents.parquet")
    names = base.columns
    docs = base.limit(20 if kind == "odd" else 0)
    if kind == "odd":
        rows = [(None, None, None, None, None), (None, "no id", "en", "s", 5), (900, None, "en", None, 0), (901, "", None, "s", 0), (902, " \n", "en", "s", 2), (903, "long word " * 40_000, "en", "s", 400_000), (904, "same text here", "en", "s", 14), (904, "same text here", "en", "s", 14), (905, "same text here", "en", "s", 14), (906, "a", "en", "s", 1)]
        docs = docs.unionByName(spark.createDataFrame(rows, base.schema))
    more = {"th": F.lit("x"), "score": F.lit(2.0), "key": F.lit(1), "copies": F.lit(5), "sid": F.lit(3), "hits": F.array(F.lit(1)), "row_": F.struct(F.lit(1).alias("text"))}
    docs = docs.withColumns(more)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        seen[name] = [r.asDict() for r in docs.collect()]
        if name != "bpe":
            assert docs.columns == [*names, *more] and all(r["score"] == 2.0 and r["copies"] == 5 for r in seen[name])
    if kind == "empty":
        assert not any(seen.values())
        return
    ids = {name: collections.Counter(r["doc_id"] for r in rows) for name, rows in seen.items()}
    assert ids["toxicity"][904] == 2 and ids["near_duplicates"][904] == 1 and 905 not in ids["near_duplicates"] and ids["near_duplicates"][None] == 2
    assert {900, 901, 902, 903, 906} <= set(ids["near_duplicates"]) and ids["substring_dedup"] == ids["near_duplicates"]
    assert {r["doc_id"]: r["text"] for r in seen["substring_dedup"]}[903] == "long word " * 40_000
    assert all(len(r["ids"]) == r["n_tokens"] for r in seen["bpe"]) and len(seen["bpe"]) == len(seen["mixing"])


def test_indexing_takes_little_memory_of_a_worker():
    import tracemalloc

    import pyarrow as pa

    texts = [" ".join(f"w{(i * 7919 + j * j) % 50021}" for j in range(300)) for i in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    run = ngram_join.indexer(5, 80, 2)
    list(run(iter([batch.slice(0, 10)])))
    tracemalloc.start()
    try:
        rows = sum(x.num_rows for x in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > len(texts) and peak < 48 << 20
