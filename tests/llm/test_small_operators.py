"""Operators against brute force on small tables with nulls, ties, repeats and clashing columns."""

import collections
import hashlib
import io
import itertools
import math
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkforge.llm import bpe, embedding_dedup, linear, mixing, quality, sharding, topk, toxicity, warc
from linkforge.llm.common import Scratch, new_place
from linkforge.llm import components as components_module
from linkforge.llm.components import components
from linkforge.llm.queries import default_tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, h string"
SPACE = " \t\n\x0b\x0c\r"


def words(t):
    return [w for w in "".join(" " if c in SPACE else c for c in t or "").split(" ") if w]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("alpha beta Gamma x delta, l'été 漢字 y").strip() + "w" for _ in range(rng.randint(0, 60))), "en", f"s{i % 4}") for i in range(60)]
    rows += [(60, None, None, None), (61, "", "en", None), (62, " \n\t", "en", "s1"), (None, "no id here", "en", "s1"), (5, rows[5][1], "en", "s1"), (5, "another text of five", "en", "s2"), (63, "long " * 30_000, "en", "s3"), (64, "a\x0bb\x0cc", "en", "𝒵"), (65, "<|endoftext|> it's", "en", "")]
    return spark.createDataFrame([(*r, 0, 7, "x", "y") for r in rows], DOCS).repartition(3).cache()


@pytest.mark.parametrize("small", [0, 100_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(components_module, "SMALL", small)
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(120)] + [(5, 5), (None, 3)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = dict(rows_of(components(spark.createDataFrame(links, "a long, b long"), Scratch(spark))))
    assert got == {x: find(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_sharding(spark, docs):
    for n in (1, 2, 3, 5, 17, 1000, 10_007):
        moved = {r[0]: r[1] for r in spark.range(n).select("id", sharding.feistel("id", n, 7)).collect()}
        assert sorted(moved.values()) == list(range(n))
        a, b = sharding.grid_of(n)
        assert a * b >= n and (a - 1) * b < n + b
        for x in random.Random(n).sample(range(n), min(n, 40)):
            l, r, p = x // b, x % b, n
            while p >= n:
                for i in range(sharding.ROUNDS):
                    told = int(hashlib.md5(f"7:{i}:{l if i % 2 else r}".encode()).hexdigest()[:12], 16)
                    l, r = (l, (r + told) % b) if i % 2 else ((l + told) % a, r)
                p = l * b + r
            assert moved[x] == p
    got = rows_of(sharding.shard_rows(docs, 16))
    assert collections.Counter((r[0], r[1], r[2]) for r in got) == collections.Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    slots = collections.defaultdict(list)
    for r in got:
        slots[r[4]].append(r[5])
        assert r[3] == "rows" and r[6] is None and 0 <= r[4] < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 16
    assert sorted(got, key=repr) == sorted(rows_of(sharding.shard_rows(docs.repartition(7), 16)), key=repr)
    order = sorted(((int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}|{r.text or ''}".encode()).hexdigest()[:15], 16), -1 if r.doc_id is None else r.doc_id) for r in docs.collect()))
    moved = {r[0]: r[1] for r in spark.range(len(order)).select("id", sharding.feistel("id", len(order), 7)).collect()}
    assert collections.Counter((None if i < 0 else i, moved[k] % 16, moved[k] // 16) for k, (_, i) in enumerate(order)) == collections.Counter((r[0], r[4], r[5]) for r in got)
    assert sharding.shard_rows(docs.limit(0)).count() == 0
    place = new_place(spark, "shards")
    sharding.write_shards(docs, place, 4)
    back = spark.read.parquet(place)
    assert back.count() == docs.count() and back.select("shard", "slot").distinct().count() == docs.count()
    plan = collections.Counter((r[0], r[2], r[4], r[5]) for r in rows_of(sharding.shard_rows(docs, 4)))
    assert collections.Counter((r.doc_id, zlib.crc32((r.text or "").encode()), r["shard"], r.slot) for r in back.collect()) == plan


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(default_tokenizer())
    tok.no_padding()
    tok.no_truncation()
    want = collections.Counter()
    for r in docs.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        want[(r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert collections.Counter(rows_of(bpe.round_trip(docs, default_tokenizer()))) == want
    ids = bpe.encode(docs, default_tokenizer())
    back = bpe.decode(ids, default_tokenizer())
    assert collections.Counter(rows_of(back)) == collections.Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert bpe.round_trip(docs.limit(0), default_tokenizer()).count() == 0
    with_ids = bpe.round_trip(docs, default_tokenizer(), ids=True)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in with_ids.collect()) == collections.Counter((r.doc_id, tuple(r.ids)) for r in ids.collect())
    odd = spark.createDataFrame([(1, [39, 1 << 30, None, -1, 40]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in bpe.decode(odd, default_tokenizer()).collect()} == {1: tok.decode([39, 40]), 2: "", 3: ""}


@pytest.mark.parametrize("bits", [1, 3, 11])
def test_bpe_joins(bits, monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from linkforge.llm.hashing import text_buffer

    monkeypatch.setattr(bpe, "CHUNK_BITS", bits)
    rng = random.Random(bits)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "re", "é", "漢字", " ", " ", "😀", "<|endoftext|>", "<|end", "12", "!!", "\x1c", "\x85", "x" * 30, "The", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 200))) for _ in range(200)]
    with open(default_tokenizer()) as f:
        json_ = f.read()
    tok, mine = Tokenizer.from_str(json_), bpe.ChunkEncoder(json_)
    got = mine.encode(*text_buffer(pa.array(texts)))
    assert [x.tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_mixing(spark, docs):
    sized = docs.select("doc_id", "source", "h", F.when(F.col("text").isNotNull(), F.size(F.split("text", " "))).alias("size"), F.when(F.col("doc_id") % 2 == 0, 2.0).alias("weight"))
    got = rows_of(mixing.mix(sized).select("doc_id", "source", "size", "source_size", "target", "taken"))
    assert len(got) == docs.count() and sorted(got, key=repr) == sorted(rows_of(mixing.mix(sized.repartition(5)).select("doc_id", "source", "size", "source_size", "target", "taken")), key=repr)
    sizes, targets, taken = collections.Counter(), {}, collections.Counter()
    for _, s, n, total, target, t in got:
        sizes[s] += n
        targets[s], taken[s] = (total, target), taken[s] + t
        assert 0 <= t <= 2 * n
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in over or open_:
            want[s] = 2.0 * sizes[s] if over else level * weight[s]
        left, open_ = left - sum(want[s] for s in over), open_ - over if over else set()
    for s in names:
        assert targets[s][0] == sizes[s] and math.isclose(targets[s][1], want[s]) and abs(taken[s] - want[s]) <= 0.5 + 1e-6
    assert mixing.mix(sized.limit(0)).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    whole = mixing.mixed(docs, labels)
    # Many rows of one doc_id, or of none, with texts of their own: each has its own key.
    many = spark.createDataFrame([(None if i % 2 else 7, f"text {i} " * (i % 9), "s") for i in range(600)], "doc_id long, text string, source string")
    some = rows_of(mixing.mix(mixing.weighed(many, labels), share=0.5).select("doc_id", "th", "size", "taken", "target"))
    assert len(some) == 600 and abs(sum(r[3] for r in some) - some[0][4]) <= 1 and len({r[1] for r in some if 0 < r[3] < r[2]}) <= 1
    assert {r[0] for r in some if r[3]} == {None, 7}
    assert whole.columns == docs.columns and max(r["count"] for r in whole.groupBy("doc_id", "text").count().collect()) <= 4


def test_warc(spark):
    big = "x" * 100
    pages = [(1, "http://a/ b\r\n", big), (2, None, big), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", big), (0, "u", "é" * 60), (9, "u", "é" * 60), (1, "u", big), (10, "u", "\r\n\r\nWARC/1.1\r\n" + big)]
    df = spark.createDataFrame([(*p, 3, "z") for p in pages], "page_id long, url string, html string, payload int, digest string").repartition(3)
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = collections.Counter()
    for i, _, h in pages:
        data, lead = (h or "").encode(), first.get(h)
        visit = lead is not None and (i is None or i > lead)
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if visit else "response", lead if visit else None)] += 1
    assert collections.Counter(rows_of(warc.warc_round_trip(df))) == want
    assert warc.warc_round_trip(df.limit(0)).count() == 0
    place = new_place(spark, "warc")
    listed = warc.write_warc(df, place, archive_bytes=200)
    back = warc.read_warc(listed)
    assert {r.payload.decode() for r in back.where("record_type = 'response'").collect()} == {p[2] or "" for p in pages}
    good = warc.record_bytes(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse_record(next(warc.members(io.BytesIO(good + good))))[6] == b"payload" and len(list(warc.members(io.BytesIO(good + good), step=7))) == 2
    with pytest.raises(ValueError):
        warc.parse_record(next(warc.members(io.BytesIO(warc.record_bytes(1, "u", b"payload", "0" * 64, None)))))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(good[:-4])))


def test_topk(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [(int(i), [float(x) for x in rng.integers(-3, 4, 4) / 8]) for i in range(150)]
    vectors += [(150, None), (151, [1.0, None, 0.0, 0.0]), (152, [math.nan, 0.0, 0.0, 0.0]), (None, [9.0] * 4), (200, [0.1, 0.2]), (201, [0.3, 0.4]), (50, [9.0] * 4), (50, vectors[50][1])]
    vectors += [(400, [8e6, 0.0, 0.0]), (401, [8e6, 0.0, 0.0]), (402, [9e6, 0.0, 0.0]), (403, [-9e6, 0.0, 0.0])]
    df = spark.createDataFrame([(*v, 1, 2.0) for v in vectors], "vec_id long, embedding array<double>, rank int, score double").repartition(4)
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for at, (i, q) in enumerate(good):
        if i % 50 == 0:
            cand = sorted((-sum(a * b for a, b in zip(q, c)), j) for n, (j, c) in enumerate(good) if n != at and len(c) == len(q))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(cand[:5])]
    assert (400, 1, 402, 256 * 256 * 72 * 10**12) in want
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    asked = F.col("vec_id") % 50 == 0
    assert sorted(rows_of(topk.top_k(df, asked))) == sorted(want)
    assert topk.top_k(df.limit(0), asked).count() == 0 and topk.top_k(df, F.lit(None).cast("boolean")).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(0, [1e8]), (1, [1e8])], "vec_id long, embedding array<double>"), asked)


def test_embedding_dedup(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "INTERVAL", 16)
    monkeypatch.setattr(embedding_dedup, "LEAF", 4)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(160):
        base = np.random.default_rng(i % 12).normal(size=6)
        rows.append((i, [float(x) for x in base + rng.normal(size=6) * 0.25], int(i % 3)))
    rows += [(200 + i, rows[0][1], 0) for i in range(20)] + [(300, None, 1), (301, [0.0] * 6, 1), (302, [math.inf] * 6, 1), (303, rows[0][1], None), (304, [1.0, None], 0), (305, rows[0][1][:3], 0), (306, rows[0][1][:3], 0), (307, [x * 1e200 for x in rows[0][1]], 0), (7, rows[0][1], 0), (None, rows[0][1], 0)]
    live = [(k, np.array(v) / max(abs(x) for x in v), lab) for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    up, links = list(range(len(rows))), collections.Counter()

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, x, p), (b, y, q) in itertools.combinations(live, 2):
        if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
            links[a] += 1
            links[b] += 1
            up[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), 1 << 60), r[0])
    want = collections.Counter((r[0], links[k], least.get(find(k)), r[0] is not None and r[0] == least[find(k)]) for k, r in enumerate(rows))
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, embedding array<double>, label int, rep string, copies int").repartition(3)
    assert collections.Counter(rows_of(embedding_dedup.near_duplicates(df))) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert rows_of(embedding_dedup.near_duplicates(df.where("vec_id = 300"))) == [(300, 0, 300, True)]


def synthetic(spark, mark, n=400):
    """Documents of which a fifth carry the mark's words."""
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = " ".join([rng.choice(vocab) for _ in range(40)] + [rng.choice(mark) for _ in range(4 if bad else 0)])
        rows.append((i, text, "en", f"s{i % 3}"))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), labels


def test_toxicity(spark):
    docs, labels = synthetic(spark, ["zorkly", "zorkful", "quexis", "quexor"])
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = docs.unionByName(spark.createDataFrame([(None, "hello", "en", "s"), (1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "you idiot", "en", "s"), (3, "twice", "en", "s")], docs.schema))
    got = {(r.doc_id, r.held_out): r for r in toxicity.toxicity(docs.withColumn("score", F.lit("x")), marks).collect()}
    for (i, held), r in got.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    right = [(r.predicted == dict(labels)[i]) for (i, held), r in got.items() if held and i in dict(labels)]
    assert len(right) > 80 and sum(right) / len(right) > 0.97
    # A held-out label changes nothing.
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {(r.doc_id, r.held_out): r.score for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(math.isclose(again[k], r.score, abs_tol=1e-9) for k, r in got.items())
    clean = toxicity.clean_documents(docs, marks)
    assert clean.columns == docs.columns and clean.where("text is null").count() == 1
    empty = toxicity.toxicity(docs.limit(0), marks.limit(0))
    assert empty.count() == 0 and toxicity.toxicity(docs.limit(5), marks.limit(0)).count() == 5
    # Null labels and labels without doc_id count for nothing; of several the highest does.
    more = marks.unionByName(marks.where("toxic = 1").withColumn("toxic", F.lit(0))).unionByName(spark.createDataFrame([(5, None), (None, 1)], marks.schema))
    again = {(r.doc_id, r.held_out): r.score for r in toxicity.toxicity(docs, more).collect()}
    assert all(math.isclose(again[k], r.score, abs_tol=1e-9) for k, r in got.items())


def test_toxicity_samples(spark, monkeypatch):
    """Learning from a part of the labelled rows, and rows of one doc_id judged by their own texts."""
    monkeypatch.setattr(toxicity, "LABELLED", 150)
    monkeypatch.setattr(toxicity, "UNLABELLED", 60)
    docs, labels = synthetic(spark, ["zorkly", "zorkful", "quexis", "quexor"])
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(docs, marks)
    assert any(t.startswith(("zork", "quex")) for t in model.terms) and len(model.chosen)
    got = toxicity.toxicity(docs, marks).collect()
    right = [r.predicted == dict(labels)[r.doc_id] for r in got if r.held_out and r.doc_id in dict(labels)]
    assert sum(right) / len(right) > 0.9
    bad = docs.where("doc_id = 5").first().text
    two = spark.createDataFrame([(1007, bad, "en", "s"), (1007, "plain words", "en", "s"), (1007, "plain words", "en", "s")], docs.schema)
    left = collections.Counter(r.text for r in toxicity.clean_documents(docs.unionByName(two), marks).where("doc_id = 1007").collect())
    assert left == {"plain words": 2}


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 3000)
    votes = np.stack([np.where(rng.random(3000) < acc, 2 * y - 1, 1 - 2 * y) * (rng.random(3000) < 0.7) for acc in (0.9, 0.8, 0.8, 0.55)] , 1)
    votes = np.c_[votes, votes[:, 3], votes[:, 3]]  # a poor voter, three times
    p = toxicity.label_model(votes.astype(int), np.where(np.arange(3000) < 200, y, -1))
    assert ((p > 0.5) == y)[200:].mean() > 0.88


def test_functions_travel_without_the_package(tmp_path):
    """Executors need not have this package: what is sent to them loads, and small, where it is unknown."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from linkforge.llm import hashing, ngram_join, substring_dedup

    hashing.Words(np.frombuffer(b"some words", np.uint8), np.array([0, 10])).hashes()  # fills what must stay behind
    model = toxicity.Model(["a*"], np.arange(3), np.zeros(8))
    sent = [
        ngram_join.measurer(3), ngram_join.indexer(3, 90, 1), ngram_join.verifier(3, 90), ngram_join.packer(3), ngram_join.comparer(90), components_module.in_one_task,
        substring_dedup.scan(50, 16), substring_dedup.packer(50, 16), substring_dedup.bucket_counter(50), substring_dedup.unpacker(50), substring_dedup.keeper(50, True), toxicity.term_counts(None), toxicity.seer(["a*"]), toxicity.scorer(model),
        quality.viewer(), quality.grader([np.zeros(5)] * 2, np.zeros(3)), embedding_dedup.placer(np.eye(3), 0.4), embedding_dedup.packer(3), embedding_dedup.matcher(3, 0.9, 0.4, True), bpe.ChunkEncoder, bpe.Decoder,
    ]
    packed = cloudpickle.dumps(sent)
    assert len(packed) < 300_000
    (tmp_path / "sent").write_bytes(packed)
    code = "from pyspark import cloudpickle; assert len(cloudpickle.loads(open('sent', 'rb').read())) == 21"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr


def test_linear_fit_is_the_optimum():
    """Where the gradient of weighted loss and penalty vanishes, also for labels between 0 and 1."""
    rng = np.random.default_rng(8)
    x, weight = rng.random((500, 30)) * (rng.random((500, 30)) < 0.3), rng.random(500)
    y = np.clip(x @ rng.normal(size=30) + 0.3, 0, 1)
    w = linear.fit(x, y, weight, l2=0.1, steps=300)
    error = weight * (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y)
    assert np.abs(x.T @ error + 0.1 * w[:-1]).max() < 2e-3 and abs(error.sum()) < 2e-3
    assert not linear.fit(x[:0], y[:0]).any()


def test_label_model_holds_votes_as_bytes():
    """The driver's share is the votes, and blocks of them: not copies of all as 64-bit numbers."""
    import tracemalloc

    rng = np.random.default_rng(4)
    seen, patterns = (rng.random((16_000, 202)) < 0.02).astype(float), rng.random((16_000, 8)) < 0.02
    tracemalloc.start()
    v = toxicity.votes(seen, patterns)
    toxicity.label_model(v, np.where(np.arange(16_000) < 8000, np.arange(16_000) % 2, -1), rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert v.itemsize == 1 and peak < 40e6


def test_label_model_by_hand():
    """The same EM, written as loops over rows, voters and states."""
    rng = np.random.default_rng(4)
    v = rng.integers(-1, 2, (60, 4))
    v = np.c_[v, v[:, 0]]
    gold = np.where(np.arange(60) < 15, rng.integers(0, 2, 60), -1)
    n, m = v.shape
    p = [float(gold[i]) if gold[i] >= 0 else (0.7 if max(v[i]) > 0 else 0.1) for i in range(n)]
    for _ in range(6):
        q = [[1 - x for x in p], p]
        prior = [(sum(q[y]) + 1) / (n + 2) for y in (0, 1)]
        table = {(x, y, j): (sum(q[y][i] for i in range(n) if v[i][j] == x) + 0.1) / (sum(q[y]) + 0.3) for x in (-1, 0, 1) for y in (0, 1) for j in range(m)}
        mean = [[sum(q[y][i] * v[i][j] for i in range(n)) / sum(q[y]) for j in range(m)] for y in (0, 1)]
        cov = [[sum(q[y][i] * (v[i][j] - mean[y][j]) * (v[i][k] - mean[y][k]) for y in (0, 1) for i in range(n)) / n for k in range(m)] for j in range(m)]
        weight = [1 / (1 + sum((cov[j][k] ** 2) / (cov[j][j] * cov[k][k]) for k in range(m) if k != j)) for j in range(m)]
        z = [math.log(prior[1] / prior[0]) + sum(weight[j] * math.log(table[v[i][j], 1, j] / table[v[i][j], 0, j]) for j in range(m)) for i in range(n)]
        p = [float(gold[i]) if gold[i] >= 0 else 1 / (1 + math.exp(-z[i])) for i in range(n)]
    assert np.allclose(toxicity.label_model(v, gold, rounds=6), p, atol=1e-9)


def test_classifier_reads_the_text():
    """Buckets are chosen by what their presence tells of the labels, counted by hand."""
    texts = ["spork dough", "spork", "dough", "plain dough", "Spork plain", ""] * 4
    data, bounds = np.frombuffer("".join(texts).encode(), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]
    text, column = toxicity.text_columns(data, bounds)
    words_of = [{w for x in t.lower().split() for w in (x, x[:4] + "*") if "*" not in w or len(x) > 4} for t in texts]
    assert np.bincount(text, minlength=len(texts)).tolist() == [len(w) for w in words_of]
    p = np.array([0.9 if "spork" in t.lower() else 0.2 for t in texts])
    best = toxicity.telling(text, column, p)
    spork = set(column[text == 1].tolist())
    x = toxicity.features(np.zeros((len(texts), 2)), text, column, best)[:, 5:]
    assert spork <= set(best.tolist()) and len(spork) == 2
    at = [i for i, c in enumerate(best.tolist()) if c in spork]
    assert ((x[:, at] > 0).all(1) == np.array(["spork" in t.lower() for t in texts])).all()
    assert len(toxicity.telling(text[:0], column[:0], p)) == 0


def test_co_training_hands_over_the_surest(monkeypatch):
    """What each view is trained on, round by round, recomputed with sorted lists."""
    rng = np.random.default_rng(6)
    truth = rng.integers(0, 2, 400)
    x = [np.c_[truth + rng.normal(size=400) * s, rng.normal(size=400)] for s in (0.3, 0.5)]
    know = np.arange(400) < 100
    trained = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda *a, **k: trained.append(a) or real(*a, **k))
    quality.co_train([v[know] for v in x], truth[know], [v[~know] for v in x])
    start = [i for i in range(100) if i % 5]
    sets = [[(x[v][i].tolist(), float(truth[i]), 1.0) for i in start] for v in (0, 1)]
    pool, free, at = np.flatnonzero(~know).tolist(), [set(np.flatnonzero(~know).tolist()) for _ in (0, 1)], 2
    weights = [real(np.array([r[0] for r in s]), np.array([r[1] for r in s]), np.array([r[2] for r in s])) for s in sets]
    base = sum(truth[i] for i in start) / len(start)
    k = max(1, int(quality.SHARE * len(pool)))
    for _ in range(quality.ROUNDS):
        given = []
        for v in (0, 1):
            p = {i: 1 / (1 + math.exp(-(float(x[v][i] @ weights[v][:-1]) + weights[v][-1]))) for i in pool}
            order = sorted(free[1 - v], key=lambda i: (p[i], i))
            chosen = [i for i in order[: max(1, int(k * (1 - base)))] if p[i] < 0.1] + [i for i in order[::-1][: max(1, int(k * base))] if p[i] > 0.9]
            free[1 - v] -= set(chosen)
            given.append([(i, float(p[i] > 0.5)) for i in chosen])
        for v in (0, 1):
            sets[v] += [(x[v][i].tolist(), said, 0.3) for i, said in given[1 - v]]
            a, y, w = trained[at]
            assert sorted(zip(a.tolist(), y.tolist(), w.tolist(), strict=True)) == sorted(sets[v])
            weights[v], at = real(a, y, w), at + 1
    assert at == len(trained) - 1 and len(sets[0]) > 100


def test_quality(spark):
    docs, labels = synthetic(spark, ["%%%", "###", "|||"])
    marks = spark.createDataFrame([(i, 1 - bad) for i, bad in labels], "doc_id long, quality int")
    docs = docs.unionByName(spark.createDataFrame([(None, "hello", None, None), (1000, None, "en", "s"), (1001, "", "en", "s")], docs.schema))
    got = [r for r in quality.quality(docs.withColumn("label", F.lit(1)), marks).collect()]
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    right = [r.predicted == 1 - dict(labels)[r.doc_id] for r in got if r.held_out and r.doc_id in dict(labels)]
    assert sum(right) / len(right) > 0.95
    assert quality.quality(docs.limit(0), marks.limit(0)).count() == 0
    assert all(r.kept for r in quality.quality(docs, marks.limit(0)).collect())
    assert quality.quality(docs, marks.where("quality = 1")).count() == docs.count()
    # Null and repeated labels, clashing columns and a very long text.
    odd = marks.unionByName(marks.where("quality = 1").withColumn("quality", F.lit(0))).unionByName(spark.createDataFrame([(3, None), (None, 0)], marks.schema))
    long = docs.unionByName(spark.createDataFrame([(2000, "word " * 100_000, "en", "s")], docs.schema)).withColumns({"x": F.lit(1), "score": F.lit("y"), "label": F.lit(0), "n_chars": F.lit(7)})
    found = {(r.doc_id, r.held_out): r.score for r in quality.quality(long, odd).collect()}
    assert len(found) == len(got) + 1 and all(0 <= x <= 1 for x in found.values())
    # The size recorded with a document is of the metadata view; its text is not.
    assert (quality.meta_view(["en"], ["s"], [5]) != quality.meta_view(["en"], ["s"], [50_000])).any() and quality.meta_view([None], [None], [None]).shape == (1, quality.META_BUCKETS + 4)
