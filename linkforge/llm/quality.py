"""Quality by co-training: a view of the text and a view of the page's metadata teach each other."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .hashing import Words, lowered, pieces
from .linear import fit, flat, score, sigmoid
from .toxicity import held_out

#: Rows, at most about, that the classifiers are learnt from, labelled and not.
LABELLED, UNLABELLED = 6_000, 6_000
#: Buckets of hashed words, and of hashed languages and sources.
WORD_BUCKETS, META_BUCKETS = 512, 96
#: Rounds, and the share of the unlabelled rows, of either class, that a view hands over in each.
ROUNDS, SHARE = 5, 0.05


def text_view(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How words are spread over hash buckets, and what the characters and words look like."""
    words = Words(lowered(data), bounds)
    h, n = words.hashes(), len(bounds) - 1
    size, chars = np.diff(words.first), np.diff(bounds)
    out = np.zeros((n, WORD_BUCKETS + 9))
    owner = np.repeat(np.arange(n), size)
    np.add.at(out, (owner, (h % np.uint64(WORD_BUCKETS)).astype(np.int64)), 1)
    out[:, :WORD_BUCKETS] = np.sqrt(out[:, :WORD_BUCKETS] / np.maximum(size, 1)[:, None])
    share = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][bounds]) / np.maximum(chars, 1)
    upper, lower, digit = ((data >= a) & (data <= b) for a, b in ((65, 90), (97, 122), (48, 57)))
    space = np.isin(data, (9, 10, 11, 12, 13, 32))
    stats = [share(upper), share(digit), share((data < 128) & ~(upper | lower | digit | space)), share(data == 124), share(data == 33)]
    order = np.lexsort((h, owner))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])] if len(h) else np.zeros(0, bool)
    distinct = np.bincount(owner[order][new], minlength=n) / np.maximum(size, 1)
    alike = np.zeros(len(h))
    alike[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1]) if len(h) > 1 else 0
    stats += [distinct, np.bincount(owner, alike, n) / np.maximum(size, 1), chars / np.maximum(size, 1) / 20, size == 0]
    out[:, WORD_BUCKETS:] = np.stack(stats, 1)
    return out


def meta_view(langs: list, sources: list, sizes: list) -> np.ndarray:
    """Language and source, hashed, alone and together, and the recorded size: nothing of the text."""
    out = np.zeros((len(langs), META_BUCKETS + 4))
    for i, (lang, source, size) in enumerate(zip(langs, sources, sizes, strict=True)):
        for kind, value in (("lang", lang), ("source", source), ("both", (lang, source))):
            out[i, zlib.crc32(f"{kind} {value}".encode()) % META_BUCKETS] += 1
        n = max(0, size or 0)
        out[i, META_BUCKETS:] = size is None, math.log1p(n) / 10, n < 200, n > 20_000
    return out


def viewer():
    """(label, both views) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                both = np.c_[text_view(data, bounds), meta_view(*(rows.column(i).to_pylist() for i in (2, 3, 4)))].astype(np.float32)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(np.arange(len(both) + 1, dtype=np.int32) * both.shape[1], pa.array(both.ravel()))], ["label", "x"])

    return run


def co_train(x: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The weights of each view, and the weights that combine their calibrated scores: a fifth of
    the labelled rows is kept for calibration; the views start from the rest, and in each round each
    adds the rows of the pool that the other is surest of to its own."""
    n = len(y)
    calibrate = np.arange(n) % 5 == 0 if n >= 50 else np.ones(n, bool)
    train = ~calibrate if n >= 50 else np.ones(n, bool)
    sets = [(x[v][train], y[train].astype(float), np.ones(train.sum())) for v in (0, 1)]
    weights = [fit(*s) for s in sets]
    free = [np.ones(len(pool[0]), bool) for _ in (0, 1)]
    for _ in range(ROUNDS if len(pool[0]) and len(set(y[train].tolist())) == 2 else 0):
        given = []
        for v in (0, 1):
            p = sigmoid(score(pool[v], weights[v]))
            order = np.argsort(p, kind="stable")
            order = order[free[1 - v][order]]
            k = max(1, int(SHARE * len(p)))
            base = y[train].mean()
            low, high = order[: max(1, int(k * (1 - base)))], order[::-1][: max(1, int(k * base))]
            chosen = np.r_[low[p[low] < 0.1], high[p[high] > 0.9]]
            free[1 - v][chosen] = False
            given.append((chosen, (p[chosen] > 0.5).astype(float)))
        for v in (0, 1):
            chosen, said = given[1 - v]
            sets[v] = (np.r_[sets[v][0], pool[v][chosen]], np.r_[sets[v][1], said], np.r_[sets[v][2], np.full(len(chosen), 0.3)])
            weights[v] = fit(*sets[v])
    logits = np.stack([score(x[v][calibrate], weights[v]) for v in (0, 1)], 1)
    return weights, fit(np.clip(logits, -20, 20), y[calibrate].astype(float), l2=0.1)


def grader(weights: list, combined: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                views = text_view(data, bounds), meta_view(*(rows.column(i).to_pylist() for i in (2, 3, 4)))
                z = np.stack([np.clip(score(v, w), -20, 20) for v, w in zip(views, weights, strict=True)], 1)
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(sigmoid(z[:, i])) for i in (0, 1)), pa.array(sigmoid(score(z, combined)))], ["doc_id", "text_score", "meta_score", "score"])

    return run


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, text_score, meta_score, score, predicted, kept for every row of docs (doc_id,
    text, lang, source, and n_chars if there is one); labels has doc_id and quality (0, 1 or null; of
    several the highest counts).

    One classifier sees the text, one what is recorded about it: language, source, size. Over rounds each
    labels for the other the unlabelled rows it is surest of; both are then calibrated and combined
    on labelled rows that neither has seen, and every whole text is scored, without a shuffle. Rows
    whose crc32(doc_id as text) mod 3 is 1 are held out. At most about LABELLED and UNLABELLED rows
    are learnt from. Null and empty texts, null language and source have values of their own; rows
    with null doc_id are scored and not held out; without labels all scores are 1/2 and all is kept;
    an empty table gives no rows; other columns are not looked at."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("l_")).agg(F.max("quality").alias("label"))
    size = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source", size.alias("n_chars"))
    open_ = own.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    n_gold, n = known.count(), open_.count()
    chance = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 30)) / float(1 << 30)
    gold = known.where(chance("l_") < LABELLED / max(1, n_gold * 2 / 3))
    labelled = open_.join(gold, F.col("doc_id") == F.col("l_")).select("label", "text", "lang", "source", "n_chars")
    others = open_.where(chance("doc_id") < UNLABELLED / max(1, n)).join(known.select("l_"), F.col("doc_id") == F.col("l_"), "left_anti").select(F.lit(-1).alias("label"), "text", "lang", "source", "n_chars")
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch(labelled.unionAll(others).mapInArrow(viewer(), "label int, x array<float>"), "views").orderBy("label", F.xxhash64("x")).toArrow()
    width = WORD_BUCKETS + 9
    x = flat(rows.column("x")).reshape(rows.num_rows, width + META_BUCKETS + 4)
    y = rows.column("label").to_numpy()
    know = y >= 0
    views = [x[:, :width], x[:, width:]]
    weights, combined = co_train([v[know] for v in views], y[know], [v[~know] for v in views])
    graded = own.mapInArrow(grader(weights, combined), "doc_id long, text_score double, meta_score double, score double")
    good = F.col("score") >= threshold
    return graded.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text_score", "meta_score", "score", good.cast("int").alias("predicted"), good.alias("kept"))
