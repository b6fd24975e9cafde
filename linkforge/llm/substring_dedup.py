"""Substring dedup: passages that an earlier document has, found through super-k-mers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, materialize, parts_for
from .hashing import Words, pieces, runs

#: Words of a window, and of the run whose least hash is the window's minimiser.
WINDOW, MINIMISER = 50, 16
#: Buckets of more windows than this are counted window by window, over many tasks; the result is the same.
HEAVY = 40_000


def super_kmers(words: Words, window: int, minimiser: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows, text) of each run of consecutive windows of one text that
    share a minimiser; windows are numbered by their first word."""
    grams = runs(words.hashes(), minimiser)
    width, step = window - minimiser + 1, 1
    least = grams
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if width > step and len(least):
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    text = np.searchsorted(words.first, np.arange(len(least)), "right") - 1
    inside = np.arange(len(least)) + window <= words.first[text + 1] if len(least) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.int64), at, at, at
    new = np.r_[True, (np.diff(at) > 1) | (least[at][1:] != least[at][:-1]) | (text[at][1:] != text[at][:-1])]
    start = np.flatnonzero(new)
    return least[at[start]].view(np.int64), at[start], np.diff(np.r_[start, len(at)]), text[at[start]]


def lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32), pa.array(values))


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def scan(window: int, minimiser: int):
    """A row a document: its words, the digest of all of them, and its minimisers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                words = Words(data, bounds)
                m, _, _, text = super_kmers(words, window, minimiser)
                raw = data.tobytes()
                digests = [sha(b" ".join(raw[a:b].split())) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(np.diff(words.first)), pa.array(digests, pa.string()), lists(m, text, rows.num_rows)], ["doc_id", "th", "n_words", "sha", "ms"])

    return run


def packer(window: int, minimiser: int):
    """Super-k-mers whose minimiser is among the document's shared ones, each as one packed string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, bounds in pieces(batch, "text"):
                words, out = Words(data, bounds), []
                m, start, n, text = super_kmers(words, window, minimiser)
                ids, ths, shared = (rows.column(i).to_pylist() for i in (0, 1, 3))
                cut = np.searchsorted(text, np.arange(rows.num_rows + 1))
                for d in range(rows.num_rows):
                    part = slice(cut[d], cut[d + 1])
                    keep = np.flatnonzero(np.isin(m[part], np.array(shared[d], np.int64))) + cut[d]
                    for i in keep.tolist():
                        packed = words.joined(int(start[i]), int(start[i] + n[i]) + window - 1)
                        out.append((hashlib.blake2b(packed, digest_size=16).digest(), int(m[i]), packed, ids[d], ths[d], int(start[i] - words.first[d]), int(n[i])))
                if out:
                    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "m", "packed", "doc_id", "th", "start", "n"])

    return run


def windows_of(packed: bytes, window: int) -> list[bytes]:
    words = packed.split(b" ")
    return [b" ".join(words[i : i + window]) for i in range(len(words) - window + 1)]


def bucket_counter(window: int):
    """Rows come sorted by bucket. The windows of a bucket are sorted; equal ones get the least
    document of any. A super-k-mer whose windows all have one least document tells it once."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("m", "key", "packed", "first")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts = [], []
        for _, bucket in groupby(rows_of(batches), lambda r: r[0]):
            bucket = list(bucket)
            if len(bucket) == 1:
                keys.append(bucket[0][1])
                firsts.append([bucket[0][3]])
            else:
                found = [[0] * (packed.count(b" ") + 2 - window) for _, _, packed, _ in bucket]
                every = sorted((w, first, k, i) for k, (_, _, packed, first) in enumerate(bucket) for i, w in enumerate(windows_of(packed, window)))
                last, least = None, 0
                for w, first, k, i in every:
                    if w != last:
                        last, least = w, first
                    found[k][i] = least
                for row, mins in zip(bucket, found, strict=True):
                    keys.append(row[1])
                    firsts.append(mins[:1] if min(mins) == max(mins) else mins)
            if len(keys) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["key", "mins"])
                keys, firsts = [], []
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))], ["key", "mins"])

    return run


def unpacker(window: int):
    """The windows of super-k-mers, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, first, key, i) for key, packed, first in zip(*(batch.column(c).to_pylist() for c in ("key", "packed", "first")), strict=True) for i, w in enumerate(windows_of(packed, window))]
            for at in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 10_000], strict=True), (pa.binary(), pa.int64(), pa.binary(), pa.int32()), strict=True)], ["window", "first", "key", "i"])

    return run


def cover(n: int, window: int, doc_id: int, hits: list[dict]) -> np.ndarray:
    """Which of n words a window covers whose least document is smaller than doc_id."""
    delta = np.zeros(n + 1, np.int64)
    for h in hits:
        mins = h["mins"]
        if len(mins) == 1:
            delta[h["start"]] += 1
            delta[h["start"] + h["n"] + window - 1] -= 1
        else:
            at = h["start"] + np.flatnonzero(np.array(mins) < doc_id)
            np.add.at(delta, at, 1)
            np.add.at(delta, at + window, -1)
    return np.cumsum(delta[:-1]) > 0


def keeper(window: int, texts: bool):
    """What is left of each document: removed words, digest, and the kept text if it is asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, th, text, hits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "hits")), strict=True):
                words = text.encode().split()
                gone = cover(len(words), window, doc_id, hits)
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out.append((doc_id, th, int(gone.sum()), sha(kept), kept.decode() if texts else None))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))], ["d_", "t_", "n_removed", "kept_sha", "kept_text"])

    return run


def passages(docs: DataFrame, window: int, minimiser: int, texts: bool) -> tuple[DataFrame, DataFrame]:
    """(a row a document: doc_id, th, n_words, sha; what is left, d_, t_, n_removed, kept_sha,
    kept_text, of each different (doc_id, th) that loses words). th: the text's 64-bit hash."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        scanned = scratch(base.mapInArrow(scan(window, minimiser), "doc_id long, th long, n_words long, sha string, ms array<long>"), "scanned")
        found = materialize(scanned.drop("ms"), "documents")
        each = scanned.where("doc_id is not null").select("doc_id", "th", F.explode("ms").alias("m"))
        shared = scratch(each.groupBy("m").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select(F.col("m").alias("m_")), "shared")
        of_doc = scratch(each.join(shared, F.col("m") == F.col("m_")).groupBy(F.col("doc_id").alias("d_"), F.col("th").alias("t_")).agg(F.collect_set("m").alias("shared")), "of_doc")
        # Rows equal in doc_id and text are one before they are shuffled.
        once = base.where("doc_id is not null").groupBy("doc_id", "th").agg(F.first("text").alias("text"))
        some = scratch(once.join(of_doc, (F.col("doc_id") == F.col("d_")) & (F.col("th") == F.col("t_"))).select("doc_id", "th", "text", "shared"), "candidates")
        occ = scratch(some.mapInArrow(packer(window, minimiser), "key binary, m long, packed binary, doc_id long, th long, start int, n int"), "superkmers")
        kinds = scratch(occ.groupBy("key", "m", "packed").agg(F.min("doc_id").alias("first"), F.max("n").alias("n")), "kinds")
        heavy = scratch(kinds.groupBy("m").agg(F.sum("n").alias("n")).where(F.col("n") > HEAVY).select(F.col("m").alias("m_")), "heavy")
        on = F.col("m") == F.col("m_")
        light = kinds.join(heavy, on, "left_anti").repartition(parts_for(docs.sparkSession), "m").sortWithinPartitions("m")
        mins = light.mapInArrow(bucket_counter(window), "key binary, mins array<long>")
        if not heavy.isEmpty():
            single = scratch(kinds.join(heavy, on, "left_semi").mapInArrow(unpacker(window), "window binary, first long, key binary, i int"), "windows")
            least = scratch(single.groupBy("window").agg(F.min("first").alias("least")).withColumnRenamed("window", "w_"), "least")
            again = single.join(least, F.col("window") == F.col("w_")).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "least"))).alias("x"))
            mins = mins.unionAll(again.select("key", F.col("x.least").alias("mins")))
        mins = scratch(mins.withColumnRenamed("key", "key_"), "mins")
        hits = occ.select("key", "doc_id", "th", "start", "n").join(mins, F.col("key") == F.col("key_")).where(F.array_min("mins") < F.col("doc_id"))
        hits = hits.groupBy(F.col("doc_id").alias("d_"), F.col("th").alias("t_")).agg(F.collect_list(F.struct("start", "n", "mins")).alias("hits"))
        cut = some.select("doc_id", "th", "text").join(hits, (F.col("doc_id") == F.col("d_")) & (F.col("th") == F.col("t_"))).select("doc_id", "th", "text", "hits")
        cut = materialize(cut.mapInArrow(keeper(window, texts), "d_ long, t_ long, n_removed long, kept_sha string, kept_text string"), "cut")
    return found, cut


def dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs (doc_id, text).

    Words are runs of other than the six ASCII white-space characters. Every word is removed that is
    covered by a window of so many consecutive words that also starts, word for word, in a document
    with a smaller doc_id, judged on the input. Repeats within a document, and in rows with an equal
    doc_id, remove nothing; rows with null doc_id neither lose words nor cost others any; null and
    empty texts have no words; rows equal in all get equal results; an empty table gives no rows;
    other columns are not looked at.

    A first scan finds each document's minimisers (hashes alone are shuffled). Documents that share
    one with another are scanned again, and their super-k-mers with such a minimiser travel as
    packed strings, equal ones as one with the least document. Each bucket's windows are then sorted
    and compared word for word. A bucket of more than HEAVY windows goes by single windows,
    aggregated before and after the shuffle, so that no task holds it."""
    found, cut = passages(docs, window, minimiser, False)
    out = found.join(cut, (F.col("doc_id") == F.col("d_")) & (F.col("th") == F.col("t_")), "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))


def without_passages(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER) -> DataFrame:
    """docs, all its columns, without the words that dedup() removes: a text that loses some becomes
    its kept words, a space between two; the others stay as they are. A column n_chars follows."""
    _, cut = passages(docs, window, minimiser, True)
    keyed = docs.withColumn("th_", F.xxhash64("text")).join(cut.select("d_", "t_", "kept_text"), (F.col("doc_id") == F.col("d_")) & (F.col("th_") == F.col("t_")), "left")
    new = {"text": F.coalesce("kept_text", "text")} | ({"n_chars": F.when(F.col("kept_text").isNotNull(), F.char_length("kept_text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return keyed.select(*[new[c].alias(c) if c in new else docs[c] for c in docs.columns])
