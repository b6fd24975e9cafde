"""Exact top-k search: histograms of all scores, refined until they show each query's k-th score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, new_place, settings
from .vectors import by_dimension, finite

#: Queries that are scored, and sent to the executors, at once.
QUERY_BLOCK = 2048
#: Bins of a histogram; a score range of B takes log(B) / log(BINS) passes.
BINS = 1024
#: Candidates that are scored at once.
CANDIDATE_BLOCK = 1024
SIGN = np.uint64(1 << 63)


def quantized(m: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * m)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of integer-valued doubles, exact; one that doesn't fit 64 bits is an error."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    most = float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1]
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    if most < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q).dot(whole(c).T)
    if exact.max() >= 1 << 63 or exact.min() < -(1 << 63):
        raise ValueError("an inner product does not fit 64 bits; choose a smaller scale")
    return exact.astype(np.int64)


def rising(scores: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the scores."""
    return scores.view(np.uint64) ^ SIGN


class Scorer:
    """Scores blocks of candidates against one block of queries."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: list, scale: float) -> None:
        self.rows, self.ids, self.scale, self.groups = rows, ids, scale, {}
        size = np.array([len(v) for v in vectors])
        for d in np.unique(size):
            rows = np.flatnonzero(size == d)
            self.groups[int(d)] = (rows, quantized(np.array([vectors[i] for i in rows], np.float64).reshape(len(rows), d), scale))

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(query rows, candidate ids, scores, mask of what counts) a block."""
        for batch in batches:
            numbers, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for rows, m in by_dimension(batch.column(2)):
                if m.shape[1] not in self.groups:
                    continue
                q_rows, q = self.groups[m.shape[1]]
                for at in range(0, len(rows), CANDIDATE_BLOCK):
                    some = rows[at : at + CANDIDATE_BLOCK]
                    yield q_rows, ids[some], products(q, quantized(m[at : at + CANDIDATE_BLOCK], self.scale)), self.rows[q_rows][:, None] != numbers[some][None, :]


def histograms(sent, low: np.ndarray, shift: int, k: int):
    """For mapInArrow: (q, bin, n) of this task's scores, bins of 2**shift from low[q]. A task tells
    its bins from the top until they hold k scores: the k-th of all can't lie lower."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, n = sent.value, len(low)
        counts = np.zeros(n * (BINS + 1), np.int64)
        for rows, _, scores, mask in scorer.blocks(batches):
            place = rising(scores)
            mask &= place >= low[rows][:, None]
            bins = np.minimum((place - low[rows][:, None]) >> np.uint64(shift), np.uint64(BINS)).astype(np.int64) + rows[:, None] * (BINS + 1)
            counts += np.bincount(bins[mask], minlength=len(counts))
        counts = counts.reshape(n, BINS + 1)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])], ["q", "bin", "n"])

    return run


def best(sent, threshold: np.ndarray, k: int):
    """For mapInArrow: this task's k best (query_id, vec_id, score) of those that reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value
        kept: list[np.ndarray] = [np.zeros((0, 3), np.int64)]
        held = 0

        def shrink() -> np.ndarray:
            rows = np.concatenate(kept)
            rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
            start = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.zeros(0, int)
            place = np.arange(len(rows)) - np.repeat(start, np.diff(np.r_[start, len(rows)]))
            return rows[place < k]

        for rows, ids, scores, mask in scorer.blocks(batches):
            q, c = np.nonzero(mask & (rising(scores) >= threshold[rows][:, None]))
            kept.append(np.stack([rows[q], ids[c], scores[q, c]], 1))
            held += len(q)
            if held > 500_000:
                kept = [shrink()]
                held = 0
        rows = shrink()
        yield pa.RecordBatch.from_arrays([pa.array(scorer.rows[rows[:, 0]]), pa.array(scorer.ids[rows[:, 0]]), pa.array(rows[:, 1]), pa.array(rows[:, 2])], ["query", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, asked: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of vectors (vec_id, embedding) for which asked holds
    the k best other rows (all, if fewer) by the integer inner product of floor(scale * x), ties to the
    smaller vec_id.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without
    vec_id; vectors of other dimensions than the query's are no candidates. Rows that repeat a vec_id
    are rows of their own, as queries and as candidates. An inner product that does not fit 64 bits
    fails the job. Empty tables give no rows; other columns are not looked at.

    Queries go out in blocks of QUERY_BLOCK (their size is all that is broadcast), and each block's
    result is written before the next begins. Each pass scores every candidate against the block and
    sums histograms; bins that hold a query's k-th score are split until a bin is one score wide. A
    last pass keeps the scores that reach it: k a query and task at most, however many tie."""
    spark = vectors.sparkSession
    whole = finite(F.col("embedding")) & F.col("vec_id").isNotNull()
    schema = "query long, query_id long, vec_id long, score long"
    per_query = Window.partitionBy("q").orderBy(F.desc("bin"))
    place = new_place(spark, "best")
    spark.createDataFrame([], schema).write.parquet(f"{place}/none")
    with Scratch(spark) as scratch, settings(spark):
        pool = vectors.where(whole).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(asked, F.lit(False)).alias("asked"))
        pool = scratch(pool, "pool")
        waiting = pool.where("asked")
        n_blocks = -(-waiting.count() // QUERY_BLOCK)
        size = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.abs(F.lit(scale) * x) + 1, F.lit(2.0)))
        longest = pool.agg(F.sqrt(F.max(size))).first()[0] or 0.0
        for block in range(n_blocks):
            rows = waiting.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).collect()
            if not rows:
                continue
            scorer = Scorer(np.array([r.row for r in rows], np.int64), np.array([r.vec_id for r in rows], np.int64), [r.embedding for r in rows], scale)
            reach = max(float(np.sqrt(((np.abs(scale * np.array(r.embedding)) + 1) ** 2).sum())) for r in rows) * longest
            bits = min(64, int(np.ceil(np.log2(reach + 2))) + 1)
            low, step, shift = np.full(len(rows), (1 << 63) - (1 << (bits - 1)), np.uint64), BINS.bit_length() - 1, bits
            sent = spark.sparkContext.broadcast(scorer)
            while shift > 0:
                shift = max(0, shift - step)
                summed = pool.select("row", "vec_id", "embedding").mapInArrow(histograms(sent, low.copy(), shift, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
                reached = summed.withColumn("total", F.sum("n").over(per_query)).where(F.col("total") >= k)
                for q, b in reached.groupBy("q").agg(F.max("bin")).collect():  # at most QUERY_BLOCK rows
                    low[q] += np.uint64(b << shift)
            found = pool.select("row", "vec_id", "embedding").mapInArrow(best(sent, low, k), schema)
            order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).write.parquet(f"{place}/{block}")
            sent.destroy()
    every = spark.read.schema(schema + ", rank int").option("recursiveFileLookup", True).parquet(place)
    return every.select("query_id", "rank", "vec_id", "score")
