"""Sharding: a keyed permutation of global row numbers gives every row its shard and slot."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, materialize

#: Rounds of the network, and walks along a cycle at most.
ROUNDS, WALKS = 6, 64
ROWS_PER_BUCKET = 250_000


def grid_of(n: int) -> tuple[int, int]:
    """The sides of the smallest near-square grid that holds 0 .. n-1."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def feistel(x: str, n: int, seed: int) -> Column:
    """A permutation of 0 .. n-1, applied to the column x; built-in functions only. An unbalanced
    Feistel network permutes the grid of grid_of(n), whose rows and columns are its two halves: each
    round adds a keyed hash of one half to the other. A value that falls outside walks on along its
    cycle until it is inside. Outside lie fewer than one row of the grid, so up to n = WALKS ** 2 that
    many walks always do, and beyond it a longer one is as good as impossible; it would be an error."""
    a, b = grid_of(n)
    f = lambda i, v: f"cast(conv(substring(md5(cast(concat('{seed}:', {i}, ':', {v}) as binary)), 1, 12), 16, 10) as bigint)"
    rounds = ", ".join(map(str, range(ROUNDS)))
    step = f"if(i % 2 = 0, named_struct('l', (s.l + {f('i', 's.r')}) % {a}L, 'r', s.r), named_struct('l', s.l, 'r', (s.r + {f('i', 's.l')}) % {b}L))"
    once = lambda v: f"aggregate(array({rounds}), named_struct('l', {v} div {b}L, 'r', {v} % {b}L), (s, i) -> {step}, s -> s.l * {b}L + s.r)"
    walked = f"aggregate(sequence(1, {WALKS}), {once(x)}, (p, w) -> if(p < {n}L, p, {once('p')}))"
    return F.expr(f"aggregate(array({walked}), 0L, (z, p) -> if(p < {n}L, p, cast(raise_error('a walk of the permutation did not end') as bigint)))")


def numbered(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """rows (h: 0 to 2**60-1) with row_no, 0 to n-1 over the whole table, in the order of h and then of
    all other columns; and n. Rows are numbered within buckets of the hash's leading bits, so no task
    sorts more than a bucket; the bucket count follows the row count, the numbering doesn't depend on it."""
    rows = scratch(rows, "rows")
    n = rows.count()
    bits = max(6, math.ceil(math.log2(max(1, n) / ROWS_PER_BUCKET))) if n else 6
    rows = rows.withColumn("bucket", F.shiftright("h", 60 - bits))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("bucket").count().select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("bucket").orderBy("h", *[c for c in rows.columns if c not in ("h", "bucket")])
    ranked = rows.withColumn("k", F.row_number().over(within))
    return ranked.join(starts, "bucket").withColumn("row_no", (F.col("start") + F.col("k") - 1).cast("long")).drop("bucket", "k", "start"), n


def shard_rows(docs: DataFrame, n_shards: int = 16, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs (doc_id, text).

    Law ``rows``: shard counts differ by one at most, slots of a shard run from 0 without gaps, and
    both follow from the row's number alone: p = feistel(row_no), shard = p mod n_shards,
    slot = p div n_shards. Row numbers follow a hash of doc_id and text, so the result doesn't
    depend on the order or the partitions of the input. Null doc_id and null text are values like
    any other (size 1, checksum 0); rows equal in all that is returned are interchangeable and get
    different slots; an empty table gives an empty result; other columns are not looked at. Only ids,
    sizes and checksums are shuffled, never texts, and all of it is built-in functions."""
    name = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.conv(F.substring(name, 1, 15), 16, 10).cast("long").alias("h"),
    )
    with Scratch(docs.sparkSession) as scratch:
        rows, n = numbered(rows, scratch)
        p = F.col("p")
        return materialize(rows.withColumn("p", feistel("row_no", n, seed)).select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (p % n_shards).cast("int").alias("shard"),
            F.expr(f"p div {n_shards}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        ), "shards")


def write_shards(docs: DataFrame, place: str, n_shards: int = 16, seed: int = 7) -> None:
    """Write docs (doc_id, text and whatever else) to place/shard=K/, rows of a shard by slot. Rows
    meet their shard through (doc_id, checksum, size); among rows equal in these the k-th gets the
    k-th slot. Shards are dealt by ranges of slots, so a shard may span many files. Columns
    of docs named shard or slot are replaced."""
    same = Window.partitionBy("doc_id", "text_crc32", "size").orderBy("slot")
    plan = shard_rows(docs, n_shards, seed).select("doc_id", "text_crc32", "size", "shard", "slot", F.row_number().over(same).alias("k")).toDF("d_", "c_", "s_", "shard", "slot", "k_")
    keyed = docs.select(F.struct("*").alias("row_"), F.col("doc_id").alias("d"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("c"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("s"), F.xxhash64("text").alias("h"))
    keyed = keyed.withColumn("k", F.row_number().over(Window.partitionBy("d", "c", "s").orderBy("h")))
    joined = keyed.join(plan, F.col("d").eqNullSafe(F.col("d_")) & (F.col("c") == F.col("c_")) & (F.col("s") == F.col("s_")) & (F.col("k") == F.col("k_")))
    columns = [F.col("row_")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    joined.select(*columns, "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(place)
