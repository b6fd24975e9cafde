"""Near-duplicate vectors: an epsilon grid order join on leading principal dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, materialize, parts_for
from .components import components
from .vectors import by_dimension, finite

#: Vectors, and bytes of them, of a sequence interval that travels as one row, at most.
INTERVAL, INTERVAL_BYTES = 8192, 4 << 20
#: Leading principal dimensions that make the grid and the bounds.
LEADING = 8
#: A pair of intervals this short is compared outright.
LEAF = 128
#: Slack for rounding in bounds; a link itself is decided by its cosine alone.
SLACK = 1e-6


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component is divided out first, so no square overflows."""
    m = m / np.abs(m).max(axis=1)[:, None]
    return m / np.sqrt((m * m).sum(axis=1))[:, None]


def second_moments(units: DataFrame, dim: int) -> np.ndarray:
    """The sum of x x' over all unit vectors: one dim x dim matrix a task, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, m in by_dimension(batch.column(0)):
                if m.shape[1] == dim:
                    m = unit(m)
                    total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(range(dim * dim), pa.int32()), pa.array(total.ravel())], ["i", "x"])

    rows = units.select("embedding").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x")).collect()
    out = np.zeros(dim * dim)
    for i, x in rows:
        out[i] = x
    return out.reshape(dim, dim)


def compare(a: dict, b: dict, same: bool, least: float, reach: float) -> tuple[np.ndarray, np.ndarray, list]:
    """Recursively join two intervals (units, grid coordinates, copies): the links of each row of
    either, counted with copies, and the links that join two sets so far apart."""
    na, nb = len(a["units"]), len(b["units"])
    links_a, links_b, tree = np.zeros(na, np.int64), np.zeros(nb, np.int64), []
    part = np.arange(na if same else na + nb)
    shift = 0 if same else na

    def go(i: int, j: int, k: int, m: int) -> None:
        x, y = a["grid"][i:j], b["grid"][k:m]
        gap = np.maximum(0, np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)))
        if gap @ gap > reach * reach:
            return
        if max(j - i, m - k) > LEAF:
            if j - i >= m - k:
                halves = [(i, (i + j) // 2, k, m), ((i + j) // 2, j, k, m)]
            else:
                halves = [(i, j, k, (k + m) // 2), (i, j, (k + m) // 2, m)]
            for h in halves:
                if not (same and h[3] <= h[0]):  # the mirror image is counted instead
                    go(*h)
            return
        hit = a["units"][i:j] @ b["units"][k:m].T >= least
        if same:
            hit &= np.arange(i, j)[:, None] < np.arange(k, m)[None, :]
        if not hit.any():
            return
        links_a[i:j] += hit @ b["copies"][k:m]
        (links_a if same else links_b)[k:m] += a["copies"][i:j] @ hit
        # Only links that join two parts matter for the forest; there are fewer of them than rows.
        while (apart := hit & (part[i:j, None] != part[None, k + shift : m + shift])).any():
            p, q = np.unravel_index(int(apart.argmax()), apart.shape)
            p, q = int(p) + i, int(q) + k
            tree.append((p, q))
            one, two = sorted((int(part[p]), int(part[q + shift])))
            part[part == two] = one

    go(0, na, 0, nb)
    return links_a, links_b, tree


def near_duplicates(vectors: DataFrame, cosine: float = 0.93, leading: int = LEADING) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding, label).

    Two vectors link if their labels are equal and not null and their cosine, in doubles, reaches
    the given one. n_links counts the other rows linked directly; component_id is the smallest
    vec_id reachable; kept marks vec_id = component_id. Null or zero vectors and those with null or
    non-finite components, and rows without vec_id, link with nothing and are their own component; so
    do vectors of different dimension. Equal vectors of a label are joined as one with its number of copies, rows repeating a
    vec_id count each; an empty table gives no rows; other columns are not looked at.

    Unit vectors are sorted by their label and the cells, as wide as the join's distance, of their
    leading principal coordinates (from second moments over all vectors), and cut into intervals.
    Intervals that may hold links are paired (see meetings); a pair is then halved again and again, leaving out halves that are provably
    too far, and what remains is compared exactly. A pair of intervals gives back counts and a
    spanning forest, never its pairs."""
    spark, kind = vectors.sparkSession, vectors.schema["embedding"].dataType
    kind = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    n_parts, reach = parts_for(spark), float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.col("label").cast("string").alias("label"))
    live = finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    # 0.0 and -0.0 are one.
    key = F.when(live, F.struct("label", F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).cast(kind).alias("embedding")))
    with Scratch(spark) as scratch:
        keyed = rows.select("vec_id", key.alias("key")).select("vec_id", "key", F.when(F.col("key").isNotNull(), F.sha2(F.to_json("key"), 256)).alias("same"))
        groups = keyed.where("same is not null").groupBy("same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("key").alias("key"))
        groups = scratch(groups.select(F.monotonically_increasing_id().alias("node"), "rep", "same", "copies", "key.label", "key.embedding"), "groups")
        found = None
        for dim in sorted(r[0] for r in groups.select(F.size("embedding")).distinct().collect()):
            some = groups.where(F.size("embedding") == dim)
            _, axes = np.linalg.eigh(second_moments(some, dim))
            placed = some.select("node", "copies", "label", "embedding").mapInArrow(placer(axes[:, ::-1][:, :leading], reach), f"node long, copies long, label string, embedding {kind}, grid array<float>, cells array<int>")
            cells = [F.col("cells")[i] for i in range(min(3, leading, dim))]
            packed = scratch(placed.repartitionByRange(n_parts, "label", *cells).sortWithinPartitions("label", *cells, "node").mapInArrow(packer(dim), INTERVALS), "intervals")
            links = packed.mapInArrow(matcher(dim, cosine, reach, True), LINKS).unionAll(meetings(packed, reach, scratch).mapInArrow(matcher(dim, cosine, reach, False), LINKS))
            links = scratch(links, "links")
            found = links if found is None else found.unionAll(links)
        named = groups.select("node", "rep", "same", "copies")
        if found is not None:
            counted = found.where("links > 0").groupBy(F.col("node").alias("n_")).agg(F.sum("links").alias("more"))
            roots = components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")), scratch)
            named = named.join(counted, F.col("node") == F.col("n_"), "left").drop("n_").join(roots.withColumnRenamed("node", "n_"), F.col("node") == F.col("n_"), "left")
            named = scratch(named.select("node", "rep", "same", "copies", "more", F.coalesce("root", "node").alias("root")), "named")
        else:
            named = named.withColumn("more", F.lit(0)).withColumn("root", F.col("node"))
        heads = scratch(named.groupBy(F.col("root").alias("r_")).agg(F.min("rep").alias("least")), "heads")
        result = scratch(named.join(heads, F.col("root") == F.col("r_")).select(F.col("same").alias("same_"), (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n"), "least"), "result")
        joined = keyed.select("vec_id", "same").join(result, F.col("same") == F.col("same_"), "left")
        out = joined.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
        return materialize(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), "result")


def meetings(packed: DataFrame, reach: float, scratch: Scratch) -> DataFrame:
    """Pairs of different intervals that may hold links, with their vectors. Intervals follow the grid
    order, so each lies in few cells of the first two coordinates, and only intervals in the same or in
    neighbouring cells can meet; what their boxes keep apart on all leading coordinates is left out."""
    width = lambda i: F.sequence(F.floor(F.get("lo", F.lit(i)) / reach), F.floor(F.get("hi", F.lit(i)) / reach))
    second = F.when(F.size("lo") > 1, width(1)).otherwise(F.array(F.lit(0).cast("long")))
    meta = packed.select("interval", "label", "lo", "hi").withColumn("c1", F.explode(width(0))).withColumn("c2", F.explode(second))
    around = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)).alias(c)
    left = meta.select(F.col("interval").alias("a"), "label", F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"), around("c1"), "c2").select("a", "label", "lo_a", "hi_a", "c1", around("c2"))
    right = meta.select(F.col("interval").alias("b"), "label", "lo", "hi", "c1", "c2")
    gap = F.aggregate(F.zip_with(F.zip_with("lo_a", "hi", lambda x, y: x - y), F.zip_with("lo", "hi_a", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x * x)
    pairs = scratch(left.join(right, ["label", "c1", "c2"]).where(F.col("a") < F.col("b")).where(gap <= reach * reach).select("a", "b").distinct(), "pairs")
    data = packed.select("interval", "nodes", "copies", "vectors", "grids")
    return pairs.join(data.toDF("a", "nodes", "copies", "vectors", "grids"), "a").join(data.toDF("b", "nodes_b", "copies_b", "vectors_b", "grids_b"), "b").drop("a", "b")


LINKS = "node long, links long, to long"
INTERVALS = "interval string, label string, lo array<double>, hi array<double>, nodes binary, copies binary, vectors binary, grids binary"


def placer(axes: np.ndarray, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda x: pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
        for batch in batches:
            for rows, m in by_dimension(batch.column(3)):
                grid = (unit(m) @ axes).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows)).columns, lists(grid), lists(np.floor(grid / np.float32(reach)).astype(np.int32))], ["node", "copies", "label", "embedding", "grid", "cells"])

    return run


def packer(dim: int):
    """Cut sorted rows into intervals of one label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, held, label = TaskContext.get().partitionId(), 0, [], None
        most = max(1, min(INTERVAL, INTERVAL_BYTES // (8 * dim)))

        def close() -> pa.RecordBatch:
            nonlocal made
            made += 1
            nodes, copies, vectors, grids = (np.concatenate(x) for x in zip(*held, strict=True))
            grids = grids.reshape(len(nodes), -1)
            row = [f"{task}-{made}", label, grids.min(0).astype(float).tolist(), grids.max(0).astype(float).tolist(), *(x.tobytes() for x in (nodes, copies, vectors, grids))]
            held.clear()
            kinds = [pa.string(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64())] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["interval", "label", "lo", "hi", "nodes", "copies", "vectors", "grids"])

        for batch in batches:
            labels = batch.column("label").to_pylist()
            nodes, copies = (batch.column(c).to_numpy() for c in ("node", "copies"))
            vectors, grids = (batch.column(c).flatten().to_numpy().reshape(len(labels), -1) for c in ("embedding", "grid"))
            at = 0
            while at < len(labels):
                size = sum(len(x[0]) for x in held)
                if held and (labels[at] != label or size >= most):
                    yield close()
                    size = 0
                label = labels[at]
                to = at
                while to < len(labels) and labels[to] == label and size + to - at < most:
                    to += 1
                held.append((nodes[at:to], copies[at:to], vectors[at:to].ravel(), grids[at:to].ravel()))
                at = to
        if held:
            yield close()

    return run


def matcher(dim: int, cosine: float, reach: float, alone: bool):
    """Compare the two intervals of each row, or one with itself: links a node has (to null), and
    links of the forest."""

    def side(row: dict, suffix: str) -> dict:
        nodes, raw = np.frombuffer(row[f"nodes{suffix}"], np.int64), row[f"vectors{suffix}"]
        vectors = np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(nodes) else np.float64).reshape(len(nodes), dim)
        return {"nodes": nodes, "copies": np.frombuffer(row[f"copies{suffix}"], np.int64), "units": unit(vectors.astype(np.float64)), "grid": np.frombuffer(row[f"grids{suffix}"], np.float32).reshape(len(nodes), -1).astype(np.float64)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                a = side(row, "")
                b = a if alone else side(row, "_b")
                links_a, links_b, tree = compare(a, b, alone, cosine, reach)
                nodes, links = (a["nodes"], links_a) if alone else (np.r_[a["nodes"], b["nodes"]], np.r_[links_a, links_b])
                some = np.flatnonzero(links)
                ends = [(int(a["nodes"][p]), int(b["nodes"][q])) for p, q in tree]
                yield pa.RecordBatch.from_arrays([pa.array([*nodes[some].tolist(), *(p for p, _ in ends)], pa.int64()), pa.array([*links[some].tolist(), *[0] * len(ends)], pa.int64()), pa.array([*[None] * len(some), *(q for _, q in ends)], pa.int64())], ["node", "links", "to"])

    return run
