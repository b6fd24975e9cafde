"""Mixing sources to target weights by Efraimidis-Spirakis keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, materialize, n_words

#: Cells of a key histogram; a source is cut to one in CELLS ** 2 of its documents before any sort.
CELLS = 1024


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target, sid: sources by code point (null last) weigh as weights says, in
    turn; by weight they share ``share`` times all sizes; none gets over ``most`` times its size, and
    the excess goes to the others by weight. In the order of cap / weight a source is capped as long
    as its part of what is left exceeds its cap, so one pass finds the level of the rest. sizes has
    one row a source (source, source_size); only this table is sorted as a whole."""
    n = F.lit(len(weights))
    rows = sizes.withColumn("sid", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    rows = rows.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("sid") - 1) % n + 1).cast("int"))).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before, all_ = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / (F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    level = F.first(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level")), ignorenulls=True).over(all_)
    return rows.withColumn("level", level).select("source", "source_size", "sid", F.coalesce(F.least("cap", F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, edge: str = "split") -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, taken, copies for every row of docs
    (doc_id, source, size: long, weight: double).

    A source is taken whole floor(target / source_size) times. What is left of its target is filled
    with documents in the order of their keys -ln(u) / weight (u from a hash of doc_id and, where
    there is one, of th, so reruns agree): the exponential race of Efraimidis and Spirakis. The document at the edge is taken in
    part (edge="split": taken words meet the target to the word), or whole if that comes nearer
    (edge="nearest"). copies: how often the document is taken, the part counted as its fraction.

    Documents without words cost nothing and go where their key puts them. A null source is a source,
    null or non-positive weights count as 1, null sizes as 0, null and repeated doc_id are values like
    others; an empty table gives no rows; of other columns only th, a hash of the text, is kept, if
    there is one (it tells rows of one doc_id apart).

    No task gets a source's documents: key histograms are summed first, and only the cell in which
    the budget ends is looked into, twice; then that cell is sorted."""
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)
    u = (F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *([F.lit("|"), "th"] if "th" in docs.columns else [])).cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    carry = ["th"] if "th" in docs.columns else []
    with Scratch(docs.sparkSession) as scratch:
        own = docs.select("doc_id", *carry, "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), (-F.log(u) / weight).alias("key"))
        own = scratch(own, "mix")
        goal = scratch(targets(own.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
        goal = goal.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        goal = goal.withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long")).withColumnRenamed("source", "source_")
        place = (1 - F.exp(-F.col("key"))) * CELLS
        rows = own.join(goal, F.col("source").eqNullSafe(F.col("source_"))).drop("source_").withColumn("c1", F.floor(place)).withColumn("c2", F.floor((place - F.col("c1")) * CELLS))
        rows = scratch(rows, "mix")

        def edge_of(some: DataFrame, cell: str, *names: str) -> DataFrame:
            """sid, the cell in which the budget ends, and what is left of the budget there."""
            order = Window.partitionBy("sid").orderBy(cell)
            sums = some.groupBy("sid", cell, "budget").agg(F.sum("size").alias("s")).withColumn("sum", F.sum("s").over(order))
            return sums.where("sum > budget").groupBy("sid").agg(F.min(cell).alias(names[0]), F.max(F.col("budget") - F.col("sum") + F.col("s")).alias(names[1]))

        first = edge_of(rows, "c1", "e1", "budget1")
        inner = rows.join(first, "sid").where("c1 = e1").drop("budget").withColumnRenamed("budget1", "budget")
        second = edge_of(inner, "c2", "e2", "budget2")
        edges = scratch(first.drop("budget1").join(second, "sid", "left"), "edges")
        rows = rows.join(edges, "sid", "left")
        on_edge = (F.col("c1") == F.col("e1")) & F.coalesce(F.col("c2") == F.col("e2"), F.lit(False))
        early = F.col("e1").isNull() | (F.col("c1") < F.col("e1")) | ((F.col("c1") == F.col("e1")) & (F.col("c2") < F.coalesce("e2", F.lit(CELLS + 1))))
        sure = rows.where(~F.coalesce(on_edge, F.lit(False))).withColumn("part", F.when(early, F.col("size")).otherwise(0)).withColumn("chosen", early.cast("int"))
        order = Window.partitionBy("sid").orderBy("key", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
        left = F.col("budget2") - F.coalesce(F.sum("size").over(order), F.lit(0))
        part = F.greatest(F.least(left, F.col("size")), F.lit(0)) if edge == "split" else F.when((left * 2 >= F.col("size")) & (left > 0), F.col("size")).otherwise(0)
        last = rows.where(on_edge).withColumn("left_", left).withColumn("part", part).withColumn("chosen", (F.col("left_") > 0).cast("int")).drop("left_")
        done = sure.unionByName(last)
        share_ = F.when(F.col("size") > 0, F.col("part") / F.col("size")).otherwise(F.col("chosen").cast("double"))
        return materialize(done.select("doc_id", *carry, "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), (F.col("epochs") + share_).alias("copies")), "mixed")


def quality_weight(quality: Column) -> Column:
    """2 for good documents, 1/2 for bad ones, 1 where nothing is known."""
    return F.when(quality == 1, 2.0).when(quality == 0, 0.5).otherwise(1.0)


def mixed(docs: DataFrame, labels: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The rows of docs (all their columns), each as often as mix(edge="nearest") takes it. labels
    (doc_id, quality) give the weights. Rows equal in doc_id, source and text are taken alike."""
    taken = mix(weighed(docs, labels), weights, share, most, "nearest").groupBy("doc_id", "th", "source").agg(F.max("copies").cast("int").alias("copies_"))
    taken = taken.where("copies_ > 0").toDF("d_", "t_", "s_", "copies_")
    keyed = docs.withColumn("th_", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))
    joined = keyed.join(taken, F.col("doc_id").eqNullSafe(F.col("d_")) & (F.col("th_") == F.col("t_")) & F.col("source").eqNullSafe(F.col("s_")))
    return joined.withColumn("copy_", F.explode(F.sequence(F.lit(1), "copies_"))).select(*[F.col(c) for c in docs.columns])


def weighed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with th (text hash), size (words) and weight (by the quality label, where there is one)."""
    quality = labels.groupBy(F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("label_quality"))
    sized = docs.select("doc_id", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("th"), "source", n_words(F.col("text")).alias("size"))
    return sized.join(quality, F.col("doc_id") == F.col("labelled"), "left").select("doc_id", "th", "source", "size", quality_weight(F.col("label_quality")).alias("weight"))
