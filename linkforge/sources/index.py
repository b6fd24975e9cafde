"""The persisted block index: keys clustered for the join, reused while its sources stay the same."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocking import exploded_keys, ranked
from ..operators.features import record_features
from .sinks import _fs, read_text, write_text
from .tsv import duplicate_ids, exists


def signature(spark: SparkSession, paths: list[str]) -> str:
    """Path and size of each source."""
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        out.append(f"{fs.makeQualified(p)}:{fs.getContentSummary(p).getLength()}")
    return json.dumps(out)


def build(targets: DataFrame, place: str, sign: str, resume: bool = False) -> None:
    """blocks (key, entity_id, block_size), clustered by key, so that a purge is a pushed-down filter,
    and targets, the record features. The signature is written last: without it the index is
    unfinished; resume keeps the parts that an interrupted build from the same sources completed."""
    spark = targets.sparkSession
    if not duplicate_ids(targets).isEmpty():
        raise ValueError("targets repeat ids")
    same = resume and exists(spark, f"{place}/building.json") and read_text(spark, f"{place}/building.json") == sign
    if not same:
        fs, p = _fs(spark, place)
        fs.mkdirs(p)
        write_text(spark, sign, f"{place}/building.json")
    done = lambda name: same and exists(spark, f"{place}/{name}/_SUCCESS")
    if not done("blocks"):
        keys = exploded_keys(targets).select("key", "entity_id")
        sizes = keys.groupBy("key").agg(F.count("*").alias("block_size"))
        keys.join(sizes, "key").repartitionByRange("key").sortWithinPartitions("key", "entity_id").write.mode("overwrite").parquet(f"{place}/blocks")
    if not done("targets"):
        record_features(targets).write.mode("overwrite").parquet(f"{place}/targets")
    write_text(spark, sign, f"{place}/signature.json")


def finished(spark: SparkSession, place: str) -> bool:
    return exists(spark, f"{place}/signature.json")


def ensure(spark: SparkSession, targets: DataFrame, place: str, sign: str, rebuild: bool = False, resume: bool = False) -> tuple[DataFrame, DataFrame]:
    """(blocks, targets) of the index at place; built if it is missing or unfinished (see build), or if
    rebuild is set; an index of other sources is an error."""
    if rebuild or not finished(spark, place):
        if rebuild and finished(spark, place):
            fs, p = _fs(spark, f"{place}/signature.json")
            fs.delete(p, False)
        build(targets, place, sign, resume and not rebuild)
    elif read_text(spark, f"{place}/signature.json") != sign:
        raise ValueError("the index was built from other sources; rebuild it")
    return spark.read.parquet(f"{place}/blocks"), spark.read.parquet(f"{place}/targets")


def scores(query_keys: DataFrame, blocks: DataFrame, max_block_size: int) -> DataFrame:
    """query_id, target_id, score from the persisted index: the purge is a filter on the scan."""
    small = blocks.where(F.col("block_size") <= max_block_size).select("key", F.col("entity_id").alias("target_id"))
    return query_keys.select(F.col("entity_id").alias("query_id"), "key", "weight").join(small, "key").groupBy("query_id", "target_id").agg(F.sum("weight").alias("score"))


def candidates(query_keys: DataFrame, blocks: DataFrame, max_block_size: int, max_candidates: int) -> DataFrame:
    """Top candidates from the persisted index."""
    return ranked(scores(query_keys, blocks, max_block_size), max_candidates)
