"""Sinks: tab-separated lists and scores, id files, JSON. A file is published by one atomic rename; a
folder under a name of its own, to which a pointer file is then swung."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import FEATURES

POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace_file(spark: SparkSession, partial: str, path: str) -> None:
    """Rename the file partial to path, over what stands there: readers see the one or the other."""
    jvm = spark._jvm
    fs, source = _fs(spark, partial)
    source, target = fs.makeQualified(source), fs.makeQualified(_fs(spark, path)[1])
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    partial = f"{path}.partial-{uuid.uuid4().hex}"
    fs, p = _fs(spark, partial)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace_file(spark, partial, path)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def publish(spark: SparkSession, partial: str, path: str) -> None:
    """Make the folder partial the current version of path, then delete older versions. Readers go
    through current(); between any two steps that names a whole version."""
    fs, folder = _fs(spark, path)
    fs.mkdirs(folder)
    name = f"v-{uuid.uuid4().hex}"
    if not fs.rename(_fs(spark, partial)[1], _fs(spark, f"{path}/{name}")[1]):
        raise OSError(f"cannot publish {path}")
    write_text(spark, name, f"{path}/{POINTER}")
    for status in fs.listStatus(folder):
        if status.isDirectory() and status.getPath().getName().startswith("v-") and status.getPath().getName() != name:
            fs.delete(status.getPath(), True)


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the current version of a published path."""
    return f"{path}/{read_text(spark, f'{path}/{POINTER}').strip()}"


def joined(spark: SparkSession, folder: str, path: str, head: str = "") -> None:
    """Publish the part files of folder, in the order of their names, as one file after head. Bytes are
    streamed, so memory doesn't grow with them."""
    jvm, partial = spark._jvm, f"{path}.partial-{uuid.uuid4().hex}"
    fs, source = _fs(spark, folder)
    out = fs.create(_fs(spark, partial)[1], True)
    try:
        out.write(bytearray(head.encode()))
        for name in sorted(s.getPath().getName() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")):
            part = fs.open(_fs(spark, f"{folder}/{name}")[1])
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            part.close()
    finally:
        out.close()
    fs.delete(source, True)
    replace_file(spark, partial, path)


def write_tsv(rows: DataFrame, path: str, single: bool = False, order: tuple[str, ...] = ()) -> None:
    """rows as a published folder of tab-separated parts with headers, or as one file if single; empty
    strings are written as nothing. order: columns to sort by, over all tasks, that are not written."""
    spark, partial = rows.sparkSession, f"{path}.partial-{uuid.uuid4().hex}"
    rows = rows.orderBy(*order).drop(*order) if order else rows
    rows.write.csv(partial, sep="\t", header=not single, emptyValue="", nullValue="", quote='"', escape='"')
    if single:
        joined(spark, partial, path, "\t".join(rows.columns) + "\n")
    else:
        publish(spark, partial, path)


def write_scores(scored: DataFrame, path: str, single: bool = False) -> None:
    """Scored pairs, score and features with six decimals."""
    number = lambda c: F.format_string("%.6f", F.col(c).cast("double")).alias(c)
    write_tsv(scored.select(F.col("query_id").alias("source1_entity_id"), F.col("target_id").alias("candidate_entity_id"), number("score"), *[number(c) for c in FEATURES if c in scored.columns]), path, single)


def write_ids(ids: DataFrame, path: str) -> None:
    """Distinct ids, sorted over all tasks, a line each, as one file."""
    partial = f"{path}.partial-{uuid.uuid4().hex}"
    ids.select("entity_id").distinct().orderBy("entity_id").write.text(partial)
    joined(ids.sparkSession, partial, path)


def copy_file(spark: SparkSession, source: str, path: str) -> None:
    """Publish a copy of one file, unless it stands there already."""
    fs, a = _fs(spark, source)
    if fs.makeQualified(a).equals(fs.makeQualified(_fs(spark, path)[1])):
        return
    partial = f"{path}.partial-{uuid.uuid4().hex}"
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, _fs(spark, partial)[0], _fs(spark, partial)[1], False, spark._jsc.hadoopConfiguration())
    replace_file(spark, partial, path)


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    write_text(spark, json.dumps(value, indent=2, sort_keys=True), path)


def write_stats(stats: DataFrame, path: str) -> None:
    """A one-row aggregate as a JSON sidecar."""
    write_json(stats.sparkSession, stats.first().asDict(), path)
