"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Settings for jobs that are run here: Python workers get a few MB of rows at a time, so that long
#: rows don't add up; shuffle files go as soon as their job is done; a join of a small filtered table
#: with a large one leaves out most of the latter before its shuffle, by a Bloom filter.
SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset on a
    single machine (tests), a new temporary folder, which is then set for the session; on a cluster
    executors could not see such a folder, so there an unset one is an error."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="linkforge-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def new_place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/linkforge/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def materialize(df: DataFrame, name: str, scratch: Scratch | None = None) -> DataFrame:
    """Cut the lineage: write df to the shared folder and return what reads it. Lost executors
    cost no more than the tasks they were running. A table that the caller's result doesn't read
    belongs into a scratch, which deletes it."""
    spark = df.sparkSession
    place = new_place(spark, name)
    with settings(spark):
        df.write.parquet(place)
    if scratch is not None:
        scratch.places.append(place)
    return spark.read.schema(df.schema).parquet(place)


class Scratch:
    """Tables that are needed until the with block ends, and then deleted."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.places = spark, []

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self)

    def drop(self) -> None:
        for place in self.places:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.places = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.drop()
