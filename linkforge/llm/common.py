"""What the operators share: tables in the shared folder, word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Scratch, materialize, new_place, settings, shared_dir

__all__ = ["Scratch", "WORD", "materialize", "n_words", "new_place", "parts_for", "settings", "shared_dir", "table"]

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(spark: SparkSession, per_core: int = 1) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * per_core)
