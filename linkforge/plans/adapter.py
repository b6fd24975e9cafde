"""The driver's documents as records of three sources, and two ground truths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, normalize, tokens


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prepared(docs: DataFrame) -> DataFrame:
    """entity_id, business_name, business_address, country, and the marks that truths compare: head
    (words 1-3) and body (words 9-11), null where there are too few. Each text is normalized once."""
    first_line = F.char_length(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1))

    def named(w):
        address = F.concat_ws(" ", F.expr("cast(n_chars div 100 as string)"), F.slice(w, 5, 4), (first_line + 10000).cast("string"))
        bare = (F.col("doc_id") % 3 != 0) & (F.col("doc_id") % 31 == 0)
        mark = lambda at, least: F.when(F.size(w) >= least, F.array_join(F.slice(w, at, 3), " "))
        return F.struct(F.array_join(F.slice(w, 1, 4), " ").alias("business_name"), F.when(bare, "").otherwise(address).alias("business_address"), mark(1, 3).alias("head"), mark(9, 11).alias("body"))

    name = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string"))
    rows = docs.select(name.alias("entity_id"), let(tokens(normalize(F.col("text"))), named).alias("x"), F.col("lang").alias("country"))
    return rows.select("entity_id", "x.business_name", "x.business_address", "country", "x.head", "x.body")


def records(rows: DataFrame) -> DataFrame:
    return rows.select("entity_id", "business_name", "business_address", "country")


def truth(rows: DataFrame, kind: str = "head") -> DataFrame:
    """query_id, target_id: equal country and equal mark, of prepared() rows."""
    rows = rows.select("entity_id", "country", F.col(kind).alias("mark")).where("mark is not null")
    queries = rows.where(F.col("entity_id").startswith("S1-")).withColumnRenamed("entity_id", "query_id")
    return queries.join(rows.where(~F.col("entity_id").startswith("S1-")).withColumnRenamed("entity_id", "target_id"), ["country", "mark"]).select("query_id", "target_id")
