"""Profiles of sources and truth, the stable validation split and the development sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digit_class, stable_bucket

FIELDS = ("business_name", "business_address")


def field_profile(records: DataFrame) -> DataFrame:
    """country (null: all), field, rows, empty, empty_pct, mean_chars_when_present, non_ascii_rows,
    non_ascii_pct, contains_digit_rows, contains_digit_pct: both grouping sets in one pass."""
    long = records.select("country", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(f, F.lit("")).alias("value")) for f in FIELDS])).alias("x")).select("country", "x.*")
    present, v = F.col("value") != "", F.col("value")
    # An empty country is a country of its own; null marks the total.
    sets = long.withColumn("country", F.coalesce("country", F.lit(""))).groupingSets([["country", "field"], ["field"]], "country", "field")
    counts = sets.agg(
        F.count("*").alias("rows"), F.count(F.when(~present, 1)).alias("empty"), F.coalesce(F.sum(F.when(present, F.char_length(v))), F.lit(0)).alias("chars"),
        F.count(F.when(v.rlike("[^\\x00-\\x7F]"), 1)).alias("non_ascii_rows"), F.count(F.when(v.rlike(digit_class()), 1)).alias("contains_digit_rows"),
    )
    pct = lambda c: F.bround(100.0 * F.col(c) / F.col("rows"), 4)
    some = F.col("rows") - F.col("empty")
    return counts.select(
        "country", "field", "rows", "empty", pct("empty").alias("empty_pct"), F.when(some > 0, F.bround(F.col("chars") / some, 3)).otherwise(0.0).alias("mean_chars_when_present"),
        "non_ascii_rows", pct("non_ascii_rows").alias("non_ascii_pct"), "contains_digit_rows", pct("contains_digit_rows").alias("contains_digit_pct"),
    )


def country_counts(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce("country", F.lit("")).alias("country")).agg(F.count("*").alias("rows"))


def truth_cardinality(entities: DataFrame, truth: DataFrame) -> DataFrame:
    """matches, entities: how many entities have how many links (0: singletons)."""
    per = truth.groupBy("query_id").agg(F.countDistinct("target_id").alias("n"))
    return entities.select("query_id").join(per, "query_id", "left").groupBy(F.coalesce("n", F.lit(0)).alias("matches")).agg(F.count("*").alias("entities"))


def truth_sources(truth: DataFrame) -> DataFrame:
    return truth.groupBy(F.substring("target_id", 1, 2).alias("source")).agg(F.count("*").alias("links"))


def split(records: DataFrame, fraction: float, seed: str) -> DataFrame:
    """entity_id, country, bucket, is_validation."""
    if not 0 < fraction < 1:
        raise ValueError("the fraction must be between 0 and 1")
    bucket = stable_bucket(F.col("entity_id"), seed)
    return records.select("entity_id", F.coalesce("country", F.lit("")).alias("country"), bucket.alias("bucket")).withColumn("is_validation", F.col("bucket") < round(fraction * 10_000))


def split_counts(split_rows: DataFrame) -> DataFrame:
    return split_rows.groupBy("country").agg(F.count("*").alias("total"), F.count(F.when(F.col("is_validation"), 1)).alias("validation"))


def dev_sample(split_rows: DataFrame, per_country: int) -> DataFrame:
    """The per_country ids of each country with the lowest (bucket, id)."""
    order = Window.partitionBy("country").orderBy("bucket", "entity_id")
    return split_rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_country).select("country", "entity_id", "bucket", "rn")


def markdown_table(names: list[str], rows: list[list]) -> list[str]:
    return ["| " + " | ".join(names) + " |", "|" + " --- |" * len(names), *("| " + " | ".join(map(str, r)) + " |" for r in rows), ""]


def profile_report(sources: dict[str, DataFrame], entities: DataFrame, truth: DataFrame, split_rows: DataFrame, seed: str, fraction: float, per_country: int) -> str:
    """The dataset profile as Markdown: sizes, fields by source and by country, truth, the split. All
    that is collected has a row a source, country and field, or a number of matches."""
    counts = {name: {r.country: r.rows for r in country_counts(rows).orderBy("country").collect()} for name, rows in sources.items()}
    fields = {name: sorted(field_profile(rows).collect(), key=lambda r: (r.country or "", r.field)) for name, rows in sources.items()}
    share = lambda n, pct: f"{n:,} ({pct:.2f}%)"
    cells = lambda r: [r.field, share(r.empty, r.empty_pct), f"{r.mean_chars_when_present:.2f}", share(r.non_ascii_rows, r.non_ascii_pct), share(r.contains_digit_rows, r.contains_digit_pct)]
    columns = ["Field", "Empty", "Mean characters when present", "Non-ASCII rows", "Rows containing digits"]
    matches = {r.matches: r.entities for r in truth_cardinality(entities, truth).orderBy("matches").collect()}
    total = sum(matches.values())
    links = {r.source: r.links for r in truth_sources(truth).orderBy("source").collect()}
    parts = split_counts(split_rows).orderBy("country").collect()
    lines = ["# Dataset profile", "", "## Sizes", ""]
    lines += markdown_table(["Source", "Rows", "Countries"], [[name, f"{sum(c.values()):,}", ", ".join(f"{k or '(blank)'}: {v:,}" for k, v in c.items())] for name, c in counts.items()])
    lines += ["## Fields by source", "", *markdown_table(["Source", *columns], [[name, *cells(r)] for name, rows in fields.items() for r in rows if r.country is None])]
    lines += ["## Fields by country", "", *markdown_table(["Source", "Country", *columns], [[name, r.country or "(blank)", *cells(r)] for name, rows in fields.items() for r in rows if r.country is not None])]
    lines += ["## Truth", "", f"{total:,} entities, of which {matches.get(0, 0):,} ({100 * matches.get(0, 0) / max(1, total):.2f}%) are singletons.", ""]
    lines += markdown_table(["Matches", "Entities"], [[k, f"{v:,}"] for k, v in matches.items()]) + markdown_table(["Target source", "Links"], [[k, f"{v:,}"] for k, v in links.items()])
    lines += ["## Split", "", f"Seed `{seed}`, validation fraction {fraction:.0%}; the development sample has the {per_country:,} lowest ids by hash of each country.", ""]
    lines += markdown_table(["Country", "Rows", "Validation rows", "Fraction"], [[r.country or "(blank)", f"{r.total:,}", f"{r.validation:,}", f"{r.validation / r.total:.2%}"] for r in parts])
    return "\n".join(lines)
