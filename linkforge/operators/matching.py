"""Which candidates become matches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POLICIES = ("empty", "pass-through", "scored-threshold", "top-k")


@dataclass(frozen=True)
class Matching:
    threshold: float = 0.90
    max_matches: int | None = None
    policy: str = "empty"
    min_query_probability: float | None = None

    def __post_init__(self) -> None:
        if self.policy not in POLICIES:
            raise ValueError(f"unknown match policy: {self.policy}")
        if not 0 <= self.threshold <= 1 or (self.max_matches is not None and self.max_matches < 1):
            raise ValueError("threshold must be in [0, 1] and max_matches positive")

    def promoted(self, has_scores: bool) -> Matching:
        """Scores given with policy empty mean scored-threshold."""
        return Matching(self.threshold, self.max_matches, "scored-threshold", self.min_query_probability) if has_scores and self.policy == "empty" else self


def select_matches(pairs: DataFrame, config: Matching) -> DataFrame:
    """query_id, target_id, score, match_rank of the chosen pairs (query_id, target_id, rank, score).

    ``pass-through`` and ``scored-threshold`` keep candidate order, ``top-k`` goes by score and then
    id; the cap follows that order. NaN reaches no threshold. The gate drops all matches of a query
    whose best score is below it."""
    if "score" not in pairs.columns:
        if config.policy in ("scored-threshold", "top-k"):
            return pairs.where("false").select("query_id", "target_id", F.lit(None).cast("double").alias("score"), F.lit(1).alias("match_rank"))
        pairs = pairs.withColumn("score", F.lit(None).cast("double"))
    rows = pairs.where(F.col("target_id").startswith("S2-") | F.col("target_id").startswith("S3-"))
    if config.policy == "empty":
        rows = rows.where("false")
    by_query = Window.partitionBy("query_id")
    if config.min_query_probability is not None:
        best = F.max(F.when(~F.isnan("score"), F.col("score"))).over(by_query)
        rows = rows.withColumn("best_", best).where(F.col("best_") >= config.min_query_probability).drop("best_")
    if config.policy in ("scored-threshold", "top-k"):
        rows = rows.where((F.col("score") >= config.threshold) & ~F.isnan("score"))
    order = by_query.orderBy(F.desc("score"), "target_id") if config.policy == "top-k" else by_query.orderBy("rank", "target_id")
    rows = rows.withColumn("match_rank", F.row_number().over(order))
    if config.max_matches is not None:
        rows = rows.where(F.col("match_rank") <= config.max_matches)
    return rows.select("query_id", "target_id", "score", "match_rank")


def match_lists(query_ids: DataFrame, matches: DataFrame) -> DataFrame:
    """source1_entity_id, matched_entity_ids: a row a query, empty for singletons."""
    lists = matches.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("match_rank", "target_id"))), lambda x: x["target_id"]), ",").alias("ids"))
    return query_ids.select(F.col("entity_id").alias("source1_entity_id")).join(lists, F.col("source1_entity_id") == F.col("query_id"), "left").select("source1_entity_id", F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def output_stats(query_ids: DataFrame, found: DataFrame, matches: DataFrame) -> DataFrame:
    """rows, candidate_links, match_links, rows_with_candidates, rows_with_matches."""
    rows = query_ids.agg(F.count("*").alias("rows"))
    counted = lambda df, a, b: df.groupBy("query_id").count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias(a), F.count("*").alias(b))
    return rows.join(counted(found, "candidate_links", "rows_with_candidates"), F.lit(True)).join(counted(matches, "match_links", "rows_with_matches"), F.lit(True))
