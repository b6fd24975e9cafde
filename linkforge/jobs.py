"""Whole runs from files to files: index, candidates, scored outputs, training, evaluation, profile."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import format_ids
from .operators import blocking, evaluate, features, matching, profile, training
from .sources import index, sinks, tsv
from .sources.shared import materialize


def open_index(spark: SparkSession, source2: str, source3: str, place: str, rebuild: bool = False, resume: bool = False) -> tuple[DataFrame, DataFrame]:
    """(blocks, target features) of the index at place, built if need be."""
    return index.ensure(spark, tsv.targets(spark, source2, source3), place, index.signature(spark, [source2, source3]), rebuild, resume)


def generate(spark: SparkSession, source1: str, source2: str, source3: str, place: str, output: str, rebuild: bool = False, resume: bool = False, max_block_size: int = 1000, max_candidates: int = 200, max_queries: int | None = None) -> dict:
    """Write the candidate file (a row a query, in the order of source1, candidates by rank) and
    <output>.stats.json; the counters of the latter are returned."""
    blocking.Blocking(max_block_size, max_candidates)
    blocks, _ = open_index(spark, source2, source3, place, rebuild, resume)
    queries = materialize(tsv.read_queries(spark, source1, limit=max_queries), "queries")
    keys = materialize(blocking.exploded_keys(queries), "keys")
    scores = materialize(index.scores(keys, blocks, max_block_size), "scores")
    lists = blocking.candidate_lists(queries, blocking.ranked(scores, max_candidates)).join(queries.select(F.col("entity_id").alias("source1_entity_id"), "row_no"), "source1_entity_id")
    sinks.write_tsv(lists, output, single=True, order=("row_no",))
    per = scores.groupBy("query_id").agg(F.count("*").alias("n"))
    found = per.agg(F.count("*"), F.coalesce(F.sum(F.least("n", F.lit(max_candidates))), F.lit(0)), F.count(F.when(F.col("n") > max_candidates, 1))).first()
    large = blocks.where(F.col("block_size") > max_block_size).select("key").distinct()
    stats = {"queries": queries.count(), "with_candidates": found[0], "total_candidates": found[1], "skipped_large_blocks": keys.join(large, "key").count(), "capped_queries": found[2]}
    sinks.write_json(spark, stats, f"{output}.stats.json")
    return stats


def lists_of(queries: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """source1_entity_id, column, row_no: a row a query (entity_id, row_no), its ids (query_id, ids) as text."""
    named = rows.select("query_id", format_ids(F.col("ids")).alias(column))
    return queries.select(F.col("entity_id").alias("source1_entity_id"), "row_no").join(named, F.col("source1_entity_id") == F.col("query_id"), "left").select("source1_entity_id", F.coalesce(column, F.lit("")).alias(column), "row_no")


def matched_ids(matches: DataFrame) -> DataFrame:
    return matches.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("match_rank", "target_id"))), lambda x: x["target_id"]).alias("ids"))


def write_outputs(spark: SparkSession, source1: str, output_dir: str, candidate_input: str | None = None, scores_input: str | None = None, config: matching.Matching = matching.Matching()) -> dict:
    """matching_results.tsv and candidate_pairs.tsv from candidates and scores that others made; of rows
    that repeat an id the last counts. Scores with policy empty mean scored-threshold."""
    queries = materialize(tsv.read_query_ids(spark, source1), "queries")
    config = config.promoted(scores_input is not None)
    empty = spark.createDataFrame([], "query_id string, ids array<string>")
    candidates = empty
    if candidate_input is not None:
        lists = tsv.read_lists(spark, candidate_input, tsv.CANDIDATES, strict=False)
        candidates = materialize(lists.select(F.col("source1_entity_id").alias("query_id"), tsv.valid_targets(tsv.id_list(F.col("candidate_entity_ids"))).alias("ids")), "candidates")
    pairs = candidates.select("query_id", F.posexplode("ids").alias("at", "target_id")).select("query_id", "target_id", (F.col("at") + 1).alias("rank"))
    if scores_input is not None:
        pairs = pairs.join(tsv.read_scores(spark, scores_input), ["query_id", "target_id"])
    matched = materialize(lists_of(queries, matched_ids(matching.select_matches(pairs, config)), "matched_entity_ids"), "matches")
    listed = materialize(lists_of(queries, candidates, "candidate_entity_ids"), "lists")
    sinks.write_tsv(listed, f"{output_dir}/candidate_pairs.tsv", single=True, order=("row_no",))
    sinks.write_tsv(matched, f"{output_dir}/matching_results.tsv", single=True, order=("row_no",))
    return {"rows": queries.count(), "non_empty_candidates": listed.where("candidate_entity_ids <> ''").count(), "non_empty_matches": matched.where("matched_entity_ids <> ''").count()}


def write_scored_outputs(
    spark: SparkSession, candidate_input: str, source1: str, source2: str, source3: str, place: str, output_dir: str, threshold: float | None = None, max_matches: int | None = None,
    candidate_limit: int | None = None, model: dict | None = None, scores_output: str | None = None, ids: str | None = None, rebuild: bool = False,
) -> dict:
    """Score a candidate file and write matching_results.tsv, candidate_pairs.tsv (a copy of the input,
    or the scored prefix where candidate_limit is given), the pairs if asked for, and the counters.

    The candidate file must hold the same ids as source1 (or as the id file's part of it), in one
    order. Threshold, cap and gate are the model's where they aren't given, else 0.82, none and none.
    Targets' features come from the index."""
    if candidate_limit is not None and candidate_limit < 1:
        raise ValueError("the candidate limit must be positive")
    model = model or None
    settings = model or {}
    threshold = float(settings.get("threshold", 0.82)) if threshold is None else threshold
    config = matching.Matching(threshold, max_matches if max_matches is not None else settings.get("max_matches"), "top-k", settings.get("min_query_probability"))
    _, targets = open_index(spark, source2, source3, place, rebuild)
    queries = tsv.read_queries(spark, source1)
    if ids is not None:
        queries = renumbered(tsv.selected(queries, tsv.read_ids(spark, ids, "allow", allow_empty=False)))
    queries = materialize(queries, "queries")
    rows = materialize(tsv.read_candidate_rows(spark, candidate_input), "candidates")
    tsv.same_order(queries, rows)
    kept = F.col("candidates") if candidate_limit is None else F.slice("candidates", 1, candidate_limit)
    pairs = rows.select("query_id", F.posexplode(kept).alias("at", "target_id")).select("query_id", "target_id", (F.col("at") + 1).alias("rank"))
    scored = features.score(materialize(features.features_of(pairs, features.record_features(queries), targets), "features"), model)
    matches = materialize(matching.select_matches(scored, config), "matches")
    if candidate_limit is None:
        sinks.copy_file(spark, candidate_input, f"{output_dir}/candidate_pairs.tsv")
    else:
        sinks.write_tsv(lists_of(queries, rows.select("query_id", kept.alias("ids")), "candidate_entity_ids"), f"{output_dir}/candidate_pairs.tsv", single=True, order=("row_no",))
    if scores_output is not None:
        sinks.write_scores(scored, scores_output, single=True)
    sinks.write_tsv(lists_of(queries, matched_ids(matches), "matched_entity_ids"), f"{output_dir}/matching_results.tsv", single=True, order=("row_no",))
    sums = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("candidates")), F.lit(0)), F.coalesce(F.sum(F.size(kept)), F.lit(0)), F.count(F.when(F.size(kept) > 0, 1))).first()
    made = matches.agg(F.count("*"), F.count_distinct("query_id")).first()
    stats = {
        "rows": sums[0], "input_candidate_links": sums[1], "candidate_links": sums[2], "rows_with_candidates": sums[3], "matched_links": made[0], "rows_with_matches": made[1],
        "missing_target_links": pairs.join(targets.select(F.col("entity_id").alias("target_id")), "target_id", "left_anti").count(),
        "threshold": threshold, "score_candidate_limit": candidate_limit or 0, "candidate_input": candidate_input, "scoring_mode": "heuristic" if model is None else "logistic_model",
    }
    sinks.write_json(spark, stats, f"{output_dir}/scored_outputs.stats.json")
    return stats


def renumbered(rows: DataFrame) -> DataFrame:
    """rows (row_no) with row_no from 0 without gaps, in the same order; parts of a million numbers are
    counted first, so that no task sorts all rows."""
    from pyspark.sql import Window

    rows = rows.withColumn("part", F.expr("row_no div 1000000"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("row_no")
    return rows.join(starts, "part").withColumn("row_no", (F.col("start") + F.row_number().over(within) - 1).cast("long")).drop("part", "start")


def train(spark: SparkSession, scores: str, truth: str, ids: str, output: str, per_class: int = 200_000) -> dict:
    """Fit, tune and write the model of scored pairs (with their features)."""
    chosen = tsv.read_ids(spark, ids, "allow", allow_empty=False)
    rows = tsv.read_tsv(spark, scores, (*tsv.SCORED, *features.FEATURES), "superset")
    rows = rows.select(F.col("source1_entity_id").alias("query_id"), F.col("candidate_entity_id").alias("target_id"), *[F.col(c).cast("double").alias(c) for c in features.FEATURES])
    rows = materialize(tsv.restricted(rows, chosen, "query_id"), "pairs")
    links = tsv.truth_links(tsv.restricted(tsv.read_lists(spark, truth, tsv.TRUTH), chosen, complete=True))
    model = training.train(rows, links, chosen.select(F.col("entity_id").alias("query_id")), per_class)
    sinks.write_text(spark, training.model_json(model), output)
    return model


def thresholds(spark: SparkSession, truth: str, scores: str, ids: str | None = None, start: float = 0.50, stop: float = 0.99, step: float = 0.01, max_matches: int | None = None) -> str:
    """The threshold search as text."""
    lists = tsv.read_lists(spark, truth, tsv.TRUTH, strict=False)
    if ids is not None:
        lists = tsv.restricted(lists, tsv.read_ids(spark, ids, "allow"))
    results = evaluate.tune(lists.select(F.col("source1_entity_id").alias("query_id")), tsv.truth_links(lists), tsv.read_scores(spark, scores), evaluate.threshold_values(start, stop, step), (max_matches,))
    return evaluate.threshold_table(materialize(results, "results"))


def score(spark: SparkSession, truth: str, predictions: str, ids: str | None = None, as_json: bool = False) -> str:
    """The macro score of a prediction file, as text or JSON."""
    known, made = tsv.read_lists(spark, truth, tsv.TRUTH), tsv.read_lists(spark, predictions, tsv.TRUTH)
    entities = known.select(F.col("source1_entity_id").alias("query_id"))
    chosen = entities if ids is None else tsv.read_ids(spark, ids).select(F.col("entity_id").alias("query_id"))
    summary = evaluate.score_summary(evaluate.checked_macro(chosen, entities, tsv.truth_links(known), tsv.truth_links(made)))
    return json.dumps(summary, sort_keys=True) if as_json else evaluate.score_text(summary)


def coverage(spark: SparkSession, candidates: str, truth: str, source1: str, ids: str) -> dict:
    """The coverage report of a candidate file, after its integrity checks."""
    chosen = tsv.read_ids(spark, ids)
    entities = materialize(tsv.read_countries(spark, source1, chosen), "entities")
    lists = materialize(tsv.read_tsv(spark, candidates, tsv.CANDIDATES, "superset"), "lists")
    if bad := evaluate.coverage_violations(entities, lists).limit(5).collect():
        raise ValueError(f"broken candidate file: {[tuple(r) for r in bad]}")
    links = tsv.truth_links(tsv.restricted(tsv.read_lists(spark, truth, tsv.TRUTH), chosen, complete=True))
    found = lists.select(F.col("source1_entity_id").alias("query_id"), F.posexplode(tsv.id_list(F.col("candidate_entity_ids"))).alias("at", "target_id")).select("query_id", "target_id", (F.col("at") + 1).alias("rank"))
    return evaluate.coverage_report(entities, links, materialize(found, "found"))


def describe(spark: SparkSession, root: str, output: str, seed: str, fraction: float = 0.20, per_country: int = 500) -> dict:
    """The profile of a dataset, its validation ids and its development ids, written under output."""
    if per_country < 1:
        raise ValueError("the sample of a country must be positive")
    catalog = tsv.find_root(spark, root)
    sources = {f"{split}_{name}": tsv.read_source(spark, catalog.source(split, name)) for split in ("train", "test") for name in ("source1", "source2", "source3")}
    rows = materialize(profile.split(sources["train_source1"], fraction, seed), "split")
    lists = tsv.read_lists(spark, catalog.truth(), tsv.TRUTH)
    validation, sample = rows.where("is_validation"), profile.dev_sample(rows, per_country)
    sinks.write_ids(validation, f"{output}/validation_source1_ids.txt")
    sinks.write_ids(sample, f"{output}/dev_sample_source1_ids.txt")
    report = profile.profile_report(sources, lists.select(F.col("source1_entity_id").alias("query_id")), tsv.truth_links(lists), rows, seed, fraction, per_country)
    sinks.write_text(spark, report, f"{output}/dataset_profile.md")
    return {"validation_ids": validation.count(), "dev_ids": sample.count(), "profile": f"{output}/dataset_profile.md"}
