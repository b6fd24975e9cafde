"""Every operator of the engine as a query over the driver's tables, with its SQL in oracle.py."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import blocking as B
from ..operators import evaluate as E
from ..operators import features as X
from ..operators import matching as M
from ..operators import profile as P
from ..operators import training as R
from ..operators import validate as V
from ..sources.shared import materialize
from . import adapter

CONFIG = B.Blocking(max_block_size=20, max_candidates=10)
THRESHOLD, SEED, FRACTION, PER_COUNTRY, PER_CLASS = 0.82, "linkforge-v1", 0.2, 25, 100
#: A fixed model for queries: any weights do.
MODEL = {"bias": -4.0, "weights": [2.0, 1.5, 2.5, 1.0, 0.5, 1.0, 0.25, 0.5, 1.0, 0.5, -0.5, 0.1]}


class Context:
    """What queries share, each table made when it is first asked for and written once: prepared
    records, their keys, their features, the candidates."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.docs = spark, adapter.documents(spark, sf_dir)

    @cached_property
    def prepared(self) -> DataFrame:
        return materialize(adapter.prepared(self.docs), "records")

    @cached_property
    def records(self) -> DataFrame:
        return adapter.records(self.prepared)

    @property
    def queries(self) -> DataFrame:
        return B.sources(self.records)[0]

    @property
    def targets(self) -> DataFrame:
        return B.sources(self.records)[1]

    @property
    def entities(self) -> DataFrame:
        return self.queries.select(F.col("entity_id").alias("query_id"), "country")

    @cached_property
    def all_keys(self) -> DataFrame:
        return materialize(B.exploded_keys(self.records), "keys")

    def keys(self) -> tuple[DataFrame, DataFrame]:
        return B.sources(self.all_keys)

    def scores(self) -> DataFrame:
        return B.candidate_scores(*self.keys(), CONFIG.max_block_size)

    @cached_property
    def candidates(self) -> DataFrame:
        return materialize(B.ranked(self.scores(), CONFIG.max_candidates), "candidates")

    @cached_property
    def record_features(self) -> DataFrame:
        return materialize(X.record_features(self.records), "features")

    @cached_property
    def features(self) -> DataFrame:
        return materialize(X.features_of(self.candidates, self.record_features), "pairs")

    def scored(self) -> DataFrame:
        return X.with_heuristic_score(self.features)

    def truth(self, kind: str = "body") -> DataFrame:
        return adapter.truth(self.prepared, kind)

    def matches(self, policy: str = "top-k", **more) -> DataFrame:
        return M.select_matches(self.scored(), M.Matching(THRESHOLD, policy=policy, **more))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[Context], DataFrame]) -> Callable:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(Context(spark, sf_dir))
    return f


@query
def normalize_text(c: Context) -> DataFrame:
    return c.docs.select("doc_id", T.normalize(F.col("text")).alias("normal"))


@query
def source_records(c: Context) -> DataFrame:
    return c.records


@query
def name_tokens(c: Context) -> DataFrame:
    return B.parts(c.records).select("entity_id", F.array_join("nt", " ").alias("name_tokens"))


@query
def address_parts(c: Context) -> DataFrame:
    return B.parts(c.records).select("entity_id", *[F.array_join(a, " ").alias(b) for a, b in (("at", "address_tokens"), ("numbers", "numbers"), ("postal", "postal"), ("locality", "locality"))])


@query
def char_grams(c: Context) -> DataFrame:
    return c.records.select("entity_id", F.explode(T.grams(T.normalize(F.col("business_name")))).alias("gram"))


@query
def useful_tokens(c: Context) -> DataFrame:
    rows = c.record_features
    return rows.select("entity_id", *[F.array_join(F.array_sort(a), " ").alias(b) for a, b in (("name.tokens", "name_tokens"), ("address.tokens", "address_tokens"), ("address.numbers", "address_numbers"))])


@query
def block_keys_long(c: Context) -> DataFrame:
    return c.all_keys


@query
def block_keys_list(c: Context) -> DataFrame:
    return B.block_keys(c.records).select("entity_id", F.array_join("block_keys", ";").alias("block_keys"))


@query
def block_size_histogram(c: Context) -> DataFrame:
    return B.block_sizes(c.keys()[1]).groupBy("block_size").agg(F.count("*").alias("blocks"))


@query
def purged_blocks(c: Context) -> DataFrame:
    return B.block_sizes(c.keys()[1]).where(F.col("block_size") > CONFIG.max_block_size)


@query
def eligible_index(c: Context) -> DataFrame:
    return B.purged(c.keys()[1], CONFIG.max_block_size).select("entity_id", "key")


@query
def skipped_key_instances(c: Context) -> DataFrame:
    return B.skipped_instances(*c.keys(), CONFIG.max_block_size)


@query
def index_semi_join(c: Context) -> DataFrame:
    q, t = c.keys()
    return B.semi_reduced(t, q).select("entity_id", "key")


@query
def candidate_scores(c: Context) -> DataFrame:
    return c.scores()


@query
def candidate_topk(c: Context) -> DataFrame:
    return c.candidates


@query
def top1_baseline(c: Context) -> DataFrame:
    return c.candidates.where("rank = 1").select("query_id", "target_id")


@query
def candidate_lists(c: Context) -> DataFrame:
    return B.candidate_lists(c.queries, c.candidates)


@query
def candidate_lists_by_id(c: Context) -> DataFrame:
    return B.candidate_lists(c.queries, c.candidates, "id")


@query
def candidates_unlimited(c: Context) -> DataFrame:
    return B.ranked_unpurged(*c.keys(), None)


@query
def capped_queries(c: Context) -> DataFrame:
    return c.scores().groupBy("query_id").agg(F.count("*").alias("candidates")).where(F.col("candidates") > CONFIG.max_candidates)


@query
def blocking_stats(c: Context) -> DataFrame:
    return B.blocking_stats(c.queries, *c.keys(), CONFIG)


@query
def pair_features(c: Context) -> DataFrame:
    return c.features.drop("rank", "countries_differ")


@query
def heuristic_scores(c: Context) -> DataFrame:
    return c.scored().select("query_id", "target_id", "rank", "score")


@query
def scored_prefix(c: Context) -> DataFrame:
    return X.score(c.features.where("rank <= 3")).select("query_id", "target_id", "score")


@query
def model_scores(c: Context) -> DataFrame:
    return X.score(c.features, MODEL).select("query_id", "target_id", "score")


@query
def missing_targets(c: Context) -> DataFrame:
    known = c.records.where(~F.col("entity_id").endswith("1"))
    return X.missing_targets(c.candidates, known).groupBy("query_id").agg(F.count("*").alias("missing"))


@query
def matches_topk(c: Context) -> DataFrame:
    return c.matches(max_matches=3)


@query
def matches_threshold(c: Context) -> DataFrame:
    return c.matches("scored-threshold", max_matches=2)


@query
def matches_passthrough(c: Context) -> DataFrame:
    return c.matches("pass-through", max_matches=5).select("query_id", "target_id", "match_rank")


@query
def matches_empty(c: Context) -> DataFrame:
    return M.match_lists(c.queries, c.matches("empty"))


@query
def matches_gated(c: Context) -> DataFrame:
    return c.matches(min_query_probability=0.88)


@query
def match_lists(c: Context) -> DataFrame:
    return M.match_lists(c.queries, c.matches())


@query
def output_stats(c: Context) -> DataFrame:
    return M.output_stats(c.queries, c.candidates, c.matches())


@query
def labelled_pairs(c: Context) -> DataFrame:
    return R.labelled_pairs(c.candidates, c.truth()).select("query_id", "target_id", "label", "holdout")


@query
def class_sample(c: Context) -> DataFrame:
    return R.class_sample(R.labelled_pairs(c.candidates, c.truth()), PER_CLASS, SEED).select("query_id", "target_id", "label")


@query
def fit_logistic(c: Context) -> DataFrame:
    bias, weights = R.fit_logistic(materialize(R.class_sample(R.labelled_pairs(c.features, c.truth()), 20_000, SEED), "sample"))
    return c.spark.createDataFrame([("bias", bias), *zip(X.FEATURES, weights, strict=True)], "name string, weight double")


@query
def truth_links(c: Context) -> DataFrame:
    return c.truth("head").unionAll(c.truth("body")).distinct()


@query
def f05_per_entity(c: Context) -> DataFrame:
    return E.per_entity(c.entities, c.truth(), c.matches())


@query
def macro_f05(c: Context) -> DataFrame:
    return E.macro(c.entities, c.truth(), c.matches())


@query
def macro_f05_head(c: Context) -> DataFrame:
    return E.macro(c.entities, c.truth("head"), c.matches())


@query
def threshold_grid(c: Context) -> DataFrame:
    return E.tune(c.entities, c.truth(), c.scored(), E.threshold_values(0.50, 0.95, 0.05)).select("threshold", "macro_f05", "singleton_f05", "non_singleton_f05", "entities", "singletons")


@query
def best_threshold(c: Context) -> DataFrame:
    return E.best_threshold(threshold_grid(c)).select("threshold", "macro_f05")


@query
def tune_grid(c: Context) -> DataFrame:
    return E.tune(c.entities, c.truth(), c.scored(), E.threshold_values(0.60, 0.90, 0.10), E.LIMITS, E.GATES)


@query
def coverage_recall_at_k(c: Context) -> DataFrame:
    return E.recall_at(c.truth(), c.candidates)


@query
def coverage_recall_by_country(c: Context) -> DataFrame:
    truth = c.truth().join(c.entities, "query_id")
    return E.recall_at(truth, c.candidates, "country")


@query
def rank_histogram(c: Context) -> DataFrame:
    return E.rank_histogram(c.truth(), c.candidates)


@query
def coverage_oracle(c: Context) -> DataFrame:
    return E.oracle_grid(c.entities, c.truth(), c.candidates)


@query
def coverage_oracle_by_country(c: Context) -> DataFrame:
    return E.oracle_grid(c.entities, c.truth(), c.candidates, "country")


@query
def coverage_by_country(c: Context) -> DataFrame:
    return E.coverage_by_country(c.entities, c.truth(), c.candidates)


@query
def coverage_totals(c: Context) -> DataFrame:
    return E.coverage_totals(c.entities, c.truth(), c.candidates)


@query
def coverage_violations(c: Context) -> DataFrame:
    lists = B.candidate_lists(c.queries, c.candidates)
    return E.coverage_violations(c.entities.where(~F.col("query_id").endswith("3")), lists)


@query
def profile_fields(c: Context) -> DataFrame:
    return P.field_profile(c.records)


@query
def country_counts(c: Context) -> DataFrame:
    return P.country_counts(c.records)


@query
def truth_cardinality(c: Context) -> DataFrame:
    return P.truth_cardinality(c.entities, c.truth())


@query
def truth_links_by_source(c: Context) -> DataFrame:
    return P.truth_sources(c.truth())


@query
def stable_split(c: Context) -> DataFrame:
    return P.split(c.queries, FRACTION, SEED)


@query
def split_counts(c: Context) -> DataFrame:
    return P.split_counts(P.split(c.queries, FRACTION, SEED))


@query
def dev_sample(c: Context) -> DataFrame:
    return P.dev_sample(P.split(c.queries, FRACTION, SEED), PER_COUNTRY)


@query
def validate_output_violations(c: Context) -> DataFrame:
    found = c.candidates
    known = c.targets.where(~F.col("entity_id").endswith("7"))
    return V.output_violations(c.queries, known, B.candidate_lists(c.queries, found.where("rank <= 5")), M.match_lists(c.queries, c.matches()))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every record, scored and matched."""
    return Context(spark, sf_dir).matches()
