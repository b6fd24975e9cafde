"""Pair features, the heuristic score and the logistic model, as expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: The order of the features in files and models.
FEATURES = (
    "name_jaccard", "name_overlap", "name_trigram_dice", "address_jaccard", "address_overlap", "address_trigram_dice",
    "address_number_overlap", "country_match", "name_exact", "address_exact", "target_address_missing", "target_is_source2",
)
#: The linear part of the heuristic, for the first eight features.
HEURISTIC = (0.24, 0.18, 0.20, 0.12, 0.08, 0.12, 0.03, 0.03)


def record_features(records: DataFrame) -> DataFrame:
    """entity_id, country and the structs name and address: what a record brings to every pair, made
    once. text is the normal form; tokens, numbers and grams are sets."""
    name, address, country = (T.normalize(F.col(x)) for x in ("business_name", "business_address", "country"))
    of_name = T.let(name, lambda v: F.struct(v.alias("text"), T.useful_tokens(v, drop_legal=True).alias("tokens"), T.grams(v).alias("grams")))
    of_address = T.let(address, lambda v: F.struct(v.alias("text"), T.useful_tokens(v).alias("tokens"), T.number_tokens(v).alias("numbers"), T.grams(v).alias("grams")))
    return records.select("entity_id", country.alias("country"), of_name.alias("name"), of_address.alias("address"))


def feature_columns(q: str = "q", t: str = "t") -> dict[str, Column]:
    """The twelve features of structs q and t."""
    a, b = (lambda c: F.col(f"{q}.{c}")), (lambda c: F.col(f"{t}.{c}"))
    same = lambda c: ((a(c) != "") & (a(c) == b(c))).cast("double")
    both = lambda f, c: f(a(c), b(c))
    values = (
        both(T.jaccard, "name.tokens"), both(T.overlap, "name.tokens"), both(T.dice, "name.grams"), both(T.jaccard, "address.tokens"), both(T.overlap, "address.tokens"),
        both(T.dice, "address.grams"), both(T.overlap, "address.numbers"), same("country"), same("name.text"), same("address.text"), (b("address.text") == "").cast("double"), b("entity_id").startswith("S2-").cast("double"),
    )
    return dict(zip(FEATURES, values, strict=True))


def paired(pairs: DataFrame, rows: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """pairs (query_id, target_id, ...) with structs q and t of rows (record_features()), or of rows for
    queries and targets for targets. Ids are joined first, records are shuffled once a side; a pair whose target is unknown is dropped (see
    missing_targets)."""
    q = rows.select(F.col("entity_id").alias("query_id"), F.struct("*").alias("q"))
    t = (rows if targets is None else targets).select(F.col("entity_id").alias("target_id"), F.struct("*").alias("t"))
    return pairs.join(q, "query_id").join(t, "target_id")


def missing_targets(pairs: DataFrame, records: DataFrame) -> DataFrame:
    return pairs.join(records.select(F.col("entity_id").alias("target_id")), "target_id", "left_anti")


def pair_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """features_of() of records whose features are made on the way."""
    return features_of(pairs, record_features(records))


def features_of(pairs: DataFrame, rows: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """query_id, target_id, rank (where pairs have it), the twelve features, countries_differ, from
    record features."""
    joined = paired(pairs, rows, targets)
    keep = [c for c in ("query_id", "target_id", "rank") if c in pairs.columns]
    differ = ((F.col("q.country") != "") & (F.col("t.country") != "") & (F.col("q.country") != F.col("t.country"))).alias("countries_differ")
    return joined.select(*keep, *[v.alias(k) for k, v in feature_columns().items()], differ)


def with_heuristic_score(features: DataFrame) -> DataFrame:
    """pair_features() with score: linear part, then exact name, exact address, different countries,
    missing address, each on what the one before gives. Each step is a column of its own: nested in
    one another they would double the expression at every step."""
    f = {k: F.col(k) for k in FEATURES}
    linear = f[FEATURES[0]] * F.lit(HEURISTIC[0])
    for k, w in zip(FEATURES[1:8], HEURISTIC[1:], strict=True):
        linear = linear + f[k] * F.lit(w)
    score, strong = F.col("score"), (f["address_jaccard"] >= 0.15) | (f["address_number_overlap"] > 0)
    steps = (
        linear,
        F.when(f["name_exact"] > 0, F.greatest(score, F.when(strong, 0.92).otherwise(0.82))).otherwise(score),
        F.when((f["address_exact"] > 0) & (f["name_overlap"] >= 0.35), F.greatest(score, F.lit(0.90))).otherwise(score),
        F.when(F.col("countries_differ"), score * 0.25).otherwise(score),
        F.when((f["target_address_missing"] > 0) & (f["name_overlap"] < 0.80), score * 0.70).otherwise(score),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)),
    )
    for step in steps:
        features = features.withColumn("score", step)
    return features


def sigmoid(z: Column) -> Column:
    """Stable for either sign; exponents beyond 60 count as 60."""
    up, down = F.exp(-F.least(z, F.lit(60.0))), F.exp(F.greatest(z, F.lit(-60.0)))
    return F.when(z >= 0, 1.0 / (1.0 + up)).otherwise(down / (1.0 + down))


def model_probability(model: dict) -> Column:
    z = F.lit(float(model["bias"]))
    for k, w in zip(FEATURES, model["weights"], strict=True):
        z = z + F.col(k) * F.lit(float(w))
    return sigmoid(z)


def load_model(text: str) -> dict:
    """A model from its JSON; its feature columns must be these, in this order."""
    model = json.loads(text)
    if tuple(model.get("feature_columns", ())) != FEATURES:
        raise ValueError("the model's feature columns are not the scorer's")
    return model


def scored(pairs: DataFrame, records: DataFrame, model: dict | None = None, candidate_limit: int | None = None) -> DataFrame:
    """pair_features() with score: heuristic, or the model's probability; of the first
    candidate_limit candidates of each query."""
    if candidate_limit is not None:
        pairs = pairs.where(F.col("rank") <= candidate_limit)
    return score(pair_features(pairs, records), model)


def score(features: DataFrame, model: dict | None = None) -> DataFrame:
    """features with score: heuristic, or the model's probability."""
    return with_heuristic_score(features) if model is None else features.withColumn("score", model_probability(model))
