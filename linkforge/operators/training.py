"""Labelled pairs, class samples, logistic fit and tuning."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_holdout
from ..sources.shared import materialize
from . import evaluate
from .features import FEATURES, model_probability, sigmoid


def labelled_pairs(features: DataFrame, truth: DataFrame) -> DataFrame:
    """features with label (1: a true link) and holdout."""
    links = truth.select("query_id", "target_id").distinct().withColumn("true_", F.lit(1))
    return features.join(links, ["query_id", "target_id"], "left").withColumn("label", F.coalesce("true_", F.lit(0))).withColumn("holdout", is_holdout(F.col("query_id"))).drop("true_")


def class_sample(labelled: DataFrame, per_class: int, seed: str = "") -> DataFrame:
    """The per_class pairs of each label with the lowest hash of seed and ids: exact, reproducible,
    and cut within each task before the shuffle."""
    order = F.sha2(F.concat_ws("|", F.lit(seed), "query_id", "target_id").cast("binary"), 256)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("sample_key", "query_id", "target_id"))
    return labelled.withColumn("sample_key", order).withColumn("sample_rank", rank).where(F.col("sample_rank") <= per_class)


def fit_logistic(sample: DataFrame, l2: float = 0.01, rounds: int = 25, close: float = 1e-10) -> tuple[float, list[float]]:
    """(bias, weights) that minimize the mean logistic loss plus l2 / 2 times the squared weights, the
    bias free. Newton steps: each is one aggregate over the executors, of as many numbers as pairs of
    features, so the sample may be of any size. Without rows all are 0."""
    names, n = [*FEATURES, "one"], len(FEATURES) + 1
    rows = sample.select(*[F.col(c).cast("double").alias(c) for c in FEATURES], F.lit(1.0).alias("one"), F.col("label").cast("double").alias("label"))
    w = np.zeros(n)
    penalty = np.r_[np.full(n - 1, l2), 0.0]
    for _ in range(rounds):
        z = reduce(add, [F.col(c) * F.lit(float(x)) for c, x in zip(names, w, strict=True)])
        at = rows.withColumn("p", sigmoid(z)).withColumn("v", F.col("p") * (1 - F.col("p")))
        sums = at.agg(F.count("*"), *[F.sum((F.col("p") - F.col("label")) * F.col(c)) for c in names], *[F.sum(F.col("v") * F.col(names[i]) * F.col(names[j])) for i in range(n) for j in range(i + 1)]).first()
        if not sums[0]:
            break
        gradient, curve = np.array(sums[1 : n + 1]) / sums[0] + penalty * w, np.zeros((n, n))
        curve[np.tril_indices(n)] = np.array(sums[n + 1 :]) / sums[0]
        curve += np.tril(curve, -1).T + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, gradient)
        # Far from the optimum a whole step can overshoot.
        w = w - step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < close:
            break
    return float(w[-1]), w[:-1].tolist()


def train(features: DataFrame, truth: DataFrame, entities: DataFrame, per_class: int = 200_000, thresholds: Sequence[float] = (), seed: str = "train") -> dict:
    """Fit on pairs outside the holdout, tune threshold, cap and gate on the holdout, fit again on
    both, and return the model as written by write_model()."""
    labelled = labelled_pairs(features, truth)
    train_sample, held = materialize(class_sample(labelled.where("not holdout"), per_class, seed), "sample"), labelled.where("holdout")
    bias, weights = fit_logistic(train_sample)
    scored = held.withColumn("score", model_probability({"bias": bias, "weights": weights}))
    results = evaluate.tune(entities.where(is_holdout(F.col("query_id"))), truth, scored, thresholds or evaluate.even_values(0.50, 0.95, 0.05), evaluate.LIMITS, evaluate.GATES)
    best = [r.asDict() for r in evaluate.best_tuned(results).collect()]
    if not best:
        raise ValueError("no entity is held out")
    everything = materialize(train_sample.unionByName(class_sample(held, per_class, seed)), "sample")
    bias, weights = fit_logistic(everything)
    counts = {str(r.label): r["count"] for r in everything.groupBy("label").count().collect()}
    top = best[0]
    return {
        "model": "logistic_regression", "feature_columns": list(FEATURES), "bias": bias, "weights": weights, "threshold": top["threshold"],
        "max_matches": None if top["max_matches"] == evaluate.NONE else top["max_matches"], "min_query_probability": None if top["gate"] < 0 else top["gate"],
        "holdout": best, "sample": counts,
    }


def model_json(model: dict) -> str:
    return json.dumps(model, indent=2, sort_keys=True)
