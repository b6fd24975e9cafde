"""Blocking: weighted keys, block purge, key join, top-k candidates of each query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import Scratch, materialize

#: What a shared key of each family adds to a candidate's score.
KEY_WEIGHTS = {"name": 5, "address": 5, "pair": 3, "postal": 2, "number": 2, "locality": 2, "addressnum": 2, "prefixaddr": 1}


@dataclass(frozen=True)
class Blocking:
    max_block_size: int | None = 1000
    max_candidates: int | None = 200
    order: str = "rank"

    def __post_init__(self) -> None:
        if (self.max_block_size is not None and self.max_block_size < 1) or (self.max_candidates is not None and self.max_candidates < 1):
            raise ValueError("max_block_size and max_candidates must be positive")
        if self.order not in ("rank", "id"):
            raise ValueError(f"unknown order {self.order}")


def parts_of(records: DataFrame) -> Column:
    """The normalized parts that keys are made of: c, nt, at, numbers, postal, locality."""
    name, address, country = (T.normalize(F.col(x)) for x in ("business_name", "business_address", "country"))
    numbers = lambda at: F.struct(at.alias("at"), T.house_numbers(at).alias("numbers"), T.postal_codes(at).alias("postal"), T.localities(at).alias("locality"))
    return F.struct(country.alias("c"), T.name_tokens(name).alias("nt"), T.let(T.address_tokens(address), numbers).alias("a"))


def parts(records: DataFrame) -> DataFrame:
    """entity_id, c, nt, at, numbers, postal, locality."""
    return records.select("entity_id", parts_of(records).alias("p")).select("entity_id", "p.c", "p.nt", "p.a.*")


def key_array(p: Column) -> Column:
    """All keys of a record's parts, distinct and sorted; none without country or name token."""
    c, nt, at = p["c"], p["nt"], p["a"]["at"]
    numbers, postal, locality, first = p["a"]["numbers"], p["a"]["postal"], p["a"]["locality"], F.get(nt, F.lit(0))
    key = lambda family, *body: F.concat(c, F.lit(f"|{family}|"), *body)
    bag = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), " ")
    with_first = lambda family, a: F.transform(F.slice(a, 1, 2), lambda x: key(family, first, F.lit("|"), x))
    none = F.array().cast("array<string>")
    pairs = F.flatten(F.transform(F.slice(nt, 1, 3), lambda x, i: F.transform(F.slice(nt, i + 2, F.lit(3) - i), lambda y: key("pair", F.least(x, y), F.lit("|"), F.greatest(x, y)))))
    crossed = F.flatten(F.transform(F.slice(numbers, 1, 3), lambda n: F.transform(F.slice(locality, 1, 3), lambda t: key("addressnum", n, F.lit("|"), t))))
    families = [
        F.array(key("name", bag(nt))), pairs, with_first("postal", postal), with_first("number", numbers), with_first("locality", locality),
        F.when(F.size(at) > 0, F.array(key("address", bag(at)))).otherwise(none), crossed,
        F.when((F.char_length(first) >= 4) & (F.size(at) > 0), F.array(key("prefixaddr", F.substring(first, 1, 4), F.lit("|"), F.substring(F.get(at, F.lit(0)), 1, 4)))).otherwise(none),
    ]
    return F.when((c != "") & (F.size(nt) > 0), F.array_sort(F.array_distinct(F.concat(*families)))).otherwise(none)


def block_keys(records: DataFrame) -> DataFrame:
    """entity_id, block_keys (array) for every record."""
    return records.select("entity_id", T.let(parts_of(records), key_array).alias("block_keys"))


def exploded_keys(records: DataFrame) -> DataFrame:
    """entity_id, key, family, weight: a row a key."""
    # An outer explode, since a plain one lets the planner compute the keys twice: for a filter on their number.
    keys = block_keys(records).select("entity_id", F.explode_outer("block_keys").alias("key")).where("key is not null")
    weights = F.create_map(*[F.lit(x) for kv in KEY_WEIGHTS.items() for x in kv])
    return keys.withColumn("family", F.element_at(F.split("key", r"\|"), 2)).withColumn("weight", F.element_at(weights, F.col("family")).cast("long"))


def sources(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries, targets): Source 1, and the union of Sources 2 and 3."""
    return records.where(F.col("entity_id").startswith("S1-")), records.where(F.col("entity_id").startswith("S2-") | F.col("entity_id").startswith("S3-"))


def block_sizes(index: DataFrame) -> DataFrame:
    return index.groupBy("key").agg(F.count("*").alias("block_size"))


def purged(index: DataFrame, max_block_size: int | None) -> DataFrame:
    """index (entity_id, key) without keys of more entries than that. The size is counted with map-side
    combine and joined back, so a block of any size is split like any skewed join, then dropped before
    it can meet a query."""
    if max_block_size is None:
        return index
    keep = block_sizes(index).where(F.col("block_size") <= max_block_size).select("key")
    return index.join(keep, "key", "left_semi")


def semi_reduced(index: DataFrame, query_keys: DataFrame) -> DataFrame:
    """Entries of keys that some query has."""
    return index.join(query_keys.select("key").distinct(), "key", "left_semi")


def skipped_instances(query_keys: DataFrame, index: DataFrame, max_block_size: int) -> DataFrame:
    """skipped_keys: how many keys of queries meet a purged block."""
    large = block_sizes(index).where(F.col("block_size") > max_block_size).select("key")
    return query_keys.join(large, "key").agg(F.count("*").alias("skipped_keys"))


def candidate_scores(query_keys: DataFrame, index: DataFrame, max_block_size: int | None) -> DataFrame:
    """query_id, target_id, score: the summed weights of the keys that both have. After the purge the
    rows made are at most max_block_size a query key."""
    left = query_keys.select(F.col("entity_id").alias("query_id"), "key", "weight")
    right = purged(index, max_block_size).select(F.col("entity_id").alias("target_id"), "key")
    return left.join(right, "key").groupBy("query_id", "target_id").agg(F.sum("weight").alias("score"))


def ranked(scores: DataFrame, max_candidates: int | None) -> DataFrame:
    """scores with rank by score and then id, both descending; at most max_candidates a query."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("target_id"))
    rows = scores.withColumn("rank", F.row_number().over(order))
    return rows if max_candidates is None else rows.where(F.col("rank") <= max_candidates)


def key_classes(keys: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(entity_id, class) of every entity of keys (entity_id, key, weight), and the keys (class, key,
    weight) of every class: entities of equal keys are one. Repeated rows count once; key sets are
    equal if their SHA-256 is."""
    own = keys.groupBy("entity_id").agg(F.array_sort(F.collect_set(F.struct("key", "weight"))).alias("keys"))
    own = scratch(own.select("entity_id", "keys", F.unhex(F.sha2(F.to_json("keys"), 256)).alias("sha")), "key_sets")
    # The numbers hold once they are written.
    classes = scratch(own.groupBy("sha").agg(F.first("keys").alias("keys")).withColumn("class", F.monotonically_increasing_id()), "classes")
    return own.select("entity_id", "sha").join(classes.select("sha", "class"), "sha").select("entity_id", "class"), classes.select("class", F.explode("keys").alias("k")).select("class", "k.key", "k.weight")


def ranked_unpurged(query_keys: DataFrame, index: DataFrame, max_candidates: int | None) -> DataFrame:
    """What ranked(candidate_scores(query_keys, index, None), max_candidates) gives, for rows without
    repeats. Blocks of any size give as many pairs as queries times targets; to shuffle fewer, pairs are
    scored once for two classes of equal keys, and ranked once for a class of queries. Its queries meet
    that ranking last, so that what is shuffled is never larger than the rankings of the classes."""
    with Scratch(query_keys.sparkSession) as scratch:
        queries, left = key_classes(query_keys.select("entity_id", "key", "weight"), scratch)
        targets, right = key_classes(index.select("entity_id", "key", F.lit(0).alias("weight")), scratch)
        pairs = left.join(right.select(F.col("class").alias("t_"), "key"), "key").groupBy("class", "t_").agg(F.sum("weight").alias("score"))
        pairs = materialize(pairs, "class_pairs")
        queries, targets = materialize(queries, "query_classes"), materialize(targets, "target_classes")
    scores = pairs.join(targets.select(F.col("entity_id").alias("target_id"), F.col("class").alias("t_")), "t_").select(F.col("class").alias("query_id"), "target_id", "score")
    rows = ranked(scores, max_candidates).withColumnRenamed("query_id", "class")
    return queries.withColumnRenamed("entity_id", "query_id").join(rows, "class").select("query_id", "target_id", "score", "rank")


def candidates(records: DataFrame, config: Blocking = Blocking()) -> DataFrame:
    """query_id, target_id, score, rank."""
    queries, targets = sources(records)
    if config.max_block_size is None:
        return ranked_unpurged(exploded_keys(queries), exploded_keys(targets), config.max_candidates)
    return ranked(candidate_scores(exploded_keys(queries), exploded_keys(targets), config.max_block_size), config.max_candidates)


def candidate_lists(query_ids: DataFrame, found: DataFrame, order: str = "rank") -> DataFrame:
    """source1_entity_id, candidate_entity_ids: a row a query, empty for those without candidates;
    by rank, or by id. A query has at most max_candidates of them, so lists are bounded."""
    by = F.struct(F.col("rank") if order == "rank" else F.col("target_id"), F.col("target_id").alias("id"))
    lists = found.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(by)), lambda x: x["id"]), ",").alias("ids"))
    return query_ids.select(F.col("entity_id").alias("source1_entity_id")).join(lists, F.col("source1_entity_id") == F.col("query_id"), "left").select("source1_entity_id", F.coalesce("ids", F.lit("")).alias("candidate_entity_ids"))


def blocking_stats(queries: DataFrame, q: DataFrame, index: DataFrame, config: Blocking) -> DataFrame:
    """One row: queries, with_candidates, candidate_links, skipped_keys, capped_queries; q and index are
    the exploded keys of queries and targets."""
    scores = candidate_scores(q, index, config.max_block_size).groupBy("query_id").agg(F.count("*").alias("n"))
    cap = F.lit(config.max_candidates if config.max_candidates is not None else (1 << 31) - 1)
    per = scores.agg(F.count("*").alias("with_candidates"), F.coalesce(F.sum(F.least("n", cap)), F.lit(0)).alias("candidate_links"), F.count(F.when(F.col("n") > cap, 1)).alias("capped_queries"))
    skipped = skipped_instances(q, index, config.max_block_size if config.max_block_size is not None else (1 << 62))
    return queries.agg(F.count("*").alias("queries")).join(per, F.lit(True)).join(skipped, F.lit(True))
