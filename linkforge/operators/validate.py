"""The output rules as queries: each gives the rows that break one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import id_list, id_list_broken


def output_violations(query_ids: DataFrame, target_ids: DataFrame, candidate_lists: DataFrame, match_lists: DataFrame) -> DataFrame:
    """file, source1_entity_id, violation. Rules: one row for each Source-1 id and no other, no
    repeated or empty list elements, only existing targets; matches outside the candidates are a
    warning. query_ids and target_ids have entity_id."""
    out = None
    ids = query_ids.select(F.col("entity_id").alias("source1_entity_id"))
    long = {}
    for name, lists, column in (("candidates", candidate_lists, "candidate_entity_ids"), ("matches", match_lists, "matched_entity_ids")):
        say = lambda df, what, name=name: df.select(F.lit(name).alias("file"), "source1_entity_id", F.lit(what).alias("violation"))
        long[name] = lists.select("source1_entity_id", F.explode(id_list(F.col(column))).alias("target_id"))
        unknown = long[name].join(target_ids.select(F.col("entity_id").alias("target_id")), "target_id", "left_anti")
        rows = (
            say(ids.join(lists, "source1_entity_id", "left_anti"), "missing row").unionAll(say(lists.join(ids, "source1_entity_id", "left_anti"), "unknown source1 id"))
            .unionAll(say(lists.groupBy("source1_entity_id").count().where("count > 1"), "duplicate row")).unionAll(say(lists.where(id_list_broken(F.col(column))), "broken list"))
            .unionAll(say(unknown.select("source1_entity_id").distinct(), "unknown target id"))
        )
        out = rows if out is None else out.unionAll(rows)
    stray = long["matches"].join(long["candidates"], ["source1_entity_id", "target_id"], "left_anti").select("source1_entity_id").distinct()
    return out.unionAll(stray.select(F.lit("matches").alias("file"), "source1_entity_id", F.lit("warning: match is no candidate").alias("violation")))
