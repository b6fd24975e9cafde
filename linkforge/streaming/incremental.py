"""New Source-1 records as a stream against the persisted block index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.blocking import exploded_keys
from ..sources.index import candidates


def link_stream(records: DataFrame, blocks: DataFrame, place: str, checkpoint: str, max_block_size: int = 1000, max_candidates: int = 200) -> StreamingQuery:
    """Write the candidates of each micro-batch of records to place/batch=N. A batch that is run
    again overwrites its own folder, so each record's candidates are there once."""

    def each(batch: DataFrame, number: int) -> None:
        candidates(exploded_keys(batch), blocks, max_block_size, max_candidates).write.mode("overwrite").parquet(f"{place}/batch={number}")

    return records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
