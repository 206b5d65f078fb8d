"""The keyed upsert, fed by micro-batches instead of one batch per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.writers import upsert


def upsert_stream(batches: DataFrame, path: str, key: str, order: Column, checkpoint: str) -> StreamingQuery:
    """Upsert every available micro-batch into a keyed table.

    A batch that is replayed after a failure upserts the same rows again and changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        upsert(batch, path, key, order)

    return (
        batches.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
