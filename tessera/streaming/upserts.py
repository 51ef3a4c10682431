"""An extra beyond batch queries: a stream's micro-batches merged into a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.mutate import upsert
from tessera.sources.engine import Engine
from tessera.sources.store import VersionedStore


def upsert_stream(stream: DataFrame, engine: Engine, store: VersionedStore, resource: str, checkpoint: str, **options) -> StreamingQuery:
    """Starts the merge. A batch that is delivered again meets its own rows and changes nothing."""
    table = engine.domain[resource].table

    def merge(batch: DataFrame, number: int) -> None:
        have = store.versions(table)
        done = upsert(engine, resource, batch, **options)
        store.write(table, done.rows, based_on=have[-1][0])

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
