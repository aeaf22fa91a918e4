"""Incremental load: new files of documents are parsed as they arrive, once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from codexmill.sources.store import Store


def stream_into(spark: SparkSession, folder: str, schema, store: Store, parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]], checkpoint: str) -> StreamingQuery:
    """Parse each batch of ``folder`` with ``parse`` (giving nodes and document ids) and append it to the store.

    A repeated batch appends nothing: the store skips documents that are complete.
    """

    def write(batch: DataFrame, _: int) -> None:
        nodes, docs = parse(batch)
        store.load_nodes(nodes, docs, resume=True)

    source = spark.readStream.schema(schema).parquet(folder)
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
