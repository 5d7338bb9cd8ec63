"""Incremental ingestion: new record files in, rows of unseen ids appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textpanel.sources.sinks import append_resumable


def follow(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: str = "risk_id", form: str = "json") -> StreamingQuery:
    """Takes up the files that are new in `source` and appends rows whose key `target` doesn't hold; a batch that is run again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        append_resumable(batch, target, key)

    stream = spark.readStream.schema(schema).format(form).load(source)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
