"""Incremental runs as streams: new files of sections become mentions, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json", max_files: int = 1000) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)


def run_incremental(sections: DataFrame, make: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Writes ``make`` of each batch of new ``sections`` to ``out``/batch=<id>; a batch that is run again replaces its own
    folder, so results appear exactly once. Ends when all files that are there have been taken."""

    def sink(batch: DataFrame, number: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return sections.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
