"""Score and scan files as they arrive.

Text, maths, JSON and rubric functions hold no state, so they run on a streaming
frame as they are. Each run takes the files that are new since the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_files(spark: SparkSession, path: str, schema, max_files: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def run_available(
    stream: DataFrame, operator: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Apply a stateless operator to everything available now and append the result as Parquet."""
    return (
        operator(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
