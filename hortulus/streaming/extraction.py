"""Extraction of documents as they arrive: documents are independent, so each micro-batch is a whole run over its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from hortulus.plans.extract import Options, extract

LINES = "doc long, line_nr int, raw string, filename string, garden_code string, year int"


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of lines; a document must lie in one file."""
    return spark.readStream.schema(LINES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def extract_stream(lines: DataFrame, names: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, options: Options = Options()) -> StreamingQuery:
    """Starts a query that hands the rows of each micro-batch to `sink` with the number of the batch; a sink that overwrites by
    that number makes the run exactly-once."""

    def run(batch: DataFrame, number: int) -> None:
        sink(extract(batch, names, options), number)

    return lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
