"""CSV files that keep arriving in a folder, loaded as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from fairlead.functions.columns import utc_now
from fairlead.plans.warehouse import store_lines
from fairlead.schemas import CSV_COLUMNS
from fairlead.session import scratch
from fairlead.sources.csv import RAW_LINE, _options, configure, file_headers, parse_lines, text_lines, typed
from fairlead.sources.tables import Warehouse


def stream_csv(
    warehouse: Warehouse,
    folder: str,
    checkpoint: str,
    mode: str = "lenient",
    columns: list[str] | None = None,
    timestamp_format: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Load all files of the folder that the checkpoint has not seen, then stop.

    Every file's own header says where its columns are; with `columns`, the header of all files,
    the files are checked against it instead. Each micro-batch is one load, named after the
    stream (the id that its checkpoint keeps) and its batch number, so that a batch repeated
    after a failure replaces its own rows, or is skipped when it was stored completely, and no
    two streams share a name.
    """
    spark = warehouse.spark
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if columns:
        lines = configure(spark, reader, folder, columns).csv(folder)
        lines = lines.select(*CSV_COLUMNS, RAW_LINE).withColumnsRenamed(CSV_COLUMNS)
    else:
        lines = text_lines(_options(spark, reader, folder).text(folder))

    def store(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("the stream's id is unknown")
        load_id = f"{stream}-batch-{number:012d}"
        if warehouse.load(load_id) is not None:
            return
        with scratch(spark):
            rows = batch if columns else parse_lines(batch, file_headers(batch))
            store_lines(warehouse, load_id, utc_now(), typed(rows, timestamp_format), mode)

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
