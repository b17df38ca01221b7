"""Incremental conformance with Structured Streaming.

New retailer export files land in a folder; each micro-batch is parsed with
the landed schema (explicit, never inferred), resolved against the current
description mapping (a stream-static left join: no state is kept) and
appended to the conformed sales fact.  Progress lives in the checkpoint
folder, so a restarted or failed query resumes exactly where it stopped and
never appends a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from confluo.plans.star import DIMENSIONS, FACTS, SALES_SCHEMA, Conformer


def retailer_sales_stream(conformer: Conformer, landing_dir: str,
                          max_files_per_trigger: int = 64) -> DataFrame:
    """Streaming DataFrame of conformed sales rows from CSV files under ``landing_dir``."""
    spark = conformer.spark
    schema = conformer.landed.rt_sales.schema
    src = (spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST")
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(landing_dir))
    return conformer.conform("retailer_sales", SALES_SCHEMA, src)


def start_append(stream: DataFrame, output_dir: str, checkpoint_dir: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append to parquet, partitioned by month like the batch fact.  The folder is
    the stream's own: a written star's tables are overwritten whole."""
    from pyspark.sql import functions as F
    if output_dir.rstrip("/").rsplit("/", 1)[-1] in DIMENSIONS + FACTS:
        raise ValueError(f"{output_dir} is named like a star's table, which write_star overwrites; append elsewhere")
    w = (stream.withColumn("month_key", F.expr("date_key div 100").cast("int"))
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir).partitionBy("month_key"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(output_dir)
