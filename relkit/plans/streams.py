"""Event-time aggregation over files that keep arriving, with Structured
Streaming.

The stream reads new files of a folder, adds events up per window and
type, and writes each window once, when the watermark has passed its end
(append mode into a Parquet sink, whose log makes a file count exactly
once).  Progress and state are in the checkpoint folder: a stream that is
started again goes on where the last run ended.  Events later than the
watermark's delay may come too late for a window already written and are
then dropped, as Spark defines it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relkit.functions import money
from relkit.operators.timeline import micros
from relkit.session import ensure_checkpoint_dir, output_dir
from relkit.sources import Tables
from relkit.sources.tables import SCHEMAS

TOTALS_SCHEMA = "day timestamp_ntz, event_type string, n_events bigint, total_value double"
WINDOW, DELAY = "1 day", "1 hour"


def _instant(ts: str) -> Column:
    """A clock reading without zone, taken as UTC: event time needs an
    instant, and the session's zone must not shift windows."""
    return F.timestamp_micros(micros(ts))


def _reading(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))


def totals(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """Events and value per window and type, for tables and streams."""
    return (events.where(F.col("at").isNotNull()).groupBy(F.window("at", window).alias("w"), "event_type")
                  .agg(F.count(F.lit(1)).alias("n_events"), money(F.sum("value")).alias("total_value"))
                  .select(_reading(F.col("w.start")).alias("day"), "event_type", "n_events", "total_value"))


def stream_totals(spark: SparkSession, source: str, out: str, checkpoint: str, window: str = WINDOW,
                  delay: str = DELAY, files_per_batch: int | None = None) -> DataFrame:
    """Takes in the files that ``source`` (a folder or a pattern) holds now
    and were not yet read, and returns all windows written to ``out`` so far."""
    reader = spark.readStream.schema(SCHEMAS["events"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(source).withColumn("at", _instant("ts")).withWatermark("at", delay)
    query = (totals(events, window).writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(TOTALS_SCHEMA).parquet(out)


def daily_totals_plan(t: Tables) -> DataFrame:
    """The same totals of the whole table in one batch: all days."""
    return totals(t.events.withColumn("at", _instant("ts")))


def daily_totals(t: Tables) -> DataFrame:
    """The events table as a stream, drained: the days that ended at least
    the delay before the last event."""
    run, path = uuid.uuid4().hex, t.path("events")
    # A pattern may stand for a folder of files or, as here, for one file.
    return stream_totals(t.spark, f"{path[:-1]}[{path[-1]}]", f"{output_dir(t.spark)}/daily_totals_{t.token}/{run}",
                         f"{ensure_checkpoint_dir(t.spark)}/daily-totals-{run}")
