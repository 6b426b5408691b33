"""Structured Streaming: case records without repeats, and epiweek aggregates of arriving observations."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Progress reports that a query keeps, so that all of its batches are counted.
_KEPT = "spark.sql.streaming.numRecentProgressUpdates"


def arriving_files(spark: SparkSession, source: str, schema, files: int | None = None) -> DataFrame:
    """The rows of Parquet files as they arrive, of so many files in a batch at most."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(source)


@contextmanager
def _all_progress(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_KEPT)
    spark.conf.set(_KEPT, "1000000")
    try:
        yield
    finally:
        spark.conf.set(_KEPT, before)


def stream_cases(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, key: list[str], ts: str = "ts", delay: str = "60 days", files: int | None = None) -> StreamingQuery:
    """Append records of arriving Parquet files, each key once within the delay (which must exceed that of reporting).

    Keys are kept from batch to batch and over restarts. Records that come later than the delay are left out, and counted
    by late_records().
    """
    arriving = arriving_files(spark, source, schema, files).withColumn(ts, F.col(ts).cast("timestamp"))
    once = arriving.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)
    with _all_progress(spark):
        return once.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def late_records(query: StreamingQuery) -> int:
    """Records that the query left out as they were too late."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def stream_epiweek(observations: DataFrame, delay: str = "7 days", ts: str = "ts") -> DataFrame:
    """zone_id, period_start, n, max, min, mean of a (streaming) table of ts, zone_id, value; weeks run from Sunday 0 h UTC."""
    week = F.window(ts, "7 days", "7 days", "3 days")  # of the column itself: an expression of it would have no watermark
    late = observations.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    out = late.groupBy("zone_id", week.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("max"), F.min("value").alias("min"), F.avg("value").alias("mean"))
    return out.select("zone_id", F.to_date("w.start").alias("period_start"), "n", "max", "min", "mean")


def drain_epiweek(observations: DataFrame, sink: str, checkpoint: str, delay: str = "7 days", ts: str = "ts") -> int:
    """Work off what has arrived and return the number of batches; epiweek_table() has the result, late_observations() what came too late.

    Each batch writes the weeks that it changed to a folder of its own number, so a batch that is repeated after a failure
    replaces itself. How many rows the finished batches saw is written down even if a later one fails.
    """
    spark = observations.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/weeks/batch={number}")

    flow = stream_epiweek(observations, delay, ts).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put)
    with _all_progress(spark):
        query = flow.start()
        try:
            query.awaitTermination()
        finally:
            seen = [(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
            spark.createDataFrame(seen, "batch long, seen long").coalesce(1).write.parquet(f"{sink}/seen/run={uuid.uuid4().hex}")
    return len(seen)


def epiweek_table(spark: SparkSession, sink: str) -> DataFrame:
    """The last state of each zone and week."""
    weeks = spark.read.parquet(f"{sink}/weeks")
    return weeks.groupBy("zone_id", "period_start").agg(F.max_by(F.struct("n", "max", "min", "mean"), "batch").alias("s")).select("zone_id", "period_start", "s.*")


def late_observations(spark: SparkSession, sink: str) -> int:
    """Rows that were seen and are in no week, as their week had been closed: all that were seen less those in the weeks."""
    seen = spark.read.parquet(f"{sink}/seen").groupBy("batch").agg(F.max("seen").alias("n")).agg(F.sum("n")).first()[0] or 0
    return seen - (epiweek_table(spark, sink).agg(F.sum("n")).first()[0] or 0)
