"""Streams and runs over a growing input, worked off in parts and compared with the same over all rows at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.queries import views as v
from geohealth.queries.registry import query
from geohealth.sources import ledger
from geohealth.sources.scratch import scratch_folder
from geohealth.streaming import streams

#: Days of a slice of arrivals, by how many days rows are out of order at most, and the delay that allows for both.
SLICE, DISORDER, DELAY = 30, 5, "60 days"


def _folder(spark, name: str) -> str:
    """A name in the shared folder, deleted with all beside it when the application ends."""
    return f"{scratch_folder(spark, name)}/{name}"


def _arrivals(spark, d, source: str, start: int, end: int):
    """Events as they arrive: a slice of days after the other, out of order within DISORDER days, each in files by hash."""
    e = v.table(spark, d, "events")
    first, last = e.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    slices = ((last - first).days + DISORDER) // SLICE + 1
    place = F.floor((F.date_diff(F.to_date("ts"), F.lit(first)) + F.pmod(F.xxhash64("event_id"), F.lit(DISORDER + 1))) / SLICE)
    for k in range(slices * start // 2, slices * end // 2):
        e.where(place == k).repartition(2, "event_id").write.mode("append").parquet(source)


def _in_two_parts(spark, d, name: str, drain) -> str:
    """Half of the arrivals are worked off, then the query starts again from its checkpoint with the rest."""
    source, sink = _folder(spark, "arrivals"), _folder(spark, name)
    schema = v.table(spark, d, "events").schema
    for half in (0, 1):
        _arrivals(spark, d, source, half, half + 1)
        drain(source, schema, sink, sink + "-checkpoint")
    return sink


@query("stream_cases", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT event_id, user_id, event_type FROM events) GROUP BY ALL")
def stream_cases(spark, d):
    """Events appended once each, in many small batches and over a restart."""
    def drain(source, schema, sink, checkpoint):
        streams.stream_cases(spark, source, schema, sink, checkpoint, ["event_id"], delay=DELAY, files=3).awaitTermination()

    sink = _in_two_parts(spark, d, "cases", drain)
    return spark.read.parquet(sink).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_epiweek", f"WITH {v.SQL_OBS} SELECT zone_id, {v.sql_sunday('day')} AS period_start, count(*) AS n, max(value) AS max, min(value) AS min, {v.sql_r4('avg(value)')} AS mean FROM obs GROUP BY ALL")
def stream_epiweek(spark, d):
    """Weekly aggregates that change from batch to batch and over a restart; the last state of each week and zone is kept."""
    def drain(source, schema, sink, checkpoint):
        streams.drain_epiweek(streams.arriving_files(spark, source, schema, 3).withColumn("zone_id", F.col("user_id") % 25), sink, checkpoint, DELAY)

    sink = _in_two_parts(spark, d, "epiweek", drain)
    return streams.epiweek_table(spark, sink).select("zone_id", "period_start", "n", "max", "min", v.r4(F.col("mean")).alias("mean"))


@query("incremental_runs", "SELECT o_orderkey AS item, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS run, round(o_totalprice * 2, 2) AS value, count(*) AS n FROM orders GROUP BY ALL")
def incremental_runs(spark, d):
    """Orders of which a third is there at first; the second run takes the others only, the third finds nothing new."""
    path = _folder(spark, "runs")
    orders = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("item"), "o_totalprice")
    for there in (orders.where("item % 3 = 0"), orders, orders):
        ledger.run_pending(there, path, lambda df: df.select("item", F.round(F.col("o_totalprice") * 2, 2).alias("value")))
    return ledger.read_output(spark, path).groupBy("item", "run", "value").agg(F.count(F.lit(1)).alias("n"))
