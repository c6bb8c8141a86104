"""Arriving page revisions, as a batch and as a stream.

The model has no event-time operators of its own; what streams is the
resumable intake of segments and revisions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Days after a snapshot from which an arrival is late.
LATE_DAYS = 3


def latest_revisions(arrivals: DataFrame) -> DataFrame:
    """Rows ``(page_id, revision_id, snapshot_id, deliveries)``: the last revision of each page and how often it came.

    The latest snapshot wins, then the greatest revision; repeated rows count
    once, pages without an identifier are left out.  A maximum per page needs
    no window, so a page with very many deliveries is reduced before the
    exchange.
    """
    rows = arrivals.select("page_id", "revision_id", "snapshot_id").where("page_id is not null").distinct()
    last = F.max(F.struct("snapshot_id", "revision_id"))
    return rows.groupBy("page_id").agg(last.alias("last"), F.count(F.lit(1)).alias("deliveries")).select(
        "page_id", F.col("last.revision_id").alias("revision_id"), F.col("last.snapshot_id").alias("snapshot_id"), "deliveries"
    )


def arrival_summary(arrivals: DataFrame, late_days: int = LATE_DAYS) -> DataFrame:
    """Rows ``(snapshot_id, deliveries, pages, undated, late)`` of each snapshot."""
    opened = F.to_timestamp("snapshot_id", "yyyyMMdd")
    return (
        arrivals.where("snapshot_id is not null")
        .groupBy("snapshot_id")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.countDistinct("page_id").alias("pages"),
            F.count_if(F.col("arrived_at").isNull()).alias("undated"),
            F.count_if(F.col("arrived_at") >= opened + F.make_interval(days=F.lit(late_days))).alias("late"),
        )
    )


def arrival_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream over Parquet files as they come into a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def windowed_arrivals(stream: DataFrame, window: str = "1 day", delay: str = "21 days") -> DataFrame:
    """Deliveries of each snapshot by window of arrival, closed once the watermark has passed; undated ones are left out."""
    return (
        stream.where("arrived_at is not null")
        .withWatermark("arrived_at", delay)
        .groupBy(F.window("arrived_at", window), "snapshot_id")
        .agg(F.count(F.lit(1)).alias("deliveries"), F.approx_count_distinct("page_id").alias("pages"))
    )


def first_deliveries(stream: DataFrame, delay: str = "21 days") -> DataFrame:
    """Each revision of a page once, repeats within the watermark dropped."""
    return stream.where("arrived_at is not null").withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["page_id", "revision_id", "snapshot_id"])


def take_in(stream: DataFrame, state_folder: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand all that has arrived to ``handle`` in batches, once each over restarts, and stop."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", state_folder).trigger(availableNow=True).start()
    query.awaitTermination()
