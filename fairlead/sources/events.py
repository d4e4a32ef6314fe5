"""The test tables' `events` read as vessel position reports (FIXTURES.md, section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def staging_from_events(spark: SparkSession, sf_dir: str, *further: str) -> DataFrame:
    """Staging rows, and further columns of the events as they are."""
    event, user = F.col("event_id"), F.col("user_id")
    midnight = F.col("ts").cast("date").cast("timestamp_ntz")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        (event + 1).alias("position_id"),
        F.col("ts").cast("timestamp_ntz").alias("gps_timestamp"),
        (F.lit(200_000_000) + user).cast("string").alias("mmsi"),
        F.when(
            event % 101 != 0,
            (user % 1800).cast("double") / 10 - 90 + (event % 7).cast("double") / 100,
        ).alias("latitude"),
        ((event % 3600).cast("double") / 10 - 180).alias("longitude"),
        F.when(F.col("event_type") == "error", "Moored")
        .when(F.col("event_type") == "signup", "At anchor")
        .otherwise("Engine")
        .alias("nav_status"),
        F.col("value").alias("speed_over_ground"),
        F.when(event % 17 != 0, (event % 360).cast("double")).alias("heading"),
        ((event * 7) % 360).cast("double").alias("course_over_ground"),
        (midnight + F.expr("INTERVAL '1' DAY")).alias("load_date"),
        *further,
    )
