"""Column names and types of the tables, and the header names of the CSV input."""

from __future__ import annotations

from pyspark.sql import types as T

# CSV header -> staging column.
CSV_COLUMNS = {
    "Base station time stamp": "gps_timestamp",
    "Course over ground": "course_over_ground",
    "Heading": "heading",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "MMSI": "mmsi",
    "Navigational status (text)": "nav_status",
    "Speed over ground": "speed_over_ground",
}

MMSI_LENGTH = 20

MEASURES = ["speed_over_ground", "heading", "course_over_ground"]

STAGING = T.StructType(
    [
        T.StructField("position_id", T.LongType(), False),
        T.StructField("gps_timestamp", T.TimestampNTZType()),
        T.StructField("mmsi", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("nav_status", T.StringType()),
        T.StructField("speed_over_ground", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("course_over_ground", T.DoubleType()),
        T.StructField("load_date", T.TimestampNTZType()),
    ]
)

SHIPS = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("mmsi", T.StringType())]
)

NAV_STATUSES = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("nav_status", T.StringType())]
)

POSITIONS = T.StructType(
    [
        T.StructField("position_id", T.LongType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("ship_id", T.LongType()),
        T.StructField("gps_timestamp", T.TimestampNTZType()),
        T.StructField("nav_status_id", T.LongType()),
        T.StructField("speed_over_ground", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("course_over_ground", T.DoubleType()),
        T.StructField("load_date", T.TimestampNTZType()),
    ]
)

LIMITS = T.StructType(
    [
        T.StructField("ship_id", T.LongType()),
        T.StructField("datetime_start", T.TimestampNTZType()),
        T.StructField("datetime_stop", T.TimestampNTZType()),
        T.StructField("is_open", T.BooleanType()),
    ]
)
