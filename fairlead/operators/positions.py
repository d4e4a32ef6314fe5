"""Staging rows to normalised positions, and the marks that drive increments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.columns import ntz
from fairlead.operators.detect import last_stops
from fairlead.operators.keys import Sized, lookup
from fairlead.schemas import MEASURES


def load_mark(positions: DataFrame) -> datetime | None:
    """Latest load among the positions; None when there are none."""
    return positions.agg(F.max("load_date")).first()[0]


def new_rows(staging: DataFrame, mark: datetime | None) -> DataFrame:
    """Staging rows of loads after the mark; all of them without a mark."""
    if mark is None:
        return staging
    return staging.filter(F.col("load_date") > ntz(mark))


def id_range(rows: DataFrame) -> DataFrame:
    """Smallest and largest position_id, NULL for no rows."""
    return rows.agg(
        F.min("position_id").alias("min_id"), F.max("position_id").alias("max_id")
    )


def build_positions(
    staging: DataFrame,
    ships: DataFrame | Sized,
    statuses: DataFrame | Sized,
    ids: tuple[int, int] | None = None,
    strict: bool = False,
    **joining,
) -> DataFrame:
    """Normalise staging rows, optionally those with ids in an inclusive range.

    A row without both coordinates has no point and is left out; strict mode fails on it.
    `joining` sets the sizes of keys.lookup, broadcast_rows and limit.
    """
    rows = staging if ids is None else staging.filter(F.col("position_id").between(*ids))
    no_point = F.col("longitude").isNull() | F.col("latitude").isNull()
    if strict:
        refused = F.raise_error(F.concat(F.lit("no point: position "), F.col("position_id")))
        rows = rows.filter(F.when(no_point, refused.cast("boolean")).otherwise(F.lit(True)))
    else:
        rows = rows.filter(~no_point)
    rows = lookup(rows, ships.select(F.col("id").alias("ship_id"), "mmsi"), "mmsi", **joining)
    named = statuses.select(F.col("id").alias("nav_status_id"), "nav_status")
    rows = lookup(rows, named, "nav_status", **joining)
    return rows.select(
        "position_id",
        "longitude",
        "latitude",
        "ship_id",
        "gps_timestamp",
        "nav_status_id",
        *MEASURES,
        "load_date",
        *[c for c in ["load_id"] if c in rows.columns],
    )


def late_positions(positions: DataFrame, limits: DataFrame, mark: datetime) -> DataFrame:
    """Newly loaded reports that no increment will read: at or before the last closed stop."""
    rows = lookup(new_rows(positions, mark), last_stops(limits), "ship_id", how="inner")
    return rows.filter(F.col("gps_timestamp") <= F.col("settled_until")).select(
        "ship_id", "position_id", "gps_timestamp"
    )
