"""Jobs: CSV to staging, and staging to the normalised tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fairlead.functions.columns import utc_now
from fairlead.operators.dimensions import update_dimensions
from fairlead.operators.positions import build_positions, id_range
from fairlead.operators.quality import reject_reason, reject_rows
from fairlead.session import local_rows, no_rows, scratch
from fairlead.sources.csv import judged, read_typed
from fairlead.sources.tables import SCHEMAS, Warehouse


def load_csv(
    warehouse: Warehouse,
    path: str | list[str],
    mode: str = "strict",
    load_date: datetime | None = None,
    load_id: str | None = None,
    **options,
) -> int:
    """Load a CSV file or folder as one load; returns the number of rows stored.

    Every call is a load of its own, also with a load_date that was used before. A given
    load_id repeats that load in place of what it had.
    """
    load_date = load_date or utc_now()
    load_id = load_id or f"{load_date:%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:12]}"
    with scratch(warehouse.spark):
        rows = read_typed(warehouse.spark, path, **options)
        return store_lines(warehouse, load_id, load_date, rows, mode)


def store_lines(warehouse: Warehouse, load_id: str, load_date: datetime, rows: DataFrame, mode: str) -> int:
    """Store typed lines as a load in one pass: parsed once, written by verdict, counted on the way."""
    rows = judged(rows, mode, load_date)
    ids = warehouse.reserve_ids(rows.rdd.getNumPartitions())
    return _replace(warehouse, load_id, load_date, lambda attempt: warehouse.write_lines(attempt, rows.withColumn("position_id", ids)))


def store_load(
    warehouse: Warehouse,
    load_id: str,
    load_date: datetime,
    staging: DataFrame,
    rejects: DataFrame | None,
) -> int:
    """Write a load's partitions, then log it. Repeating it replaces the same load.

    A repeat is written beside what it replaces and takes its place when it is logged: from
    then on the positions of the attempt before do not count, and the next update brings the
    new ones in. A repeat that dies before leaves all as it was.
    """
    def write(attempt: str) -> tuple[int, int]:
        warehouse.replace_load("staging", attempt, staging)
        none = no_rows(warehouse.spark, SCHEMAS["rejects"])
        warehouse.replace_load("rejects", attempt, none if rejects is None else rejects)
        written = warehouse.read("staging").filter(F.col("load_id") == attempt)
        return written.agg(F.count(F.lit(1)), F.coalesce(F.max("position_id"), F.lit(0))).first()

    return _replace(warehouse, load_id, load_date, write)


def _replace(warehouse: Warehouse, load_id: str, load_date: datetime, write: Callable[[str], tuple[int, int]]) -> int:
    """Write an attempt at a load, log it, and only then delete what it replaces."""
    with warehouse.snapshot():
        before = warehouse.load(load_id)
        attempt = warehouse.new_attempt(load_id)
    rows, max_id = write(attempt)
    warehouse.log_load(load_date, rows, max_id, attempt, load_id)
    if before is not None:
        for table in ("staging", "rejects", "refused"):
            warehouse.remove(table, [f"load_id={before['attempt']}"])
    return rows


def update_warehouse(warehouse: Warehouse, strict: bool = False) -> tuple[int, int] | None:
    """Bring the loads not yet normalised into ships, statuses and positions.

    Rows that break a rule of the tables are set aside as refused; strict mode fails on them.
    Returns the smallest and largest staging id of those loads, or None without new rows.
    """
    with warehouse.snapshot(), scratch(warehouse.spark):
        return _update(warehouse, strict)


def _update(warehouse: Warehouse, strict: bool) -> tuple[int, int] | None:
    pending = warehouse.pending_loads()
    if not any(load["rows"] for load in pending):
        return None
    # Rows carry the names of the attempts, which their partitions have, too.
    attempts = [load["attempt"] for load in pending]
    names = local_rows(warehouse.spark, {"attempt": attempts}, T.StructType().add("attempt", "string"))
    new = warehouse.attempts(names)
    number = warehouse.next_update()
    refused = reject_rows(new)
    if strict and (first := refused.orderBy("position_id").first()):
        raise ValueError(f"position {first['position_id']}: {first['reason']}")
    warehouse.replace_partitions("refused", refused, ["load_id"])
    ids = id_range(new).first()
    ships, statuses = update_dimensions(
        new, warehouse.read("ships"), warehouse.read("nav_statuses")
    )
    warehouse.append("ships", ships)
    warehouse.append("nav_statuses", statuses)
    fit = new.filter(reject_reason().isNull())
    warehouse.write_positions(
        build_positions(fit, warehouse.read("ships"), warehouse.read("nav_statuses")), number
    )
    warehouse.log_update(pending, number)
    return ids["min_id"], ids["max_id"]
