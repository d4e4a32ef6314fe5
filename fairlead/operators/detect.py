"""Voyage detection: status changes and reporting gaps, paired into start and stop times."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions.columns import ACTIVE_STATUS, GAP_SECONDS, flag, micros, open_end
from fairlead.operators.keys import Sized, lookup
from fairlead.operators.slices import Slicing, plan_slices
from fairlead.schemas import LIMITS
from fairlead.session import stored

REPORT = ["ship_id", "gps_timestamp", "position_id"]
IN_TIME = ["gps_timestamp", "position_id"]


def gap_interval(gap_seconds: int) -> Column:
    return F.lit(timedelta(seconds=gap_seconds))


def with_status(positions: DataFrame, statuses: DataFrame | Sized, measures: tuple[str, ...] = ()) -> DataFrame:
    """Reports of known ships with their status text; columns but the named ones are left out."""
    named = statuses.select(F.col("id").alias("nav_status_id"), "nav_status")
    kept = [c for c in [*REPORT, "load_date", "settled_until", "fresh", "opens", *measures] if c in positions.columns]
    return lookup(
        positions.filter(F.col("ship_id").isNotNull()).select(*kept, "nav_status_id"),
        named,
        "nav_status_id",
    ).drop("nav_status_id")


def deltas(reports: DataFrame, slicing: Slicing | None = None) -> DataFrame:
    """Add time and status of the ship's previous and next report and the time elapsed."""
    slicing = slicing or plan_slices(reports)
    reports = slicing.assign(reports)
    series = Window.partitionBy(*slicing.keys).orderBy(*IN_TIME)
    rows = reports.select(
        "*",
        F.lag("gps_timestamp").over(series).alias("timestamp_prev"),
        F.lag("nav_status").over(series).alias("nav_status_prev"),
        F.lead("gps_timestamp").over(series).alias("timestamp_next"),
        F.lead("nav_status").over(series).alias("nav_status_next"),
    )
    if slicing.cut:
        rows = _across_slices(rows, reports, slicing)
    return rows.withColumn("delta_t", F.col("gps_timestamp") - F.col("timestamp_prev"))


def _across_slices(rows: DataFrame, reports: DataFrame, slicing: Slicing) -> DataFrame:
    """Fill the neighbours of each slice's first and last report from the slices beside it."""
    report = F.struct(*IN_TIME, "nav_status")
    ends = (
        slicing.of_cut_ships(reports)
        .groupBy(*slicing.keys)
        .agg(F.min(report).alias("first"), F.max(report).alias("last"))
    )
    ship = Window.partitionBy("ship_id").orderBy(*slicing.keys[1:])
    beside = ends.select(
        *slicing.keys,
        F.lag("last").over(ship).alias("earlier"),
        F.lead("first").over(ship).alias("later"),
    )
    rows = rows.join(stored(beside, "beside"), slicing.keys, "left")
    for side, report in (("prev", "earlier"), ("next", "later")):
        # The timestamp tells whether there is a neighbour; its status may be unknown.
        missing = F.col(f"timestamp_{side}").isNull()
        status = F.when(missing, F.col(f"{report}.nav_status"))
        rows = rows.withColumn(
            f"nav_status_{side}", status.otherwise(F.col(f"nav_status_{side}"))
        ).withColumn(
            f"timestamp_{side}",
            F.coalesce(f"timestamp_{side}", F.col(f"{report}.gps_timestamp")),
        )
    return rows.drop("earlier", "later")


def elapsed_seconds() -> Column:
    return (micros(F.col("gps_timestamp")) - micros(F.col("timestamp_prev"))) / F.lit(1e6)


def transitions(
    rows: DataFrame, gap_seconds: int = GAP_SECONDS, active: str = ACTIVE_STATUS
) -> DataFrame:
    """Flag the reports where the engine starts, stops or is still on after a gap."""
    before, now = F.col("nav_status_prev"), F.col("nav_status")
    return rows.withColumns(
        {
            "start_engine": flag((before != active) & (now == active)),
            "stop_engine": flag((before == active) & (now != active)),
            "start_after_gap": flag(
                (F.col("delta_t") > gap_interval(gap_seconds)) & (before == active) & (now == active)
            ),
        }
    )


def boundary_flags(rows: DataFrame, gap_seconds: int, active: str) -> tuple[Column, Column, Column, Column]:
    """Of each report whether its ship is fresh, the boundary is known, and if it starts or stops a voyage.

    A column `opens` is 1 for reports that are known to start one from before.
    With a settled_until column, boundaries up to that time are known for all but the fresh
    ships. Ships are fresh that have no earlier boundary: by the fresh column, or else those
    without settled_until.
    """
    ends_before_gap = flag(
        (F.col("timestamp_next") - F.col("gps_timestamp") > gap_interval(gap_seconds))
        & (F.col("nav_status") == active)
        & (F.col("nav_status_next") == active)
    )
    fresh = F.lit(True)
    if "fresh" in rows.columns:
        fresh = F.col("fresh")
    elif "settled_until" in rows.columns:
        fresh = F.col("settled_until").isNull()
    known = F.lit(False)
    if "settled_until" in rows.columns:
        # A ship without settled_until that is not fresh goes on from its last report: none is known.
        known = F.coalesce(~fresh & (F.col("gps_timestamp") <= F.col("settled_until")), F.lit(False))
    starts = F.greatest("start_engine", "start_after_gap", *[c for c in ["opens"] if c in rows.columns])
    return fresh, known, starts, F.greatest("stop_engine", ends_before_gap)


def _ranked(
    rows: DataFrame, slicing: Slicing, gap_seconds: int, active: str, openings: DataFrame | None = None
) -> DataFrame:
    """Reports that start or stop a voyage; `first_stop` marks a ship's first when it stops.

    Known boundaries are left out (see boundary_flags). `openings` (ship_id, gps_timestamp,
    position_id, fresh) are reports not among the rows that start one.
    """
    fresh, known, starts, stops = boundary_flags(rows, gap_seconds, active)
    marked = (
        rows.filter(~known)
        .select(
            *slicing.keys,
            *IN_TIME,
            "timestamp_prev",
            fresh.alias("fresh"),
            starts.alias("start_trajectory"),
            stops.alias("stop_trajectory"),
        )
        .filter((F.col("start_trajectory") == 1) | (F.col("stop_trajectory") == 1))
    )
    if openings is not None:
        begun = slicing.assign(openings).withColumns(
            {"timestamp_prev": F.lit(None).cast("timestamp_ntz"), "start_trajectory": F.lit(1), "stop_trajectory": F.lit(0)}
        )
        marked = marked.unionByName(begun.select(*marked.columns))
    if slicing.cut:
        marked = stored(marked, "boundaries")
    series = Window.partitionBy(*slicing.keys).orderBy(*IN_TIME)
    ranked = marked.withColumn("nth", F.row_number().over(series))
    if slicing.cut:
        sizes = marked.groupBy(*slicing.keys).agg(F.count(F.lit(1)).alias("n"))
        ranked = ranked.join(slicing.running_before(sizes, ["n"]), slicing.keys).withColumn(
            "nth", F.col("nth") + F.col("n_before")
        )
    first_stop = F.col("fresh") & (F.col("stop_trajectory") == 1) & (F.col("nth") == 1)
    return ranked.withColumn("first_stop", first_stop).drop("nth", "n_before", "fresh")


def boundaries(
    rows: DataFrame,
    slicing: Slicing,
    gap_seconds: int = GAP_SECONDS,
    active: str = ACTIVE_STATUS,
) -> DataFrame:
    """Reports that start or stop a voyage, without a stop that comes first for its ship."""
    ranked = _ranked(rows, slicing, gap_seconds, active)
    return ranked.filter(~F.col("first_stop")).drop("first_stop", "timestamp_prev")


def _paired(ranked: DataFrame, slicing: Slicing) -> DataFrame:
    """Give each start the ship's nearest stop at or after it, or leave the voyage open.

    `start_id` is the position id of the first report that starts it. A row without start time
    tells that the ship's first boundary was a stop.
    """
    keys = slicing.time_keys
    counts = ~F.col("first_stop")
    instants = ranked.groupBy(*keys, "gps_timestamp").agg(
        F.max(F.when(counts, F.col("start_trajectory"))).alias("starts"),
        F.max(F.when(counts, F.col("stop_trajectory"))).alias("stops"),
        F.max("first_stop").alias("first_stop"),
        F.min(F.when(counts & (F.col("start_trajectory") == 1), F.col("position_id"))).alias("start_id"),
    )
    at = F.col("gps_timestamp")
    stop_at = F.when(F.col("stops") == 1, at)
    onward = (
        Window.partitionBy(*keys)
        .orderBy(at.desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    paired = instants.withColumn("stop", F.last(stop_at, ignorenulls=True).over(onward))
    if slicing.cut:
        later = (
            Window.partitionBy("ship_id")
            .orderBy(F.col("slice_start").desc())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        following = (
            instants.groupBy(*keys)
            .agg(F.min(stop_at).alias("first_stop_at"))
            .select(*keys, F.last("first_stop_at", ignorenulls=True).over(later).alias("later"))
        )
        paired = paired.join(following, keys).withColumn("stop", F.coalesce("stop", "later"))
    starts = F.coalesce(F.col("starts") == 1, F.lit(False))
    return paired.filter(starts | F.col("first_stop")).select(
        "ship_id",
        F.when(starts, at).alias("datetime_start"),
        F.coalesce("stop", open_end()).alias("datetime_stop"),
        (starts & F.col("stop").isNull()).alias("is_open"),
        "start_id",
    )


def last_stops(limits: DataFrame) -> DataFrame:
    """Per ship, the stop of its last closed voyage."""
    return (
        limits.filter(~F.col("is_open"))
        .groupBy("ship_id")
        .agg(F.max("datetime_stop").alias("settled_until"))
    )


def in_ship_range(rows: DataFrame, ship_range: tuple[int, int] | None) -> DataFrame:
    if ship_range is None:
        return rows
    low, high = ship_range
    # Bloom filters answer an equation, not a range.
    return rows.filter(F.col("ship_id") == low if low == high else F.col("ship_id").between(low, high))


def unsettled(
    positions: DataFrame,
    prior_limits: DataFrame | None,
    ship_range: tuple[int, int] | None = None,
    mode: str = "carry",
) -> DataFrame:
    """Reports an increment has to read: those after the ship's last stored stop.

    "parity" reads strictly after it. "carry" includes it, so that the next report keeps
    its predecessor, and adds the stop as settled_until.
    """
    if mode not in ("carry", "parity"):
        raise ValueError(f"mode must be carry or parity, not {mode!r}")
    positions = in_ship_range(positions, ship_range)
    if prior_limits is None:
        return positions
    rows = lookup(positions, last_stops(in_ship_range(prior_limits, ship_range)), "ship_id")
    at, mark = F.col("gps_timestamp"), F.col("settled_until")
    if mode == "parity":
        return rows.filter(mark.isNull() | (at > mark)).drop("settled_until")
    return rows.filter(mark.isNull() | (at >= mark))


def search(
    positions: DataFrame,
    statuses: DataFrame | Sized,
    slicing: Slicing,
    gap_seconds: int = GAP_SECONDS,
    active: str = ACTIVE_STATUS,
    openings: DataFrame | None = None,
) -> DataFrame:
    """Voyage limits from the given positions, and known starts, with what a later increment needs."""
    rows = deltas(with_status(positions, statuses), slicing)
    flagged = transitions(rows, gap_seconds, active)
    return _paired(_ranked(flagged, slicing, gap_seconds, active, openings), slicing)


def voyages_among(found: DataFrame) -> DataFrame:
    return found.filter(F.col("datetime_start").isNotNull()).select(*LIMITS.fieldNames())


def limits_of(
    positions: DataFrame,
    statuses: DataFrame | Sized,
    slicing: Slicing,
    gap_seconds: int = GAP_SECONDS,
    active: str = ACTIVE_STATUS,
) -> DataFrame:
    """Voyage limits from the given positions alone."""
    return voyages_among(search(positions, statuses, slicing, gap_seconds, active))


def find_voyages(
    positions: DataFrame,
    statuses: DataFrame | Sized,
    prior_limits: DataFrame | None = None,
    gap_seconds: int = GAP_SECONDS,
    active: str = ACTIVE_STATUS,
    ship_range: tuple[int, int] | None = None,
    mode: str = "carry",
    limit: int | None = None,
    fullest: int | None = None,
) -> DataFrame:
    """Limits of the voyages in the positions: ship_id, datetime_start, datetime_stop, is_open.

    With prior limits, only the voyages after each ship's last closed one are returned;
    open voyages among the prior limits are found again and should be dropped.
    """
    positions = unsettled(positions, prior_limits, ship_range, mode)
    slicing = plan_slices(positions, limit, fullest)
    return limits_of(positions, statuses, slicing, gap_seconds, active)
