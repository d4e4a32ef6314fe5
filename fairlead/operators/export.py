"""Voyages with their reports: as one row per report, or as a line with parallel vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions.columns import ACTIVE_STATUS, GAP_SECONDS, line_wkt, open_end
from fairlead.operators.detect import (
    IN_TIME,
    boundary_flags,
    deltas,
    in_ship_range,
    limits_of,
    transitions,
    unsettled,
    with_status,
)
from fairlead.operators.keys import MIN_GROUP_ROWS, Sized, lookup
from fairlead.operators.slices import Slicing, plan_slices
from fairlead.session import stored

POINT = [
    "gps_timestamp",
    "position_id",
    "longitude",
    "latitude",
    "speed_over_ground",
    "course_over_ground",
    "heading",
]
# Reports per exported row; a longer voyage continues in further rows, numbered by `part`.
MAX_POINTS = 100_000

# At one instant, starts come before reports and reports before stops. A voyage that goes
# on in a further slice is announced there by a row without time, before all others.
CONTINUED, START, REPORT, STOP = -1, 0, 1, 2
FIRST_PART, LAST_PART = -1, 2**62
IN_ORDER = ["gps_timestamp", "kind", "position_id"]


def _timeline(limits: DataFrame, reports: DataFrame, slicing: Slicing) -> DataFrame:
    """Starts, reports and stops of each ship as one series, with their running counts.

    `begun`, `done` and `told` count the ship's starts, stops and reports so far.
    """
    is_start = F.col("kind") == START
    described = F.struct(*[c for c in limits.columns if c != "ship_id"])
    bounds = (
        limits.withColumn("kind", F.explode(F.array(F.lit(START), F.lit(STOP))))
        .select(
            "ship_id",
            "kind",
            F.when(is_start, F.col("datetime_start"))
            .otherwise(F.col("datetime_stop"))
            .alias("gps_timestamp"),
            F.when(is_start, described).alias("voyage"),
        )
        .filter(is_start | (F.col("gps_timestamp") < open_end()))
    )
    part = F.when(is_start, F.lit(FIRST_PART)).otherwise(F.lit(LAST_PART))
    bounds = slicing.assign(bounds, part)
    events = slicing.assign(reports.withColumn("kind", F.lit(REPORT))).unionByName(
        bounds, allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(*slicing.keys)
        .orderBy(*IN_ORDER)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counts = {"begun": START, "done": STOP, "told": REPORT}

    def counted(kind: int):
        return (F.col("kind") == kind).cast("bigint")

    rows = events.withColumns({c: F.sum(counted(k)).over(so_far) for c, k in counts.items()})
    if not slicing.cut:
        return rows
    none = F.lit(0)
    totals = (
        slicing.of_cut_ships(bounds)
        .select(
            *slicing.keys, counted(START).alias("begun"), counted(STOP).alias("done"),
            none.alias("told"),
        )
        .unionByName(
            slicing.slices.select(
                *slicing.keys, none.alias("begun"), none.alias("done"),
                F.col("reports").alias("told"),
            )
        )
        .groupBy(*slicing.keys)
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    before = slicing.running_before(totals, list(counts))
    return rows.join(before, slicing.keys, "left").withColumns(
        {c: F.col(c) + F.coalesce(f"{c}_before", none) for c in counts}
    )


def voyage_points(
    limits: DataFrame,
    positions: DataFrame,
    slicing: Slicing | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Every voyage with its reports between start and stop, both included.

    One row per voyage and report, numbered from 0 by `seq`; a voyage without reports has
    one row with NULL seq. A ship's n-th start and n-th stop in time order belong to its
    n-th voyage (stops never run backwards), so a report lies in the voyages numbered from
    one past the stops before it up to the starts so far: running counts over the series,
    and no comparison of reports with voyages.
    """
    slicing = slicing or plan_slices(positions, limit)
    reports = positions.filter(F.col("ship_id").isNotNull()).select("ship_id", *POINT)
    described = [f"known.{c}" for c in limits.columns if c != "ship_id"]
    if slicing.cut:
        starts = stored(_starts(limits, reports, slicing), "starts")
        limits = starts.unionByName(slicing.of_whole_ships(limits), allowMissingColumns=True)
    rows = _timeline(limits, reports, slicing)
    is_start, is_report = F.col("kind") == START, F.col("kind") == REPORT
    first = F.when(is_start, F.col("begun")).otherwise(F.col("done") + 1)
    members = (
        rows.filter((F.col("kind") != STOP) & (first <= F.col("begun")))
        .withColumn("voyage_no", F.explode(F.sequence(first, F.col("begun"))))
        .withColumn("told_before", F.when(is_start, F.col("told")))
        .select(*slicing.keys, "voyage_no", "kind", *POINT, "voyage", "told", "told_before")
    )
    if slicing.cut:
        members = members.unionByName(_continued(starts, slicing), allowMissingColumns=True)
    in_voyage = Window.partitionBy(*slicing.keys, "voyage_no").orderBy(*IN_ORDER)
    numbered = members.select(
        "ship_id",
        "voyage_no",
        "kind",
        F.first("voyage").over(in_voyage).alias("known"),
        *POINT,
        (F.col("told") - F.first("told_before").over(in_voyage) - 1).alias("seq"),
        F.lead("kind").over(in_voyage).isNull().alias("ends_here"),
    )
    # The start row itself only stays when its voyage has no reports.
    empty = F.col("ends_here")
    if slicing.cut:
        empty = F.coalesce("known.empty", empty)
    return numbered.filter(is_report | (is_start & empty)).select(
        "ship_id",
        "voyage_no",
        *described,
        F.when(is_report, F.col("seq")).alias("seq"),
        F.when(is_report, F.col("gps_timestamp")).alias("gps_timestamp"),
        *POINT[1:],
    )


def _starts(limits: DataFrame, reports: DataFrame, slicing: Slicing) -> DataFrame:
    """The cut ships' limits, each with its number, the reports before it, and if it has none."""
    in_time = slicing.of_cut_ships(reports.select("ship_id", "gps_timestamp", "position_id"))
    bounds = _timeline(slicing.of_cut_ships(limits), in_time, slicing)
    stops = bounds.filter(F.col("kind") == STOP).select(
        "ship_id", F.col("done").alias("number"), F.col("told").alias("told_at_stop")
    )
    ships = slicing.slices.groupBy("ship_id").agg(F.sum("reports").alias("told_in_all"))
    starts = bounds.filter(F.col("kind") == START).select(
        "ship_id",
        "voyage.*",
        F.col("begun").alias("number"),
        F.col("told").alias("told_at_start"),
    )
    told = F.coalesce("told_at_stop", "told_in_all", F.lit(0))
    return (
        starts.join(stops, ["ship_id", "number"], "left")
        .join(ships, "ship_id", "left")
        .select(
            *limits.columns, "number", "told_at_start",
            (told == F.col("told_at_start")).alias("empty"),
        )
    )


def _continued(starts: DataFrame, slicing: Slicing) -> DataFrame:
    """For each slice, the voyages that began before it and have not stopped by then."""
    keys = slicing.keys
    first, last = F.lit(FIRST_PART), F.lit(LAST_PART)
    begun = slicing.assign(
        starts.select("ship_id", F.col("datetime_start").alias("gps_timestamp")), first
    )
    done = slicing.assign(
        starts.select("ship_id", F.col("datetime_stop").alias("gps_timestamp")).filter(
            F.col("gps_timestamp") < open_end()
        ),
        last,
    )
    one, none = F.lit(1), F.lit(0)
    totals = (
        begun.select(*keys, one.alias("begun"), none.alias("done"))
        .unionByName(done.select(*keys, none.alias("begun"), one.alias("done")))
        .unionByName(slicing.slices.select(*keys, none.alias("begun"), none.alias("done")))
        .groupBy(*keys)
        .agg(F.sum("begun").alias("begun"), F.sum("done").alias("done"))
    )
    going = slicing.running_before(totals, ["begun", "done"]).filter(
        F.col("begun_before") > F.col("done_before")
    )
    cells = going.select(
        *keys, F.explode(F.sequence(F.col("done_before") + 1, F.col("begun_before"))).alias("number")
    )
    return cells.join(starts, ["ship_id", "number"]).select(
        *keys,
        F.col("number").alias("voyage_no"),
        F.lit(CONTINUED).alias("kind"),
        F.struct(*[c for c in starts.columns if c != "ship_id"]).alias("voyage"),
        F.col("told_at_start").alias("told_before"),
    )


def export_trajectories(
    limits: DataFrame,
    positions: DataFrame,
    ships: DataFrame | Sized,
    ship_id: int | None = None,
    ship_range: tuple[int, int] | None = None,
    max_points: int = MAX_POINTS,
    slicing: Slicing | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per voyage: mmsi, limits, the line and the vectors, all in report order.

    A voyage of more than max_points reports continues in further rows, `part` 0, 1, ...;
    their vectors follow each other without overlap.
    """
    if ship_id is not None:
        ship_range = (ship_id, ship_id)
    limits, positions = in_ship_range(limits, ship_range), in_ship_range(positions, ship_range)
    named = ships.select(F.col("id").alias("ship_id"), "mmsi")
    limits = lookup(limits, named, "ship_id", spread="datetime_start")
    points = voyage_points(limits, positions, slicing, limit)
    described = [c for c in limits.columns if c != "ship_id"]
    return _lines(points, "voyage_no", described, max_points)


def _lines(points: DataFrame, voyage: str, described: list[str], max_points: int) -> DataFrame:
    """One row per voyage and part from one row per voyage and report."""
    coordinates = F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))
    vectors = [c for c in POINT if c not in ("position_id", "longitude", "latitude")]
    report = F.when(
        F.col("seq").isNotNull(), F.struct("seq", coordinates.alias("coordinates"), *vectors)
    )
    part = F.coalesce(F.floor(F.col("seq") / max_points), F.lit(0))
    parts = (
        points.withColumn("part", part)
        .groupBy("ship_id", voyage, "part")
        .agg(
            *[F.first(c).alias(c) for c in described if c != voyage],
            # Structs, since a list of plain values would lose its NULLs.
            F.sort_array(F.collect_list(report)).alias("reports"),
        )
    )
    return parts.select(
        "ship_id",
        *described,
        "part",
        F.col("reports.coordinates").alias("coordinates"),
        F.col("reports.gps_timestamp").alias("timestamps"),
        F.col("reports.speed_over_ground").alias("speed_over_ground"),
        F.col("reports.course_over_ground").alias("course_over_ground"),
        F.col("reports.heading").alias("heading"),
    )


def line_texts(lines: DataFrame) -> DataFrame:
    """Exported rows with their line as well-known text and the number of parts of their voyage."""
    voyage = Window.partitionBy("ship_id", "datetime_start")
    return lines.withColumns({"line": line_wkt(F.col("coordinates")), "n_parts": F.count(F.lit(1)).over(voyage)})


def _voyage_reports(
    positions: DataFrame, statuses: DataFrame | Sized, gap_seconds: int = GAP_SECONDS, active: str = ACTIVE_STATUS
) -> DataFrame:
    """The voyages among the positions with their reports, as voyage_points gives them, in one shuffle.

    The reports are dealt by ship once, measures along, and every step is a window over that.
    A report lies in the voyages that start at or before it and do not stop between. Going
    back from it, starts and stops take turns, so these are the last voyage that starts
    before its instant, unless that has stopped before, and the one that starts at its instant,
    if any; two at most, and two only where the former stops there. Reports of one instant
    are judged alike, whatever their order.
    """
    measures = tuple(c for c in POINT if c not in IN_TIME)
    reports = with_status(positions, statuses, measures)
    rows = transitions(deltas(reports, Slicing(MIN_GROUP_ROWS)), gap_seconds, active)
    fresh, known, starts, stops = boundary_flags(rows, gap_seconds, active)
    at = F.col("gps_timestamp")
    in_time = Window.partitionBy("ship_id").orderBy(*IN_TIME)
    rows = rows.select(
        "ship_id", *POINT, fresh.alias("fresh"), (~known & (starts == 1)).alias("starts"), (~known & (stops == 1)).alias("stops")
    )
    nth = F.sum((F.col("starts") | F.col("stops")).cast("int")).over(in_time)
    # A ship's first boundary does not count if it is a stop, also where it is a start, too.
    counts = ~(F.col("fresh") & F.col("stops") & (nth == 1))
    rows = rows.select(
        "ship_id", *POINT, F.when(F.col("starts") & counts, at).alias("start_at"), F.when(F.col("stops") & counts, at).alias("stop_at")
    )
    earlier = in_time.rowsBetween(Window.unboundedPreceding, -1)
    instant = Window.partitionBy("ship_id", "gps_timestamp")
    rows = rows.withColumns({"begun": F.max("start_at").over(earlier), "done": F.max("stop_at").over(earlier)})
    # What was before the first report of an instant was before the instant.
    first = instant.orderBy("position_id")
    rows = rows.withColumns(
        {"begun": F.first("begun").over(first), "done": F.first("done").over(first), "starts_here": F.max("start_at").over(instant)}
    )
    going = F.when(F.col("done").isNull() | (F.col("done") < F.col("begun")), F.col("begun"))
    rows = rows.withColumn("datetime_start", F.explode(F.array_compact(F.array(going, "starts_here"))))
    voyage = Window.partitionBy("ship_id", "datetime_start")
    stop = F.max("stop_at").over(voyage)
    return rows.select(
        "ship_id",
        "datetime_start",
        F.coalesce(stop, open_end()).alias("datetime_stop"),
        stop.isNull().alias("is_open"),
        (F.row_number().over(voyage.orderBy(*IN_TIME)) - 1).alias("seq"),
        *POINT,
    )


def find_and_export(
    positions: DataFrame,
    statuses: DataFrame | Sized,
    ships: DataFrame | Sized,
    prior_limits: DataFrame | None = None,
    ship_range: tuple[int, int] | None = None,
    mode: str = "carry",
    max_points: int = MAX_POINTS,
    limit: int | None = None,
    fullest: int | None = None,
    **rules,
) -> tuple[DataFrame, DataFrame]:
    """The voyages found by this run, and their export.

    Both come from one shuffle of the reports, unless a ship is crowded and cut into slices:
    then the voyages are found first and meet the reports in a second one.
    """
    # Earlier reports cannot lie in the new voyages.
    fresh = unsettled(positions, prior_limits, ship_range, mode)
    slicing = plan_slices(fresh, limit, fullest)
    limits = limits_of(fresh, statuses, slicing, **rules)
    if slicing.cut:
        limits = stored(limits, "limits")
        lines = export_trajectories(limits, fresh, ships, max_points=max_points, slicing=slicing)
        return limits, lines
    points = _voyage_reports(fresh, statuses, **rules)
    lines = _lines(points, "datetime_start", ["datetime_start", "datetime_stop", "is_open"], max_points)
    named = ships.select(F.col("id").alias("ship_id"), "mmsi")
    lines = lookup(lines, named, "ship_id", spread="datetime_start")
    described = ["ship_id", "datetime_start", "datetime_stop", "is_open", "mmsi"]
    return limits, lines.select(*described, *[c for c in lines.columns if c not in described])
