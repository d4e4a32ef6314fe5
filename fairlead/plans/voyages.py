"""Job: find new voyages, export them, or export all stored ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.functions.columns import ACTIVE_STATUS, GAP_SECONDS
from fairlead.operators.detect import in_ship_range, last_stops, search, unsettled, voyages_among
from fairlead.operators.export import MAX_POINTS, export_trajectories
from fairlead.operators.increment import (
    SLIM,
    last_reports,
    next_states,
    openings,
    plan_reading,
    reports_since,
    seeds,
    taken_back,
)
from fairlead.operators.keys import Sized, lookup, number_rows
from fairlead.operators.slices import plan_slices
from fairlead.session import scratch, stored
from fairlead.sources.tables import FINDING, Run, Warehouse, new_id

MODES = (*FINDING, "export")
INCREMENTS = ("carry", "parity", "full")


def run_voyages(
    warehouse: Warehouse,
    mode: str = "find",
    ship_range: tuple[int, int] | None = None,
    increment: str = "carry",
    max_points: int = MAX_POINTS,
    gap_seconds: int = GAP_SECONDS,
    active: str = ACTIVE_STATUS,
) -> Run:
    """One run over all ships or a range of ship ids.

    "find" stores the limits of new voyages, "find_export" their lines too, and "export"
    exports all stored voyages again in place of what was exported before.

    `increment` says what becomes of reports at or before their ship's last stored stop:
    "carry" and "parity" leave them out for good, "full" takes back the voyages from the first
    such report on and finds them anew, also where a repeated load took reports away. The run
    tells how many there were (late) and how many stored voyages it took back.
    """
    with warehouse.snapshot(), scratch(warehouse.spark):
        return _run(warehouse, mode, ship_range, increment, max_points, gap_seconds, active)


def _run(
    warehouse: Warehouse,
    mode: str,
    ship_range: tuple[int, int] | None,
    increment: str,
    max_points: int,
    gap_seconds: int,
    active: str,
) -> Run:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    if increment not in INCREMENTS:
        raise ValueError(f"increment must be one of {', '.join(INCREMENTS)}, not {increment!r}")
    if increment == "full" and ship_range is not None:
        raise ValueError("a full increment is over all ships")
    before = warehouse.last_run()
    run_id = new_id(before.run_id if before else 0)
    last_id = before.last_id if before else 0
    update_id = warehouse.last_update()
    rules = f"{increment}, {gap_seconds} s, {active}"
    number = F.lit(run_id).cast("bigint").alias("run_id")

    slicing, late, n_back, fullest, lasts = None, 0, 0, None, None
    if mode == "export":
        limits = in_ship_range(warehouse.limits(), ship_range)
        positions = in_ship_range(warehouse.positions(), ship_range)
    else:
        statuses = warehouse.read("nav_statuses")
        stored_limits = in_ship_range(warehouse.limits(), ship_range)
        closed = stored_limits.filter(~F.col("is_open"))
        found_before = warehouse.last_run(finding=True)
        plan, going, positions, states = None, None, None, None
        if ship_range is None and increment != "parity":
            last = found_before if _resumable(found_before, mode, rules) else None
            if last:
                states = warehouse.read("states").filter(F.col("run_id") == last.run_id)
            news = warehouse.positions(after=last.update_id if last else 0)
            gone = warehouse.withdrawn(last.run_id) if last and increment == "full" else None
            known = closed if found_before else None
            plan, doubtful = plan_reading(news, known, states, increment == "full", gone)
            plan = stored(plan, "reading")
            resumed = F.col("resumed")
            n_ships, n_late, most = plan.agg(
                F.count(F.lit(1)), F.count(F.when(~resumed, 1)), F.max(F.when(resumed, F.col("n_new")))
            ).first()
            # A ship whose new reports all follow its last stop has none that came late.
            behind = plan.filter(F.col("first_new") <= F.col("last_stop"))
            stops = Sized(behind.select("ship_id", F.col("last_stop").alias("settled_until")), n_ships)
            if doubtful is not None:
                back = taken_back(plan, doubtful, n_late)
                warehouse.replace_partitions("retracted", back.select("id", number), ["run_id"])
                n_back = warehouse.read("retracted").filter(F.col("run_id") == run_id).count()
            again = _read_again(warehouse, plan, n_late, news if last else None)
            reports = _to_search(plan, n_ships, n_late, news, again)
            # A resumed ship's last report stands before its new ones.
            fullest = (most or 0) + 1
            if n_late and not found_before:
                # All there is is new.
                lasts = plan.select("ship_id", F.col("new_last").alias("again_last"), F.col("n_new").alias("n_again"))
            elif n_late:
                lasts = stored(last_reports(again), "last-reports")
            if n_late:
                fullest = max(fullest, lasts.agg(F.max("n_again")).first()[0] or 0)
            going = openings(plan)
        else:
            positions = unsettled(warehouse.positions(), closed, ship_range, increment)
            reports = positions
            stops = last_stops(closed)
        if found_before:
            late = _late(warehouse.positions(after=found_before.update_id), stops, ship_range)
        slicing = plan_slices(reports, fullest=fullest)
        found = stored(search(reports, statuses, slicing, gap_seconds, active, going), "found")
        limits = voyages_among(found)
        count = limits.count()
        limits = number_rows(limits, ["ship_id", "datetime_start"], last_id, count)
        last_id += count
        if plan is not None:
            # Open voyages of ships that were not read stay as they are.
            others = stored_limits.filter("is_open").drop("run_id")
            others = others.join(plan.select("ship_id"), "ship_id", "left_anti")
            limits = limits.unionByName(others)
            after = next_states(plan, found, states, lasts)
            warehouse.replace_partitions("states", after.select("*", number), ["run_id"])
        limits = limits.sortWithinPartitions("is_open", "ship_id", "datetime_start")
        warehouse.replace_partitions("limits", limits.select("*", number), ["run_id", "is_open"])
        limits = warehouse.read("limits").filter(F.col("run_id") == run_id)
        if plan is not None and mode != "find":
            read = Sized(plan.select("ship_id"), n_ships)
            limits = lookup(limits, read, "ship_id", "left_semi", spread="datetime_start")
            if states is not None:
                positions, slicing = _to_export(warehouse, limits, plan), None
            else:
                positions = again

    if mode != "find":
        lines = export_trajectories(
            limits.drop("run_id").withColumnRenamed("id", "trajectory_id"),
            positions,
            warehouse.read("ships"),
            max_points=max_points,
            slicing=slicing,
        ).sortWithinPartitions("is_open", "ship_id", "datetime_start", "part")
        warehouse.replace_partitions("exports", lines.select("*", number), ["run_id", "is_open"])

    run = Run(run_id, mode, ship_range, rules, update_id, last_id, late, n_back)
    warehouse.log_run(run)
    return run


def _resumable(last: Run | None, mode: str, rules: str) -> bool:
    """Whether the last finding run's states serve: all ships, same rules, lines as wanted now."""
    return last is not None and last.ship_range is None and last.rules == rules and mode in ("find", last.mode)


def _first_day(news: DataFrame) -> date | None:
    """The day before which few ships, if any, are to be read: that of the first new reports."""
    return news.agg(F.min("gps_date")).first()[0]


def _read_again(warehouse: Warehouse, plan: DataFrame, count: int, news: DataFrame | None) -> DataFrame:
    """All reports, old and new, of the ships that cannot be resumed, from where each is read."""
    if not count:
        return warehouse.positions(after=warehouse.last_update())
    ships = plan.filter(~F.col("resumed")).select("ship_id", F.col("read_from").alias("need_from"))
    day = _first_day(news) if news is not None else None
    return reports_since(warehouse.positions(), Sized(ships, count), day)


def _to_search(plan: DataFrame, n_ships: int, n_late: int, news: DataFrame, again: DataFrame) -> DataFrame:
    """What detection reads: reports read again, and the new ones of resumed ships after their last."""
    marks = ["ship_id", "settled_until", "fresh", F.lit(0).alias("opens")]
    rows = lookup(again, Sized(plan.filter("not resumed").select(*marks), n_late), "ship_id", "inner").select(*SLIM)
    if n_late == n_ships:
        return rows
    fresh = lookup(news, Sized(plan.filter("resumed").select(*marks), n_ships - n_late), "ship_id", "inner")
    return rows.unionByName(fresh.select(*SLIM)).unionByName(seeds(plan).select(*SLIM))


def _to_export(warehouse: Warehouse, limits: DataFrame, plan: DataFrame) -> DataFrame:
    """The reports of the found voyages' ships, each from its first start on."""
    needs = stored(limits.groupBy("ship_id").agg(F.min("datetime_start").alias("need_from")), "lines-from")
    day = plan.agg(F.min("first_new").cast("date")).first()[0]
    return reports_since(warehouse.positions(), Sized(needs, needs.count()), day)


def _late(news: DataFrame, stops: DataFrame | Sized, ship_range: tuple[int, int] | None) -> int:
    """How many of the reports came at or before their ship's last stored stop."""
    rows = in_ship_range(news, ship_range).select("ship_id", "position_id", "gps_timestamp")
    rows = lookup(rows, stops, "ship_id", "inner")
    return rows.filter(F.col("gps_timestamp") <= F.col("settled_until")).count()
