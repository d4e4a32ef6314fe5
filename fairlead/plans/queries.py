"""One query per operator over the test tables; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.functions.columns import ntz
from fairlead.operators import detect, dimensions, export, positions, quality
from fairlead.operators.keys import Sized, lookup
from fairlead.operators.slices import Slicing, plan_slices
from fairlead.plans.voyages import run_voyages
from fairlead.plans.warehouse import store_load, update_warehouse
from fairlead.schemas import CSV_COLUMNS
from fairlead.session import scratch_path, stored
from fairlead.sources.csv import ingest_csv
from fairlead.sources.events import staging_from_events
from fairlead.sources.tables import Warehouse

# The loads up to FIRST_MARK hold most, but not all, ships; MARK splits the loads in two.
FIRST_MARK = datetime(2024, 1, 2)
MARK = datetime(2024, 1, 16)
WIDE_GAP_SECONDS = 12 * 3600
# What the queries of the paths for large tables take instead of the limits in use.
CUT_GROUPS = 500
FEW_POINTS = 3

OUTPUT_NAMES = {"speed_over_ground": "sog", "course_over_ground": "cog"}


@dataclass
class Tables:
    """The staging rows and what is derived from them, each built on first use."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def staging(self) -> DataFrame:
        return staging_from_events(self.spark, self.sf_dir)

    @cached_property
    def ships(self) -> Sized:
        return dimensions.add_new_keys(self.staging, None, "mmsi")

    @cached_property
    def statuses(self) -> Sized:
        return dimensions.add_new_keys(self.staging, None, "nav_status")

    @cached_property
    def positions(self) -> DataFrame:
        return positions.build_positions(self.staging, self.ships, self.statuses)

    @cached_property
    def slicing(self) -> Slicing:
        return plan_slices(self.positions, fullest=self.ships.fullest)

    @cached_property
    def low_limit(self) -> int:
        """A limit that many groups exceed, and no more than CUT_GROUPS."""
        return max(1, -(-self.staging.count() // CUT_GROUPS))

    @cached_property
    def rows(self) -> DataFrame:
        reports = detect.with_status(self.positions, self.statuses)
        return detect.deltas(reports, self.slicing)

    @cached_property
    def flagged(self) -> DataFrame:
        return detect.transitions(self.rows)

    @cached_property
    def limits(self) -> DataFrame:
        return detect.limits_of(self.positions, self.statuses, self.slicing)

    @cached_property
    def loaded(self) -> DataFrame:
        """Staging rows of the loads up to MARK."""
        return self.staging.filter(F.col("load_date") <= ntz(MARK))

    @cached_property
    def earlier_positions(self) -> DataFrame:
        return self.positions.filter(F.col("load_date") <= ntz(MARK))

    @cached_property
    def earlier_limits(self) -> DataFrame:
        """Voyages of the first increment, stored as they would be between two runs."""
        limits = detect.find_voyages(
            self.earlier_positions, self.statuses, fullest=self.ships.fullest
        )
        return stored(limits, "earlier-limits")

    @cached_property
    def closed_limits(self) -> DataFrame:
        return self.earlier_limits.filter(~F.col("is_open"))

    @cached_property
    def newer(self) -> DataFrame:
        return positions.new_rows(self.staging, positions.load_mark(self.loaded))


def staging_count(t: Tables) -> DataFrame:
    return t.staging.agg(F.count(F.lit(1)).alias("n"))


def new_rows_watermark(t: Tables) -> DataFrame:
    return t.newer.select("position_id", "mmsi", "nav_status", "load_date")


def new_row_range(t: Tables) -> DataFrame:
    return positions.id_range(t.newer)


def reject_rows(t: Tables) -> DataFrame:
    return quality.reject_rows(t.staging)


def _dimension(t: Tables, key: str) -> DataFrame:
    first = F.col("load_date") <= ntz(FIRST_MARK)
    known = dimensions.add_new_keys(t.staging.filter(first), None, key).rows
    return known.unionByName(dimensions.add_new_keys(t.staging.filter(~first), known, key).rows)


def dim_ships(t: Tables) -> DataFrame:
    return _dimension(t, "mmsi")


def dim_ships_spread(t: Tables) -> DataFrame:
    """Ship ids from a sort over all tasks."""
    return dimensions.add_new_keys(t.staging, None, "mmsi", one_task=0).rows


def dim_nav_statuses(t: Tables) -> DataFrame:
    return _dimension(t, "nav_status")


def _short(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(OUTPUT_NAMES)


def all_positions(t: Tables) -> DataFrame:
    return _short(t.positions)


def positions_salted(t: Tables) -> DataFrame:
    """Lookups by a shuffle, oversized keys and rows without a ship dealt over salts."""
    named = F.col("position_id") % 13 != 0
    rows = t.staging.withColumn("mmsi", F.when(named, F.col("mmsi")))
    return _short(
        positions.build_positions(
            rows, t.ships, t.statuses, broadcast_rows=0, limit=t.low_limit
        )
    )


def dwh_update(t: Tables) -> DataFrame:
    ids = positions.id_range(t.newer).first()
    added = positions.build_positions(t.staging, t.ships, t.statuses, (ids["min_id"], ids["max_id"]))
    return _short(added)


def deltas(t: Tables) -> DataFrame:
    return t.rows.select(
        "ship_id",
        "gps_timestamp",
        "position_id",
        "nav_status",
        "nav_status_prev",
        detect.elapsed_seconds().alias("delta_seconds"),
    )


def transitions(t: Tables) -> DataFrame:
    return t.flagged.select(*detect.REPORT, "start_engine", "stop_engine", "start_after_gap")


def boundaries(t: Tables) -> DataFrame:
    return detect.boundaries(t.flagged, t.slicing).select(
        *detect.REPORT, "start_trajectory", "stop_trajectory"
    )


def voyage_limits(t: Tables) -> DataFrame:
    return t.limits


def voyage_limits_cut(t: Tables) -> DataFrame:
    """The same voyages, with the crowded ships cut into slices."""
    return detect.find_voyages(t.positions, t.statuses, limit=t.low_limit)


def voyage_limits_wide_gap(t: Tables) -> DataFrame:
    return detect.limits_of(t.positions, t.statuses, t.slicing, WIDE_GAP_SECONDS)


def _incremental(t: Tables, mode: str) -> DataFrame:
    found = detect.find_voyages(
        t.positions, t.statuses, t.earlier_limits, mode=mode, fullest=t.ships.fullest
    )
    return t.closed_limits.unionByName(found)


def voyage_incremental(t: Tables) -> DataFrame:
    return _incremental(t, "parity")


def voyage_incremental_carry(t: Tables) -> DataFrame:
    return _incremental(t, "carry")


def late_positions(t: Tables) -> DataFrame:
    """Some reports arrive 20 days late; which of them will no increment read?"""
    is_late = (F.col("load_date") > ntz(MARK)) & (
        F.col("position_id") % 50 == 0
    )
    moved = F.col("gps_timestamp") - F.expr("INTERVAL '20' DAY")
    arrived = t.positions.withColumn(
        "gps_timestamp", F.when(is_late, moved).otherwise(F.col("gps_timestamp"))
    )
    return positions.late_positions(arrived, t.earlier_limits, MARK)


def voyage_points(t: Tables) -> DataFrame:
    points = export.voyage_points(t.limits, t.positions, t.slicing)
    return _short(points.filter(F.col("seq").isNotNull())).select(
        "ship_id", "datetime_start", "seq", "gps_timestamp", "longitude", "latitude",
        "sog", "cog", "heading",
    )


def _vectors(lines: DataFrame) -> DataFrame:
    """One row per element of the exported vectors."""
    elements = F.arrays_zip(
        "coordinates", "timestamps", "speed_over_ground", "course_over_ground", "heading"
    )
    rows = lines.select(
        "ship_id",
        "mmsi",
        "datetime_start",
        "datetime_stop",
        F.posexplode(elements).alias("at", "e"),
        (F.col("part") * export.MAX_POINTS).alias("before"),
    )
    return rows.select(
        "ship_id",
        "mmsi",
        "datetime_start",
        "datetime_stop",
        (F.col("before") + F.col("at")).cast("bigint").alias("seq"),
        F.col("e.timestamps").alias("gps_timestamp"),
        F.col("e.coordinates.lon").alias("longitude"),
        F.col("e.coordinates.lat").alias("latitude"),
        F.col("e.speed_over_ground").alias("sog"),
        F.col("e.course_over_ground").alias("cog"),
        F.col("e.heading").alias("heading"),
    )


def trajectory_vectors(t: Tables) -> DataFrame:
    return _vectors(export.export_trajectories(t.limits, t.positions, t.ships, slicing=t.slicing))


def trajectory_vectors_cut(t: Tables) -> DataFrame:
    """The same lines, with the crowded ships cut into slices."""
    lines = export.export_trajectories(t.limits, t.positions, t.ships, limit=t.low_limit)
    return _vectors(lines)


def trajectory_parts(t: Tables) -> DataFrame:
    """Voyages of more than FEW_POINTS reports continue in further rows."""
    limits = detect.limits_of(t.positions, t.statuses, t.slicing, WIDE_GAP_SECONDS)
    lines = export.export_trajectories(
        limits, t.positions, t.ships, max_points=FEW_POINTS, slicing=t.slicing
    )
    return lines.select(
        "ship_id",
        "mmsi",
        "datetime_start",
        F.col("part").cast("bigint").alias("part"),
        F.size("timestamps").cast("bigint").alias("n_points"),
        F.element_at("timestamps", -1).alias("last_report"),
    )


def _line_ends(lines: DataFrame) -> DataFrame:
    """Per voyage, size and ends as read back out of the arrays of its parts."""

    def first(array: str, field: str = "") -> F.Column:
        return F.min_by(F.element_at(array, 1)[field] if field else F.element_at(array, 1), "part")

    def last(array: str, field: str = "") -> F.Column:
        return F.max_by(F.element_at(array, -1)[field] if field else F.element_at(array, -1), "part")

    nulls = F.size("heading") - F.size(F.array_compact("heading"))
    return lines.groupBy("ship_id", "mmsi", "datetime_start", "datetime_stop").agg(
        F.sum(F.size("timestamps")).cast("bigint").alias("n_points"),
        F.sum(nulls).cast("bigint").alias("n_null_heading"),
        first("coordinates", "lon").alias("first_lon"),
        first("coordinates", "lat").alias("first_lat"),
        last("coordinates", "lon").alias("last_lon"),
        last("coordinates", "lat").alias("last_lat"),
        first("heading").alias("first_heading"),
        last("heading").alias("last_heading"),
    )


def trajectory_export(t: Tables) -> DataFrame:
    """All ships, given as the range from the smallest to the largest ship id."""
    ids = (1, t.ships.count)
    limits = detect.limits_of(t.positions, t.statuses, t.slicing, WIDE_GAP_SECONDS)
    return _line_ends(
        export.export_trajectories(
            limits, t.positions, t.ships, ship_range=ids, slicing=t.slicing
        )
    )


def trajectory_range(t: Tables) -> DataFrame:
    """The first half of the ships, by a range of ids."""
    lines = export.export_trajectories(
        t.limits, t.positions, t.ships, ship_range=(1, t.ships.count // 2)
    )
    return _line_ends(lines)


def export_one_ship(t: Tables) -> DataFrame:
    """The ship with the most reports."""
    counts = t.positions.groupBy("ship_id").agg(F.count(F.lit(1)).alias("n"))
    busiest = counts.orderBy(F.col("n").desc(), "ship_id").first()["ship_id"]
    lines = export.export_trajectories(
        t.limits, t.positions, t.ships, ship_id=busiest, slicing=t.slicing if not t.slicing.cut else None
    )
    return _line_ends(lines)


def find_and_export(t: Tables) -> DataFrame:
    _, lines = export.find_and_export(
        t.positions, t.statuses, t.ships, t.earlier_limits, fullest=t.ships.fullest
    )
    return _line_ends(lines)


def dq_duplicate_keys(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.staging, "mmsi")


def dq_orphans(t: Tables) -> DataFrame:
    first = F.col("load_date") <= ntz(FIRST_MARK)
    ships = dimensions.add_new_keys(t.staging.filter(first), None, "mmsi")
    sited = t.staging.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return quality.orphans(sited, ships, "mmsi").select("position_id", "mmsi")


def dq_constraints(t: Tables) -> DataFrame:
    """The rules over the tables, with the ships of the loads up to FIRST_MARK alone."""
    first = F.col("load_date") <= ntz(FIRST_MARK)
    ships = dimensions.add_new_keys(t.staging.filter(first), None, "mmsi")
    known = lookup(t.ships.rows, ships.select("mmsi"), "mmsi", "left_semi", spread="id")
    return quality.constraint_report(t.staging, known, t.statuses, t.positions, t.limits)


def _as_csv(t: Tables, spoil: bool) -> str:
    """The staging rows and the events' props as CSV files in the shared folder."""
    rows = staging_from_events(t.spark, t.sf_dir, "props").drop("load_date")
    if spoil:
        nth = F.col("position_id")
        rows = rows.withColumns(
            {
                "latitude": F.when(nth % 89 == 0, "n/a").otherwise(F.col("latitude").cast("string")),
                "mmsi": F.when(nth % 97 != 0, F.col("mmsi")),
                "gps_timestamp": F.when(nth % 83 == 0, "yesterday").otherwise(
                    F.col("gps_timestamp").cast("string")
                ),
            }
        )
    path = scratch_path(t.spark, "csv")
    headers = {name: header for header, name in CSV_COLUMNS.items()}
    # The JSON in props has quotes and commas, in a column the reader must pass over.
    rows.select(
        "props",
        *[F.col(name).alias(header) for name, header in sorted(headers.items())],
    ).write.option("header", True).option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
    ).csv(path)
    return path


def _ingested(rows: DataFrame) -> DataFrame:
    return _short(rows.drop("position_id", "load_date"))


def ingest_strict(t: Tables) -> DataFrame:
    return _ingested(ingest_csv(t.spark, _as_csv(t, spoil=False))[0])


def ingest_lenient(t: Tables) -> DataFrame:
    return _ingested(ingest_csv(t.spark, _as_csv(t, spoil=True), mode="lenient")[0])


def ingest_rejects(t: Tables) -> DataFrame:
    rejects = ingest_csv(t.spark, _as_csv(t, spoil=True), mode="lenient")[1]
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _warehouse(t: Tables, mode: str | None = None) -> Warehouse:
    """The jobs over new tables: two loads, each brought in and searched for voyages."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    for load_id, rows in (("1", t.loaded), ("2", t.newer)):
        store_load(warehouse, load_id, MARK, rows, None)
        update_warehouse(warehouse)
        if mode:
            run_voyages(warehouse, mode)
    return warehouse


def ingest_mixed_headers(t: Tables) -> DataFrame:
    """Two folders of files whose columns differ in order and number, with the ids and stamp of the load."""
    rows = staging_from_events(t.spark, t.sf_dir, "props").drop("load_date")
    path = scratch_path(t.spark, "mixed-csv")
    headers = {name: header for header, name in CSV_COLUMNS.items()}
    ordered = [F.col(name).alias(header) for name, header in sorted(headers.items())]
    kinds = (["props", *ordered], [*reversed(ordered[:4]), F.lit("a,b").alias("Note"), *ordered[4:], "props"])
    for n, columns in enumerate(kinds):
        some = rows.filter(F.col("position_id") % 2 == n).select(*columns)
        some.write.option("header", True).option("escape", '"').option(
            "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"
        ).csv(f"{path}/{n}")
    got = ingest_csv(t.spark, path, load_date=MARK, mixed_headers=True)[0]
    ids = got.groupBy("position_id").agg(F.count(F.lit(1)).alias("rows_of_id"))
    return _short(got.join(ids, "position_id").drop("position_id"))


def trajectory_lines(t: Tables) -> DataFrame:
    """The lines as well-known text, a voyage in parts of FEW_POINTS reports."""
    limits = detect.limits_of(t.positions, t.statuses, t.slicing, WIDE_GAP_SECONDS)
    lines = export.export_trajectories(limits, t.positions, t.ships, max_points=FEW_POINTS, slicing=t.slicing)
    return export.line_texts(lines).select(
        "ship_id", "mmsi", "datetime_start", F.col("part").cast("bigint").alias("part"), "n_parts", "line"
    )


def dq_all_rules(t: Tables) -> DataFrame:
    """Every rule with rows that break it: spoilt staging rows, few ships, and few of the voyages."""
    nth = F.col("position_id")
    staging = t.staging.withColumns(
        {
            "mmsi": F.when(nth % 211 == 0, F.rpad("mmsi", 21, "0")).when(nth % 97 != 0, F.col("mmsi")),
            "nav_status": F.when(nth % 89 != 0, F.col("nav_status")),
            "gps_timestamp": F.when(nth % 83 != 0, F.col("gps_timestamp")),
            "longitude": F.when(nth % 79 != 0, F.col("longitude")),
        }
    )
    ships = t.ships.rows.filter("id % 5 > 0")
    ships = ships.unionByName(ships.filter("id % 7 = 0").withColumn("id", F.col("id") + 1_000_000))
    statuses = t.statuses.rows.filter("id > 1")
    statuses = statuses.unionByName(statuses.filter("id = 2").withColumn("id", F.lit(100).cast("bigint")))
    sited = t.positions.withColumn("latitude", F.when(nth % 73 != 0, F.col("latitude")))
    limits = t.limits.withColumns(
        {
            "id": F.xxhash64("ship_id", "datetime_start"),
            "datetime_stop": F.when(F.col("ship_id") % 11 != 0, F.col("datetime_stop")),
        }
    )
    lines = limits.select(F.col("id").alias("trajectory_id"), "datetime_start", "ship_id")
    return quality.constraint_report(staging, ships, statuses, sited, limits.filter("ship_id % 13 > 0"), lines)


def warehouse_full_recompute(t: Tables) -> DataFrame:
    """Late reports and a repeated load, taken in: every fiftieth early report comes last, and the
    second load again without every seventh report."""
    warehouse = Warehouse(t.spark, scratch_path(t.spark, "warehouse"))
    late = F.col("position_id") % 50 == 0
    loads = (
        ("1", t.loaded.filter(~late)),
        ("2", t.newer),
        ("3", t.loaded.filter(late)),
        ("2", t.newer.filter(F.col("position_id") % 7 != 0)),
    )
    for load_id, rows in loads:
        store_load(warehouse, load_id, MARK, rows, None)
        update_warehouse(warehouse)
        run_voyages(warehouse, increment="full")
    ships = warehouse.read("ships").withColumnRenamed("id", "ship_id")
    found = lookup(warehouse.limits(), ships, "ship_id", spread="datetime_start")
    return found.select("mmsi", "datetime_start", "datetime_stop", "is_open")


def warehouse_repeat(t: Tables) -> DataFrame:
    """The positions after a load was repeated without every seventh report, and all were compacted."""
    warehouse = _warehouse(t)
    store_load(warehouse, "2", MARK, t.newer.filter(F.col("position_id") % 7 != 0), None)
    update_warehouse(warehouse)
    warehouse.compact()
    warehouse.remove_replaced()
    return _short(warehouse.positions().drop("load_id", "gps_date"))


def warehouse_voyage_ids(t: Tables) -> DataFrame:
    """The stored voyages with the ids that two runs gave them."""
    found = _warehouse(t, "find").limits()
    return found.select("id", "ship_id", "datetime_start", "is_open")


def warehouse_positions(t: Tables) -> DataFrame:
    return _short(_warehouse(t).positions().drop("load_id", "gps_date"))


def warehouse_limits(t: Tables) -> DataFrame:
    found = _warehouse(t, "find").limits()
    return found.select("ship_id", "datetime_start", "datetime_stop", "is_open")


def warehouse_exports(t: Tables) -> DataFrame:
    return _vectors(_warehouse(t, "find_export").exports())


QUERIES = {
    "staging_count": staging_count,
    "ingest_strict": ingest_strict,
    "ingest_lenient": ingest_lenient,
    "ingest_rejects": ingest_rejects,
    "new_rows_watermark": new_rows_watermark,
    "new_row_range": new_row_range,
    "reject_rows": reject_rows,
    "dim_ships": dim_ships,
    "dim_ships_spread": dim_ships_spread,
    "dim_nav_statuses": dim_nav_statuses,
    "positions": all_positions,
    "positions_salted": positions_salted,
    "dwh_update": dwh_update,
    "deltas": deltas,
    "transitions": transitions,
    "boundaries": boundaries,
    "voyage_limits": voyage_limits,
    "voyage_limits_cut": voyage_limits_cut,
    "voyage_limits_wide_gap": voyage_limits_wide_gap,
    "voyage_points": voyage_points,
    "trajectory_vectors": trajectory_vectors,
    "trajectory_vectors_cut": trajectory_vectors_cut,
    "trajectory_parts": trajectory_parts,
    "trajectory_range": trajectory_range,
    "trajectory_export": trajectory_export,
    "export_one_ship": export_one_ship,
    "find_and_export": find_and_export,
    "voyage_incremental": voyage_incremental,
    "voyage_incremental_carry": voyage_incremental_carry,
    "late_positions": late_positions,
    "warehouse_positions": warehouse_positions,
    "warehouse_limits": warehouse_limits,
    "warehouse_exports": warehouse_exports,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_orphans": dq_orphans,
    "dq_constraints": dq_constraints,
    "dq_all_rules": dq_all_rules,
    "ingest_mixed_headers": ingest_mixed_headers,
    "trajectory_lines": trajectory_lines,
    "warehouse_full_recompute": warehouse_full_recompute,
    "warehouse_repeat": warehouse_repeat,
    "warehouse_voyage_ids": warehouse_voyage_ids,
}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: QUERIES[name](Tables(spark, sf_dir))
