"""The jobs over stored tables, run in increments."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fairlead.__main__ import main, parser
from fairlead.operators.detect import find_voyages
from fairlead.operators.positions import build_positions
from fairlead.plans.queries import Tables
from fairlead.plans.voyages import run_voyages
from fairlead.plans.warehouse import load_csv, store_load, update_warehouse
from fairlead.schemas import LIMITS, STAGING
from fairlead.sources.events import staging_from_events
from fairlead.sources.tables import Warehouse
from fairlead.streaming.csv_stream import stream_csv
from test_csv import BAD_FILE, SHUFFLED, line, write

LIMIT = ["ship_id", "datetime_start", "datetime_stop", "is_open"]


def load_days(warehouse, staging, after, until):
    """Store the loads of the test table's days in (after, until] as one load each."""
    dates = [r[0] for r in staging.select("load_date").distinct().orderBy("load_date").collect()]
    for date in dates:
        if after < date <= until:
            rows = staging.filter(F.col("load_date") == F.lit(str(date)).cast("timestamp_ntz"))
            store_load(warehouse, date.strftime("%Y%m%d"), date, rows, None)


def rows(frame, columns=LIMIT):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory, sf_dir):
    """Three increments: find, find and export, find and export."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("filled")))
    staging = staging_from_events(spark, sf_dir)
    marks = [datetime(2024, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 12), datetime(2024, 2, 9)]
    for n, (after, until) in enumerate(zip(marks, marks[1:])):
        load_days(warehouse, staging, after, until)
        assert update_warehouse(warehouse) is not None
        run_voyages(warehouse, "find" if n == 0 else "find_export")
    return warehouse


def test_increments_equal_one_full_run(filled):
    positions = filled.positions()
    assert positions.count() == 990
    full = find_voyages(positions, filled.read("nav_statuses"))
    assert rows(filled.limits()) == rows(full)
    ids = [r["id"] for r in filled.limits().select("id").collect()]
    assert len(ids) == len(set(ids)) and min(ids) >= 1


def test_dimensions_hold_each_key_once(filled):
    ships = filled.read("ships").collect()
    assert sorted(s["id"] for s in ships) == list(range(1, 16))
    assert len({s["mmsi"] for s in ships}) == 15
    assert filled.read("nav_statuses").count() == 3


def test_nothing_pending_after_an_update(filled):
    assert update_warehouse(filled) is None


def test_positions_are_pruned_by_day(filled):
    day = F.lit("2024-01-05").cast("date")
    plan = filled.positions().filter(F.col("gps_date") == day)
    assert {r[0] for r in plan.select("gps_date").distinct().collect()} == {datetime(2024, 1, 5).date()}
    files = plan.inputFiles()
    assert files
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "gps_date" in text


def test_exports_follow_the_limits(filled):
    # The first run did not export, so its closed voyages are missing until "export".
    limits, exports = rows(filled.limits()), rows(filled.exports())
    assert set(exports) < set(limits)
    assert {x for x in limits if x[3]} <= set(exports)
    run_voyages(filled, "export")
    assert rows(filled.exports()) == rows(filled.limits())
    run_voyages(filled, "export", ship_range=(1, 4))
    assert rows(filled.exports()) == rows(filled.limits())
    by_id = ["trajectory_id", *LIMIT]
    assert rows(filled.exports(), by_id) == rows(filled.limits(), ["id", *LIMIT])


def test_finding_again_finds_nothing_new(filled):
    before = rows(filled.limits())
    run_voyages(filled, "find_export", ship_range=(3, 9))
    assert rows(filled.limits()) == before
    assert rows(filled.exports()) == before


def test_parity_increment_loses_voyages_the_reference_loses(spark, tmp_path, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path))
    staging = staging_from_events(spark, sf_dir)
    for after, until in [(datetime(2024, 1, 1), datetime(2024, 1, 16)),
                         (datetime(2024, 1, 16), datetime(2024, 2, 9))]:
        load_days(warehouse, staging, after, until)
        update_warehouse(warehouse)
        run_voyages(warehouse, increment="parity")
    full = find_voyages(warehouse.positions(), warehouse.read("nav_statuses"))
    assert set(rows(warehouse.limits())) < set(rows(full))


def test_a_load_or_run_that_was_not_logged_does_not_count(spark, tmp_path, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path))
    staging = staging_from_events(spark, sf_dir)
    first, last = datetime(2024, 1, 1), datetime(2024, 1, 3)
    load_days(warehouse, staging, first, last)
    update_warehouse(warehouse)
    run_voyages(warehouse, "find_export")
    before = rows(warehouse.limits())
    # A load and a run that died before their log entries ...
    extra = staging.limit(5).withColumn("load_id", F.lit("20240201"))
    warehouse.replace_partitions("staging", extra, ["load_id"])
    stray = warehouse.read("limits").withColumn("run_id", F.lit(2).cast("bigint"))
    warehouse.replace_partitions("limits", stray, ["run_id", "is_open"])
    assert warehouse.staging().count() == sum(load["rows"] for load in warehouse.loads())
    assert update_warehouse(warehouse) is None
    assert rows(warehouse.limits()) == before
    # ... do not show up with the next attempt either.
    run_voyages(warehouse, "find_export")
    assert rows(warehouse.limits()) == before
    # Loading the same load again replaces it too.
    load_days(warehouse, staging, first, last)
    assert warehouse.staging().count() == warehouse.staging().select("position_id").distinct().count()


def test_command_line(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.csv", *BAD_FILE)
    lines = [line(mmsi="7", ts=f"2024-01-01 00:{m:02}:00") for m in range(0, 60, 5)]
    lines[0] = lines[0].replace("Engine", "Moored")
    write(folder, "deep/b.csv", SHUFFLED, *lines)
    root = str(tmp_path / "wh")
    with pytest.raises(Exception):
        main(["-w", root, "load", "-f", str(folder)], spark)
    main(["-w", root, "load", "-f", str(folder), "--lenient"], spark)
    warehouse = Warehouse(spark, root)
    assert warehouse.staging().count() == 3 + 12
    assert warehouse.read("rejects").count() == 3
    main(["-w", root, "update"], spark)
    main(["-w", root, "update"], spark)
    assert warehouse.positions().count() == 15
    assert warehouse.read("refused").count() == 0
    main(["-w", root, "voyages", "--export"], spark)
    main(["-w", root, "voyages", "--skip_finding"], spark)
    main(["-w", root, "voyages", "--skip_finding", "--export"], spark)
    (voyage,) = warehouse.exports().collect()
    assert voyage["mmsi"] == "7" and len(voyage["timestamps"]) == 11 and voyage["is_open"]
    with pytest.raises(SystemExit):
        parser().parse_args(["-w", root, "load", "-f", "x", "-c", "y"])


def test_strict_update_fails_on_a_row_without_a_point(spark, tmp_path):
    write(tmp_path, "in/a.csv", SHUFFLED, line(lat=""))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert load_csv(warehouse, str(tmp_path / "in")) == 1
    with pytest.raises(ValueError, match="position 1: latitude is missing"):
        update_warehouse(warehouse, strict=True)
    assert warehouse.positions().count() == 0
    update_warehouse(warehouse)
    assert warehouse.positions().count() == 0 and warehouse.read("ships").count() == 1
    (refused,) = warehouse.read("refused").collect()
    assert (refused["position_id"], refused["reason"]) == (1, "latitude is missing")


def test_building_positions_strictly_fails_on_a_missing_point(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    built = build_positions(tables.staging, tables.ships, tables.statuses, strict=True)
    with pytest.raises(Exception, match="no point"):
        built.collect()


def test_streamed_files_are_loaded_once(spark, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def run():
        query = stream_csv(warehouse, str(folder), checkpoint)
        assert query.awaitTermination(120)

    write(folder, "a.csv", *BAD_FILE)
    run()
    assert warehouse.staging().count() == 3 and warehouse.read("rejects").count() == 3
    run()
    assert warehouse.staging().count() == 3
    write(folder, "b.csv", SHUFFLED, line(mmsi="9"), line(mmsi="9"))
    run()
    staged = warehouse.staging()
    assert staged.count() == 5 and staged.select("position_id").distinct().count() == 5
    assert len(warehouse.pending_loads()) == 2
    low, high = update_warehouse(warehouse)
    assert low < high and warehouse.positions().count() == 5
    assert warehouse.load_mark() <= datetime.now() + timedelta(days=1)


def random_reports(seed, late, ships=12):
    """Six loads of reports of ships with different habits: (load, staging row) pairs."""
    pick = random.Random(seed)
    out = []
    for ship in range(ships):
        # A ship that never moves, one that never stops, and others in between.
        change = {0: 0.0, 1: 0.0, 2: 0.9}.get(ship, 0.25)
        status = "Engine" if ship in (1, 5, 6) else "Moored"
        time = datetime(2024, 1, 1) + timedelta(minutes=pick.randrange(60))
        while time < datetime(2024, 1, 1, 12):
            if pick.random() < change:
                status = pick.choice(["Engine", "Engine", "Moored", "At anchor"])
            load = int((time - datetime(2024, 1, 1)).total_seconds() // 7200)
            if late and pick.random() < 0.05:
                load = min(load + pick.randrange(1, 3), 5)
            out.append((load, time, f"ship{ship:02}", status))
            time += timedelta(minutes=pick.choice([0, 5, 10, 15, 16, 40, 90]))
    out.sort(key=lambda r: r[0])
    rows = [
        (n, time, mmsi, 1.0, 2.0, status, None, None, None, datetime(2024, 1, 2 + load))
        for n, (load, time, mmsi, status) in enumerate(out)
    ]
    return [[r for r in rows if r[-1].day == 2 + load] for load in range(6)]


@pytest.mark.parametrize("seed, late", [(1, False), (2, True)])
def test_resumed_runs_equal_runs_from_the_last_stop(spark, tmp_path, seed, late):
    warehouse = Warehouse(spark, str(tmp_path))
    stored = spark.createDataFrame([], LIMITS)
    for load, reports in enumerate(random_reports(seed, late)):
        staging = spark.createDataFrame(reports, STAGING)
        store_load(warehouse, str(load), datetime(2024, 1, 2 + load), staging, None)
        update_warehouse(warehouse)
        run_voyages(warehouse)
        positions, statuses = warehouse.positions(), warehouse.read("nav_statuses")
        found = find_voyages(positions, statuses, stored)
        kept = stored.filter(~F.col("is_open")).unionByName(found).collect()
        stored = spark.createDataFrame(kept, LIMITS)
        assert rows(warehouse.limits()) == rows(stored), load
    full = rows(find_voyages(warehouse.positions(), statuses))
    assert (rows(stored) == full) != late
    assert len(full) > 20
    # The ship that lay moored throughout was not read from its first report again.
    states = warehouse.read("states").collect()
    last = max(s["run_id"] for s in states)
    idle = [s for s in states if s["run_id"] == last and not s["bounded"]]
    assert any(s["resume_from"] == s["seen_until"] for s in idle)
