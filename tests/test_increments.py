"""Late reports, repeated loads, what an increment reads, and the layout of the positions."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fairlead.operators import export
from fairlead.operators.detect import find_voyages
from fairlead.operators.dimensions import add_new_keys, update_dimensions
from fairlead.operators.keys import oversized
from fairlead.operators.slices import Slicing
from fairlead.plans.queries import Tables
from fairlead.plans.voyages import run_voyages
from fairlead.plans.warehouse import load_csv, store_load, update_warehouse
from fairlead.schemas import CSV_COLUMNS, STAGING
from fairlead.session import shared_dir
from fairlead.sources.csv import ingest_csv
from fairlead.sources import tables
from fairlead.sources.tables import BLOCK, Warehouse
from fairlead.streaming.csv_stream import stream_csv
from test_jobs import random_reports, rows
from test_scale import crowd, plan

STAMP = datetime(2024, 1, 2)


def load(warehouse, load_id, reports):
    frame = warehouse.spark.createDataFrame(reports, STAGING)
    store_load(warehouse, load_id, STAMP, frame, None)
    update_warehouse(warehouse)


def anew(warehouse):
    return rows(find_voyages(warehouse.positions(), warehouse.read("nav_statuses")))


def test_full_increments_equal_one_run(spark, tmp_path):
    """After every load, also of late reports, and after loads repeated with fewer and other reports."""
    warehouse = Warehouse(spark, str(tmp_path))
    loads = random_reports(3, late=True, ships=10)
    for n, reports in enumerate(loads):
        load(warehouse, str(n), reports)
        if n in (0, 1, 3, 5):
            run = run_voyages(warehouse, "find_export" if n != 3 else "find", increment="full")
            assert rows(warehouse.limits()) == anew(warehouse), n
            assert n or (run.late, run.taken_back) == (0, 0)
    assert any(run.late and run.taken_back for run in warehouse.runs())
    pick = random.Random(4)
    for n in (1,):
        load(warehouse, str(n), [r for r in loads[n] if pick.random() < 0.6 and r[2] != "ship03"])
        run_voyages(warehouse, "find_export", increment="full")
        assert rows(warehouse.limits()) == anew(warehouse), n
    # A repeat that is not brought in yet has taken its reports away, too.
    store_load(warehouse, "5", STAMP, spark.createDataFrame([], STAGING), None)
    run_voyages(warehouse, increment="full")
    assert rows(warehouse.limits()) == anew(warehouse)
    warehouse.compact()
    load(warehouse, "5", loads[5])
    run_voyages(warehouse, "find_export", increment="full")
    run_voyages(warehouse, "export")
    assert rows(warehouse.limits()) == anew(warehouse)
    assert rows(warehouse.exports()) == rows(warehouse.limits())
    ids = [r["id"] for r in warehouse.limits().select("id").collect()]
    assert len(ids) == len(set(ids))


def test_a_full_run_mends_what_carry_left_out(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    late = 0
    loads = random_reports(2, late=True, ships=8)
    for n in range(3):
        load(warehouse, str(n), loads[2 * n] + loads[2 * n + 1])
        late += run_voyages(warehouse).late
    assert late and rows(warehouse.limits()) != anew(warehouse)
    run = run_voyages(warehouse, increment="full")
    assert run.taken_back and rows(warehouse.limits()) == anew(warehouse)
    with pytest.raises(ValueError):
        run_voyages(warehouse, increment="full", ship_range=(1, 2))


def test_a_job_takes_its_scratch_tables_with_it(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    load(warehouse, "1", random_reports(1, late=False, ships=3)[0])
    run_voyages(warehouse, "find_export")
    assert set(os.listdir(folder)) == before and warehouse.limits().count()


def test_an_increment_reads_new_reports_only(spark, tmp_path, monkeypatch):
    """Ships without late reports are resumed: neither their old reports nor their voyages are read."""
    warehouse = Warehouse(spark, str(tmp_path))
    loads = random_reports(1, late=False)
    for n in range(2):
        load(warehouse, str(n), loads[2 * n] + loads[2 * n + 1] + loads[4] * n)
        run_voyages(warehouse)
    last = warehouse.last_run().update_id
    load(warehouse, "last", loads[-1])
    seen, stops = [], []
    read = Warehouse._positions
    monkeypatch.setattr(Warehouse, "_positions", lambda self, after=0: seen.append(after) or read(self, after))
    monkeypatch.setattr("fairlead.operators.increment.last_stops", lambda limits: stops.append(1))
    run_voyages(warehouse)
    assert seen and min(seen) >= last and not stops
    files = read(warehouse, last).inputFiles()
    assert files and all(f"update_id={warehouse.last_update()}" in f for f in files)
    monkeypatch.undo()
    assert rows(warehouse.limits()) == anew(warehouse)


@pytest.mark.parametrize("limit", [None, 5])
def test_a_full_run_counts_its_reports_once(spark, tmp_path, monkeypatch, limit):
    """How many reports each ship has comes with its last one; crowded ships are still counted and cut."""
    counted = []
    monkeypatch.setattr("fairlead.operators.slices.oversized", lambda *a: counted.append(a) or oversized(*a))
    # Voyages taken back are too many to be broadcast.
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    if limit:
        monkeypatch.setattr("fairlead.operators.keys.MIN_GROUP_ROWS", limit)
        monkeypatch.setattr("fairlead.operators.slices.MIN_GROUP_ROWS", limit)
    warehouse = Warehouse(spark, str(tmp_path))
    loads = random_reports(3, late=True, ships=6)
    for reports in (loads[0], loads[1], loads[3], loads[2]):
        load(warehouse, str(len(warehouse.runs())), reports)
        run_voyages(warehouse, increment="full")
        assert bool(counted) == bool(limit)
        assert rows(warehouse.limits()) == anew(warehouse)
        counted.clear()
    assert any(run.taken_back for run in warehouse.runs())
    assert "LeftAnti" in plan(warehouse.limits()) and "salt" not in plan(warehouse.limits())
    assert "Exchange" not in plan(warehouse._current_loads())


def test_dimensions_read_the_rows_once(spark, sf_dir):
    staging = Tables(spark, sf_dir).staging
    staging = staging.withColumn("mmsi", F.when(F.col("position_id") % 9 > 0, F.col("mmsi")))
    for found, key in zip(update_dimensions(staging), ("mmsi", "nav_status")):
        alone = add_new_keys(staging, None, key)
        assert "dimension-keys" in plan(found.rows) and (found.count, found.fullest) == (alone.count, alone.fullest)
        assert rows(found.rows, ["id", key]) == rows(alone.rows, ["id", key])


def test_a_repeat_that_dies_leaves_all_as_it_was(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    loads = random_reports(5, late=False, ships=4)
    load(warehouse, "a", loads[0])
    load(warehouse, "b", loads[1])
    before = rows(warehouse.positions(), ["position_id", "ship_id"])

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "log_load", die)
        with pytest.raises(RuntimeError):
            store_load(warehouse, "a", STAMP, spark.createDataFrame(loads[0][:3], STAGING), None)
    assert rows(warehouse.positions(), ["position_id", "ship_id"]) == before
    assert warehouse.staging(["a"]).count() == len(loads[0]) and update_warehouse(warehouse) is None
    store_load(warehouse, "a", STAMP, spark.createDataFrame(loads[0][:3], STAGING), None)
    assert warehouse.positions().count() == len(loads[1])
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "log_update", die)
        with pytest.raises(RuntimeError):
            update_warehouse(warehouse)
    assert warehouse.positions().count() == len(loads[1])
    update_warehouse(warehouse)
    assert warehouse.positions().count() == len(loads[1]) + 3


def test_compaction(spark, tmp_path, sf_dir):
    """A file per day instead of one per load and day, the same rows, and updates go on."""
    warehouse = Warehouse(spark, str(tmp_path))
    staging = Tables(spark, sf_dir).staging
    for n in range(4):
        store_load(warehouse, str(n), STAMP, staging.filter(f"position_id % 5 = {n}"), None)
        update_warehouse(warehouse)
    run_voyages(warehouse)
    before = rows(warehouse.positions(), ["position_id", "ship_id", "load_id"])
    many = len(warehouse.positions().inputFiles())
    assert warehouse.compact() and warehouse.remove_replaced() == 4
    days = warehouse.positions().select("gps_date").distinct().count()
    assert days <= len(warehouse.positions().inputFiles()) < many / 2
    assert rows(warehouse.positions(), ["position_id", "ship_id", "load_id"]) == before
    store_load(warehouse, "4", STAMP, staging.filter("position_id % 5 = 4"), None)
    store_load(warehouse, "1", STAMP, staging.filter("position_id % 10 = 1"), None)
    update_warehouse(warehouse)
    assert warehouse.positions().count() == staging.filter("latitude is not null and (position_id % 5 <> 1 or position_id % 10 = 1)").count()
    run_voyages(warehouse, increment="full")
    assert rows(warehouse.limits()) == anew(warehouse)
    assert Warehouse(spark, str(tmp_path / "none")).compact() is None


def test_rows_are_not_dealt_by_load(spark, tmp_path, monkeypatch):
    """A load may have any number of rows, so none of its rows meet in one task for its name."""
    warehouse = Warehouse(spark, str(tmp_path))
    loads = random_reports(5, late=False, ships=6)[:3]
    for n, reports in enumerate(loads):
        load(warehouse, str(n), reports)
    run_voyages(warehouse, increment="full")
    load(warehouse, "1", loads[1][::2])
    written = []
    write = Warehouse.write_positions
    monkeypatch.setattr(Warehouse, "write_positions", lambda self, rows, number: written.append(rows) or write(self, rows, number))
    names = spark.createDataFrame([("0",), ("2",)], "attempt string")
    staged = warehouse.attempts(names)
    assert "PartitionFilters: [load_id" in plan(staged)
    gone = warehouse.withdrawn(warehouse.last_run(finding=True).run_id)
    number = warehouse.compact()
    for frame in (staged, gone, *written):
        assert "Exchange" not in plan(frame)
    kept = ["position_id", "ship_id"]
    assert sorted(r[0] for r in staged.select("position_id").collect()) == sorted(r[0] for n in (0, 2) for r in loads[n])
    compacted = spark.read.parquet(f"{warehouse.path('positions')}/update_id={number}")
    assert compacted.count() == sum(map(len, loads)) + len(loads[1][::2])
    # More names than are listed: the same rows, still without a shuffle.
    few = rows(staged, ["position_id"]), rows(warehouse.positions(), kept), rows(gone, kept)
    monkeypatch.setattr(tables, "NAMED", 1)
    staged, gone = warehouse.attempts(names), warehouse.withdrawn(warehouse.last_run(finding=True).run_id)
    assert (rows(staged, ["position_id"]), rows(warehouse.positions(), kept), rows(gone, kept)) == few
    assert "Exchange hashpartitioning(load_id" not in plan(staged) and "BroadcastHashJoin" in plan(staged)


def test_row_groups_know_their_ships(spark, tmp_path, sf_dir):
    warehouse = Warehouse(spark, str(tmp_path))
    store_load(warehouse, "1", STAMP, Tables(spark, sf_dir).staging, None)
    update_warehouse(warehouse)
    file = max((f.removeprefix("file://") for f in warehouse.positions().inputFiles()), key=os.path.getsize)
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(file), spark._jsc.hadoopConfiguration()
        )
    )
    columns = footer.getFooter().getBlocks().get(0).getColumns()
    filtered = {str(c.getPath().toDotString()) for c in columns if c.getBloomFilterOffset() > 0}
    footer.close()
    assert "ship_id" in filtered


def test_ids_of_interleaved_loads(spark, tmp_path):
    warehouse, other = (Warehouse(spark, str(tmp_path)) for _ in range(2))
    first, second = (w.reserve_ids(40) for w in (warehouse, other))
    frame = spark.range(0, 400, 1, 40)
    ids = [r[0] for c in (first, second) for r in frame.select(c).collect()]
    assert len(set(ids)) == 800 and min(ids) == 1
    # A load that was given its ids elsewhere moves the next block on.
    warehouse.log_load(STAMP, 1, 7 * BLOCK + 5, "x", "x")
    assert min(r[0] for r in frame.select(warehouse.reserve_ids(1)).limit(1).collect()) > 7 * BLOCK + 5


HEADER = list(CSV_COLUMNS)
VALUE = {"Base station time stamp": "2024-03-10 02:30:00", "Navigational status (text)": "Engine"}


def write(path, columns, *mmsis, spoil=""):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(VALUE.get(c, m if c == "MMSI" else str(n)) for n, c in enumerate(columns)) for m in mmsis]
    path.write_text("\n".join([",".join(f'"{c}"' if "," in c else c for c in columns), *lines, spoil, ""]))


def test_every_file_by_its_own_header(spark, tmp_path):
    shuffled = ["Extra, with comma", *reversed(HEADER), "Extra"]
    write(tmp_path / "in/a.csv", HEADER, "1", "2")
    write(tmp_path / "in/b.csv", shuffled, "3", spoil="too,few")
    write(tmp_path / "in/deep/c.csv", HEADER, "4")
    (tmp_path / "in/empty.csv").write_text("")
    write(tmp_path / "in/header_only.csv", shuffled)
    good, bad = ingest_csv(spark, str(tmp_path / "in"), "lenient", mixed_headers=True)
    got = {r["mmsi"]: r for r in good.collect()}
    assert set(got) == {"1", "2", "3", "4"}
    for ship, columns in (("1", HEADER), ("3", shuffled), ("4", HEADER)):
        for header in ("Latitude", "Longitude", "Heading"):
            assert got[ship][CSV_COLUMNS[header]] == columns.index(header)
        assert got[ship]["nav_status"] == "Engine"
    assert [r["reason"] for r in bad.collect()] == ["ragged line"]
    write(tmp_path / "in/d.csv", HEADER[1:], "5")
    with pytest.raises(ValueError, match="Base station"):
        ingest_csv(spark, str(tmp_path / "in"), mixed_headers=True)


def test_a_stream_of_two_headers(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))

    def run():
        assert stream_csv(warehouse, str(tmp_path / "in"), str(tmp_path / "check")).awaitTermination(120)

    write(tmp_path / "in/a.csv", HEADER, "1", "2")
    write(tmp_path / "in/b.csv", ["More", *reversed(HEADER)], "3")
    run()
    write(tmp_path / "in/c.csv", [*HEADER[3:], "Other", *HEADER[:3]], "4", spoil="x,y")
    run()
    run()
    staged = {r["mmsi"]: r for r in warehouse.staging().collect()}
    assert set(staged) == {"1", "2", "3", "4"} and len(warehouse.loads()) == 2
    assert staged["3"]["latitude"] == 1 + list(reversed(HEADER)).index("Latitude")
    assert len({r["position_id"] for r in staged.values()}) == 4 and warehouse.read("rejects").count() == 1


def test_a_load_parses_its_lines_once(spark, tmp_path, monkeypatch):
    write(tmp_path / "in/a.csv", HEADER, "1", "2", spoil="x,y")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    plans = []
    written = Warehouse.write_lines
    monkeypatch.setattr(
        Warehouse,
        "write_lines",
        lambda self, attempt, frame: plans.append(frame._jdf.queryExecution().executedPlan().toString()) or written(self, attempt, frame),
    )
    monkeypatch.setattr("fairlead.plans.warehouse.Warehouse.replace_load", None)
    assert load_csv(warehouse, str(tmp_path / "in"), "lenient", load_id="x") == 2
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1
    assert warehouse.load("x")["max_id"] == 2 and warehouse.read("rejects").count() == 1
    with pytest.raises(Exception, match="ragged line"):
        load_csv(warehouse, str(tmp_path / "in"), load_id="y")
    assert warehouse.load("y") is None


def test_found_and_exported_in_one_shuffle(spark, sf_dir):
    tables = Tables(spark, sf_dir)
    _, lines = export.find_and_export(tables.positions, tables.statuses, tables.ships, fullest=1)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(ship_id" in line]
    assert len(shuffles) == 1 and "longitude" in plan


@pytest.mark.parametrize("gap", [900, 10**6])
def test_one_shuffle_gives_the_same_lines(spark, sf_dir, gap):
    """Also with a third of the reports of one ship, many of them at one instant."""
    tables = Tables(spark, sf_dir)
    for positions in (tables.positions, crowd(tables)):
        limits, lines = export.find_and_export(positions, tables.statuses, tables.ships, max_points=5, fullest=1, gap_seconds=gap)
        apart = export.export_trajectories(limits, positions, tables.ships, max_points=5, slicing=Slicing(10**9))
        assert lines.columns == apart.columns
        assert sorted(map(repr, lines.collect())) == sorted(map(repr, apart.collect()))
