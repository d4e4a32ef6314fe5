"""Loads lose nothing and alter nothing: names, folders, times and repeats."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fairlead.plans.warehouse import load_csv, store_load, update_warehouse
from fairlead.schemas import CSV_COLUMNS
from fairlead.sources.csv import ingest_csv, read_raw, zoneless
from fairlead.sources.tables import Warehouse
from fairlead.streaming.csv_stream import stream_csv

STAMP = datetime(2024, 3, 1)
HEADER = ",".join(CSV_COLUMNS)


def write(path, *mmsis):
    path.parent.mkdir(parents=True, exist_ok=True)
    value = {"gps_timestamp": "2024-03-10 02:30:00", "nav_status": "Engine"}
    lines = [",".join(value.get(c, m if c == "mmsi" else "1") for c in CSV_COLUMNS.values()) for m in mmsis]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def test_two_files_with_one_stamp(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    load_csv(warehouse, write(tmp_path / "a.csv", "1", "2"), load_date=STAMP)
    update_warehouse(warehouse)
    load_csv(warehouse, write(tmp_path / "b.csv", "3", "4", "5"), load_date=STAMP)
    update_warehouse(warehouse)
    assert warehouse.staging().count() == 5 and warehouse.positions().count() == 5


def test_two_streams_into_one_warehouse(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    for name, ships in (("one", ("1", "2")), ("two", ("3", "4", "5"))):
        write(tmp_path / name / "a.csv", *ships)
        for _ in range(2):
            stream_csv(warehouse, str(tmp_path / name), str(tmp_path / f"{name}-check")).awaitTermination()
    assert warehouse.staging().count() == 5 and len(warehouse.loads()) == 2


def test_a_repeat_replaces_all_of_a_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    good, bad = write(tmp_path / "good.csv", "1"), write(tmp_path / "bad.csv", "1", "")
    load_csv(warehouse, bad, "lenient", STAMP, load_id="x")
    assert warehouse.read("rejects").count() == 1
    load_csv(warehouse, good, "lenient", STAMP, load_id="x")
    assert warehouse.read("rejects").count() == 0 and warehouse.staging().count() == 1
    rows = warehouse.staging().drop("load_id")
    assert store_load(warehouse, "x", STAMP, rows.limit(0), None) == 0
    load_csv(warehouse, good, "lenient", STAMP, load_id="x")
    update_warehouse(warehouse)
    assert [r["mmsi"] for r in warehouse.staging().collect()] == ["1"] and warehouse.positions().count() == 1
    load_csv(warehouse, write(tmp_path / "new.csv", "8", "9"), load_date=STAMP, load_id="x")
    assert warehouse.positions().count() == 0
    update_warehouse(warehouse)
    assert warehouse.positions().count() == 2 and warehouse.read("refused").count() == 0
    with pytest.raises(ValueError):
        load_csv(warehouse, good, load_date=STAMP, load_id="../x")


def test_a_folder_named_csv(spark, tmp_path):
    write(tmp_path / "drop.csv" / "a.csv", "1")
    write(tmp_path / "drop.csv" / "deep" / "b.CSV", "2")
    (tmp_path / "drop.csv" / "notes.txt").write_text("not,a,report\n")
    assert {r["mmsi"] for r in read_raw(spark, str(tmp_path / "drop.csv")).collect()} == {"1", "2"}


def test_times_keep_their_hour_in_any_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        text = spark.createDataFrame([("10/03/2024 02:30:00",), ("03/11/2024 01:30:00",), ("?",)], "t string")
        got = [r[0] for r in text.select(zoneless(F.col("t"), "dd/MM/yyyy HH:mm:ss")).collect()]
        assert got == [datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30), None]
        path = write(tmp_path / "a.csv", "1")
        rows = ingest_csv(spark, path, timestamp_format="yyyy-MM-dd HH:mm:ss")[0]
        assert rows.first()["gps_timestamp"] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
