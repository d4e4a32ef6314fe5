from datetime import datetime

import pytest

from fairlead.sources.csv import ingest_csv, read_raw

HEADER = [
    "Base station time stamp", "Course over ground", "Heading", "Latitude", "Longitude",
    "MMSI", "Navigational status (text)", "Speed over ground",
]
SHUFFLED = (
    "MMSI,Callsign,Latitude,Base station time stamp,Longitude,Speed over ground,"
    "Navigational status (text),Heading,Course over ground"
)
LOAD = datetime(2024, 1, 2, 3, 4, 5)


def write(folder, name, *lines):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def line(mmsi="219000001", call="OXAB", lat="55.5", ts="2024-01-01 00:05:00", heading="90"):
    return f"{mmsi},{call},{lat},{ts},12.25,7.5,Engine,{heading},91.0"


def rows(frame):
    return sorted((r.asDict() for r in frame.collect()), key=lambda r: r["position_id"])


def test_values_land_by_header_name(spark, tmp_path):
    path = write(tmp_path, "a.csv", SHUFFLED, line())
    staging, _ = ingest_csv(spark, path, load_date=LOAD)
    (row,) = rows(staging)
    assert row == {
        "position_id": 1,
        "gps_timestamp": datetime(2024, 1, 1, 0, 5),
        "mmsi": "219000001",
        "latitude": 55.5,
        "longitude": 12.25,
        "nav_status": "Engine",
        "speed_over_ground": 7.5,
        "heading": 90.0,
        "course_over_ground": 91.0,
        "load_date": LOAD,
    }


BAD_FILE = [
    SHUFFLED,
    line(mmsi="1"),
    line(mmsi="2", call='"OX, AB"'),
    line(mmsi="3", lat="north"),
    line(mmsi="4", call="OX, AB"),
    line(mmsi=""),
    line(mmsi="6", heading=""),
]


def test_lenient_keeps_good_rows_and_sets_bad_ones_aside(spark, tmp_path):
    path = write(tmp_path, "a.csv", *BAD_FILE)
    staging, rejects = ingest_csv(spark, path, mode="lenient")
    assert [(r["mmsi"], r["heading"]) for r in rows(staging)] == [
        ("1", 90.0), ("2", 90.0), ("6", None)
    ]
    assert sorted(r["reason"] for r in rejects.collect()) == [
        "latitude does not convert", "mmsi is missing", "ragged line"
    ]
    assert any("OX, AB" in r["line"] for r in rejects.collect())


def test_lenient_count_alone_also_drops_bad_rows(spark, tmp_path):
    path = write(tmp_path, "a.csv", *BAD_FILE)
    assert ingest_csv(spark, path, mode="lenient")[0].count() == 3


@pytest.mark.parametrize("bad", [3, 4])
def test_strict_fails_on_a_bad_row(spark, tmp_path, bad):
    path = write(tmp_path, "a.csv", SHUFFLED, line(), BAD_FILE[bad])
    with pytest.raises(Exception, match="latitude does not convert|ragged line"):
        ingest_csv(spark, path)[0].collect()


def test_strict_keeps_a_missing_mmsi(spark, tmp_path):
    path = write(tmp_path, "a.csv", SHUFFLED, line(mmsi=""))
    assert [r["mmsi"] for r in rows(ingest_csv(spark, path)[0])] == [None]


@pytest.mark.parametrize(
    "field, fault",
    [
        (dict(ts="2024"), "gps_timestamp does not convert"),
        (dict(ts=""), "gps_timestamp is missing"),
        (dict(lat="12d"), "latitude does not convert"),
        (dict(mmsi="9" * 21), "mmsi is too long"),
    ],
)
def test_reject_reasons(spark, tmp_path, field, fault):
    path = write(tmp_path, "a.csv", SHUFFLED, line(**field))
    staging, rejects = ingest_csv(spark, path, mode="lenient")
    assert staging.count() == 0
    assert [r["reason"] for r in rejects.collect()] == [fault]


def test_accepted_number_forms(spark, tmp_path):
    forms = ["1", "-1.5", ".5", "1e2", " 2 ", "NaN"]
    path = write(tmp_path, "a.csv", SHUFFLED, *[line(heading=f) for f in forms])
    got = [r["heading"] for r in rows(ingest_csv(spark, path)[0])]
    assert got[:5] == [1.0, -1.5, 0.5, 100.0, 2.0] and got[5] != got[5]


def test_folder_is_searched_at_any_depth_in_any_case(spark, tmp_path):
    write(tmp_path, "a.csv", SHUFFLED, line(mmsi="1"))
    write(tmp_path, "deep/er/b.CSV", SHUFFLED, line(mmsi="2"))
    write(tmp_path, "deep/c.txt", SHUFFLED, line(mmsi="3"))
    staging, _ = ingest_csv(spark, str(tmp_path))
    assert sorted(r["mmsi"] for r in rows(staging)) == ["1", "2"]


def test_ids_are_unique_and_start_where_told(spark, tmp_path):
    for part in range(5):
        write(tmp_path, f"{part}.csv", SHUFFLED, *[line()] * 20)
    ids = [r["position_id"] for r in rows(ingest_csv(spark, str(tmp_path), first_id=1000)[0])]
    assert len(set(ids)) == 100 and min(ids) >= 1000


def test_another_header_fails_unless_mixed_headers_is_set(spark, tmp_path):
    write(tmp_path, "a.csv", SHUFFLED, line(mmsi="1"))
    write(tmp_path, "b.csv", ",".join(HEADER), "2024-01-01 00:05:00,91,90,55.5,12.25,2,Engine,7.5")
    write(tmp_path, "sub/c.csv", SHUFFLED, line(mmsi="3"))
    with pytest.raises(Exception, match="(?i)header"):
        ingest_csv(spark, str(tmp_path))[0].collect()
    staging, _ = ingest_csv(spark, str(tmp_path), mixed_headers=True)
    got = {(r["mmsi"], r["latitude"], r["speed_over_ground"]) for r in rows(staging)}
    assert got == {("1", 55.5, 7.5), ("2", 55.5, 7.5), ("3", 55.5, 7.5)}


def test_missing_column_is_named(spark, tmp_path):
    path = write(tmp_path, "a.csv", "MMSI,Latitude", "1,2")
    with pytest.raises(ValueError, match="Longitude"):
        read_raw(spark, path)


def test_timestamp_format(spark, tmp_path):
    path = write(tmp_path, "a.csv", SHUFFLED, line(ts="31/01/2024 10:11:12"))
    staging, _ = ingest_csv(spark, path, timestamp_format="dd/MM/yyyy HH:mm:ss")
    assert rows(staging)[0]["gps_timestamp"] == datetime(2024, 1, 31, 10, 11, 12)
