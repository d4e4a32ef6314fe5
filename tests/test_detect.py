"""Hand fixtures (FIXTURES.md, section 3), each with ships whole and cut into slices."""

from datetime import datetime, timedelta

import pytest

from fairlead.operators.detect import find_voyages
from fairlead.operators.export import export_trajectories, find_and_export, voyage_points
from fairlead.schemas import LIMITS, NAV_STATUSES, POSITIONS, SHIPS

DAY = datetime(2024, 1, 1)
OPEN = datetime(9999, 12, 31)
STATUSES = ["Engine", "Moored", "At anchor"]
# Row limits: none cut, all ships cut, down to single instants and parts of an instant.
LIMITS_TO_TRY = [None, 3, 1]


def at(text):
    parts = [int(p) for p in text.split(":")] + [0]
    return DAY + timedelta(hours=parts[0], minutes=parts[1], seconds=parts[2])


def reports(text, first_id=1, ship=1):
    """'0:05 Engine, 0:10 Moored' as position rows."""
    out = []
    for n, item in enumerate(text.split(",")):
        time, status = item.strip().split(" ", 1)
        status_id = STATUSES.index(status) + 1 if status != "None" else None
        out.append(
            (first_id + n, 10.0 + n, 50.0 + n, ship, at(time), status_id, float(n),
             None if n % 2 else float(n), float(n), DAY)
        )
    return out


def frames(spark, rows):
    positions = spark.createDataFrame(rows, POSITIONS)
    statuses = spark.createDataFrame([(i + 1, s) for i, s in enumerate(STATUSES)], NAV_STATUSES)
    return positions, statuses


def pairs(frame):
    found = sorted((r["datetime_start"], r["datetime_stop"], r["is_open"]) for r in frame.collect())
    assert all(is_open == (stop == OPEN) for _, stop, is_open in found)
    return [(start, stop) for start, stop, _ in found]


def expected(text):
    out = []
    for voyage in filter(None, text.split(";")):
        start, stop = voyage.split()
        out.append((at(start), OPEN if stop == "open" else at(stop)))
    return out


CASES = {
    "status and gap": (
        "0:00 Moored, 0:05 Engine, 0:10 Engine, 0:20 Moored, 0:30 Engine, 0:40 Engine,"
        "0:55 Engine, 1:10:01 Engine, 1:15 Engine",
        "0:05 0:20;0:30 0:55;1:10:01 open",
    ),
    "begins under way": (
        "0:00 Engine, 0:05 Engine, 0:10 Moored, 0:12 Engine, 0:14 Moored",
        "0:12 0:14",
    ),
    "start and stop in one": (
        "0:00 Moored, 0:05 Engine, 0:30 Engine, 0:50 Engine, 1:00 Moored, 1:05 Engine,"
        "1:30 Engine, 1:40 Moored",
        "0:30 0:30;0:50 1:00;1:05 1:05;1:30 1:40",
    ),
    "no transition": ("0:00 Engine, 0:05 Engine", ""),
    "equal times": (
        "0:00 Moored, 0:05 Engine, 0:10 Moored, 0:10 Engine, 0:20 Moored",
        "0:05 0:10;0:10 0:10",
    ),
    "unknown status": (
        "0:00 Moored, 0:05 Engine, 0:06 None, 0:07 Moored, 0:08 Engine, 0:09 Moored",
        "0:05 0:09;0:08 0:09",
    ),
}


def all_cases():
    """Every case as a ship of its own."""
    return {
        ship: (reports(text, first_id=100 * ship, ship=ship), expected(want))
        for ship, (text, want) in enumerate(CASES.values(), 1)
    }


@pytest.mark.parametrize("limit", LIMITS_TO_TRY)
def test_limits_and_their_points(spark, limit):
    cases = all_cases()
    positions, statuses = frames(spark, [r for rows, _ in cases.values() for r in rows])
    limits = spark.createDataFrame(
        find_voyages(positions, statuses, limit=limit).collect(), LIMITS
    )
    points = voyage_points(limits, positions, limit=limit).collect()
    for ship, (rows, want) in cases.items():
        assert pairs(limits.filter(limits.ship_id == ship)) == want
        inside = []
        for start, stop in want:
            ids = sorted((r[4], r[0]) for r in rows if start <= r[4] <= stop)
            inside += [(start, n, position) for n, (_, position) in enumerate(ids)]
        got = [(r["datetime_start"], r["seq"], r["position_id"]) for r in points if r["ship_id"] == ship]
        assert sorted(got) == sorted(inside)


@pytest.mark.parametrize("limit", [None, 2])
def test_increments(spark, limit):
    first = reports("0:00 Moored, 0:10 Engine, 0:15 Engine, 0:40 Engine")
    positions, statuses = frames(spark, first)
    found = find_voyages(positions, statuses, limit=limit)
    assert pairs(found) == expected("0:10 0:15;0:40 open")
    prior = spark.createDataFrame(found.collect(), LIMITS)
    positions, _ = frames(spark, first + reports("0:45 Engine", first_id=5))
    carry = find_voyages(positions, statuses, prior, mode="carry", limit=limit)
    parity = find_voyages(positions, statuses, prior, mode="parity", limit=limit)
    assert pairs(carry) == expected("0:40 open")
    assert pairs(parity) == []


@pytest.mark.parametrize("limit, max_points", [(None, 100), (None, 1), (3, 2), (1, 2)])
def test_vectors_stay_aligned_and_parts_follow_each_other(spark, limit, max_points):
    text, want = CASES["status and gap"]
    rows = reports(text)
    positions, statuses = frames(spark, rows)
    ships = spark.createDataFrame([(1, "219")], SHIPS)
    limits = find_voyages(positions, statuses, limit=limit)
    lines = export_trajectories(limits, positions, ships, max_points=max_points, limit=limit)
    voyages = {}
    for r in sorted(lines.collect(), key=lambda r: (r["datetime_start"], r["part"])):
        vectors = ["coordinates", "timestamps", "speed_over_ground", "course_over_ground", "heading"]
        assert len({len(r[v]) for v in vectors}) == 1
        assert len(r["timestamps"]) <= max_points
        assert r["mmsi"] == "219"
        voyage = voyages.setdefault((r["datetime_start"], r["datetime_stop"]), [[], r["part"]])
        assert r["part"] == voyage[1]
        voyage[1] += 1
        for n, time in enumerate(r["timestamps"]):
            point = r["coordinates"][n]
            voyage[0].append(
                (point["lon"], point["lat"], time, r["speed_over_ground"][n], r["heading"][n],
                 r["course_over_ground"][n])
            )
    assert sorted(voyages) == expected(want)
    for (start, stop), (points, _) in voyages.items():
        inside = [(r[1], r[2], r[4], r[6], r[7], r[8]) for r in rows if start <= r[4] <= stop]
        assert points == inside


@pytest.mark.parametrize("limit", [None, 1])
def test_a_voyage_without_reports_is_exported_empty(spark, limit):
    positions, _ = frames(spark, reports("0:00 Engine, 0:05 Engine, 0:40 Engine"))
    ships = spark.createDataFrame([(1, "219")], SHIPS)
    limits = spark.createDataFrame([(1, at("0:10"), at("0:20"), False)], LIMITS)
    (row,) = export_trajectories(limits, positions, ships, limit=limit).collect()
    assert (row["datetime_start"], row["datetime_stop"]) == (at("0:10"), at("0:20"))
    assert row["coordinates"] == [] and row["heading"] == [] and row["part"] == 0


def test_find_and_export_returns_the_new_voyages_only(spark):
    first = reports("0:00 Moored, 0:05 Engine, 0:10 Moored")
    positions, statuses = frames(spark, first)
    prior = spark.createDataFrame(find_voyages(positions, statuses).collect(), LIMITS)
    positions, _ = frames(spark, first + reports("0:15 Engine, 0:20 Engine", first_id=9))
    ships = spark.createDataFrame([(1, "219")], SHIPS)
    limits, lines = find_and_export(positions, statuses, ships, prior)
    assert pairs(limits) == expected("0:15 open")
    (row,) = lines.collect()
    assert row["timestamps"] == [at("0:15"), at("0:20")]


def test_other_parameters(spark):
    positions, statuses = frames(spark, reports("0:00 Engine, 0:05 Moored, 0:30 Moored, 0:31 Engine"))
    found = find_voyages(positions, statuses, gap_seconds=3600, active="Moored")
    assert pairs(found) == expected("0:05 0:31")
    with pytest.raises(ValueError):
        find_voyages(positions, statuses, mode="both")


def test_ship_range(spark):
    text = "0:00 Moored, 0:05 Engine, 0:10 Moored"
    rows = [r for ship in (1, 2, 3) for r in reports(text, first_id=10 * ship, ship=ship)]
    positions, statuses = frames(spark, rows)
    found = find_voyages(positions, statuses, ship_range=(2, 3))
    assert sorted(r["ship_id"] for r in found.collect()) == [2, 3]
