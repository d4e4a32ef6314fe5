"""The ways taken beyond the size limits give the same results as the short ways."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fairlead.operators import detect, export
from fairlead.operators.dimensions import add_new_keys
from fairlead.operators.keys import MAX_GROUPS, lookup, number_rows, oversized, row_limit
from fairlead.operators.slices import SPANS, WHOLE, Slicing, plan_slices
from fairlead.plans.queries import Tables, query


def rows(frame):
    return sorted(map(repr, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir)


def crowd(tables):
    """The test reports, a third of them moved to one ship, and many of those to one instant."""
    event = F.col("position_id")
    instant = F.lit("2024-01-10 12:34:56.000001").cast("timestamp_ntz")
    return tables.positions.withColumns(
        {
            "ship_id": F.when(event % 3 == 0, F.lit(1)).otherwise(F.col("ship_id")).cast("bigint"),
            "gps_timestamp": F.when(event % 9 == 0, instant).otherwise(F.col("gps_timestamp")),
        }
    )


@pytest.mark.parametrize("crowded, limit", [(False, 40), (True, 30)])
def test_cut_ships_give_the_same_voyages(spark, tables, crowded, limit):
    positions = crowd(tables) if crowded else tables.positions
    cut = plan_slices(positions, limit)
    whole = Slicing(10**9)
    assert cut.cut and cut.slices.agg(F.max("reports")).first()[0] <= limit
    assert ("slice_part" in cut.keys) == crowded
    limits = detect.limits_of(positions, tables.statuses, whole)
    assert rows(limits) == rows(detect.limits_of(positions, tables.statuses, cut))
    points = export.voyage_points(limits, positions, whole)
    assert rows(points) == rows(export.voyage_points(limits, positions, cut))
    wide = detect.limits_of(positions, tables.statuses, whole, gap_seconds=10**6)
    lines = [
        export.export_trajectories(wide, positions, tables.ships, max_points=7, slicing=s)
        for s in (whole, cut)
    ]
    assert rows(lines[0]) == rows(lines[1])
    assert lines[0].agg(F.max("part")).first()[0] > 0


def test_cut_ships_give_the_same_deltas_and_increments(spark, tables):
    reports = detect.with_status(tables.positions, tables.statuses)
    columns = [c for c in detect.deltas(reports, Slicing(10**9)).columns]
    cut = detect.deltas(reports, plan_slices(reports, 20)).select(*columns)
    assert rows(detect.deltas(reports, Slicing(10**9))) == rows(cut)
    for mode in ("carry", "parity"):
        found = [
            detect.find_voyages(
                tables.positions, tables.statuses, tables.earlier_limits, mode=mode, limit=limit
            )
            for limit in (None, 20)
        ]
        assert rows(found[0]) == rows(found[1])


def test_increments_equal_one_run(spark, tables):
    """Carry rules, in five steps of six days each."""
    stored = tables.limits.filter("false")
    for step in range(1, 6):
        until = F.lit(str(datetime(2024, 1, 2) + timedelta(days=6 * step))).cast("timestamp_ntz")
        loaded = tables.positions.filter(F.col("load_date") <= until)
        found = detect.find_voyages(loaded, tables.statuses, stored)
        kept = stored.filter(~F.col("is_open")).unionByName(found).collect()
        stored = spark.createDataFrame(kept, tables.limits.schema)
    assert rows(stored) == rows(tables.limits)


def test_results_do_not_depend_on_partitions_or_input_order(spark, tables):
    want = rows(tables.limits)
    shuffled = tables.positions.orderBy(F.xxhash64("position_id")).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert rows(detect.find_voyages(shuffled, tables.statuses)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_every_start_is_under_way_and_lengths_match(tables):
    points = export.voyage_points(tables.limits, tables.positions, Slicing(10**9))
    starts = points.filter(F.col("seq") == 0).join(
        tables.positions.select("position_id", "nav_status_id"), "position_id"
    )
    engine = tables.statuses.rows.filter(F.col("nav_status") == "Engine").first()["id"]
    assert {r[0] for r in starts.select("nav_status_id").distinct().collect()} == {engine}
    assert points.count() == 810


def test_row_limit_bounds_the_list_of_oversized_groups():
    for total in (0, 10**6, 10**9, 10**12 + 1, 10**15):
        assert total / row_limit(total) <= MAX_GROUPS


def test_oversized_lists_groups_over_the_limit(spark):
    facts = spark.range(100).select((F.col("id") % 7).alias("k"))
    limit, found = oversized(facts, ["k"], 14)
    assert limit == 14 and sorted(r["k"] for r in found) == [0, 1]
    assert oversized(facts, ["k"])[1] == []
    assert oversized(facts.filter("false"), ["k"])[1] == []


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    facts = spark.range(300).select(
        F.col("id").alias("position_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0))
        .when(F.col("id") % 11 != 0, F.col("id") % 50)
        .cast("string")
        .alias("k"),
    )
    table = spark.range(40).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    want = rows(lookup(facts, table, "k", how).select(*lookup(facts, table, "k", how).columns))
    for limit in (1, 20, None):
        salted = lookup(facts, table, "k", how, broadcast_rows=0, limit=limit)
        assert rows(salted) == want


def test_salting_deals_a_hot_key_over_many_groups(spark):
    facts = spark.range(1000).select(F.col("id").alias("position_id"), F.lit(5).alias("k"))
    table = spark.range(10).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    joined = lookup(facts, table, "k", broadcast_rows=0, limit=100)
    assert "salt" in plan(joined) and joined.count() == 1000
    assert joined.filter("v = 5").count() == 1000


def test_numbering_over_all_tasks_equals_one_task(spark):
    keys = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    one = number_rows(keys.repartition(5), ["k"], 10)
    many = number_rows(keys.repartition(7), ["k"], 10, one_task=0)
    assert rows(one) == rows(many)
    assert many.agg(F.min("id"), F.max("id")).first() == (11, 5010)


def test_new_keys_continue_from_the_largest_id(spark):
    known = spark.createDataFrame([(4, "a"), (9, "c")], "id bigint, mmsi string")
    new = spark.createDataFrame([("a",), ("d",), ("b",), ("d",), (None,)], "mmsi string")
    added = add_new_keys(new, known, "mmsi")
    assert rows(added.rows) == rows(
        spark.createDataFrame([(10, "b"), (11, "d")], "id bigint, mmsi string")
    )
    assert added.count == 2


def test_spans_divide_each_other_and_slices_keep_time_order(spark, tables):
    assert all(a % b == 0 for a, b in zip(SPANS, SPANS[1:]))
    cut = plan_slices(crowd(tables), 30)
    assigned = cut.assign(crowd(tables))
    # No slice may begin before the previous one of its ship has ended.
    ends = assigned.filter(F.col("slice_start") != WHOLE).groupBy(*cut.keys).agg(
        F.min(F.struct("gps_timestamp", "position_id")).alias("low"),
        F.max(F.struct("gps_timestamp", "position_id")).alias("high"),
    )
    found = ends.orderBy("ship_id", "slice_start", "slice_part").collect()
    for a, b in zip(found, found[1:]):
        assert a["ship_id"] != b["ship_id"] or tuple(a["high"]) < tuple(b["low"])


# Plans


@pytest.mark.parametrize("name", ["voyage_limits", "deltas", "boundaries"])
def test_detection_shuffles_the_reports_once(spark, sf_dir, name):
    text = plan(query(name)(spark, sf_dir))
    assert text.count("hashpartitioning(ship_id") == 1
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SortMergeJoin"):
        assert operator not in text


def test_detection_reads_no_coordinates_or_measures_beyond_the_point_check(spark, sf_dir):
    assert "value" not in plan(query("voyage_limits")(spark, sf_dir)).split("ReadSchema", 1)[1][:120]


@pytest.mark.parametrize("name", ["voyage_points", "trajectory_vectors", "trajectory_export"])
def test_export_compares_no_reports_with_voyages(spark, sf_dir, name):
    text = plan(query(name)(spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "SortMergeJoin"):
        assert operator not in text
    # Once for detection, once for the reports and limits together.
    assert text.count("hashpartitioning(ship_id") <= 3
