"""What an increment reads of each ship, and what the next increment needs to know.

A run folds what it learns of a ship into one row of state: its last report (time, id and
status), the report that started its open voyage, its last closed stop, and `bounded`, whether
it had a boundary before that voyage. (A ship's first boundary does not count where it stops,
and a first start that is the last report may yet turn out to stop before a gap.) The next run looks at ships with new reports only. Where all of a ship's new
reports are later than its last one, they are all that is read: the last report stands before
them as their predecessor and the open voyage's start among the boundaries, however long ago
both were. No stored report or voyage of such a ship is looked at.

Where reports came late, the ship is read again: with "carry" from its last closed stop, so
that what came before it is left out for good; with "full" from before the earliest change.
There the voyages from that point on are taken back and found anew.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.operators.detect import last_stops
from fairlead.operators.keys import Sized, lookup
from fairlead.session import stored

LAST = ["last_time", "last_position_id", "last_status_id"]
OPEN = ["open_start", "open_position_id"]
STATE = ["ship_id", *LAST, *OPEN, "last_stop", "bounded"]
SLIM = ["ship_id", "gps_timestamp", "position_id", "nav_status_id", "settled_until", "fresh", "opens"]
# Up to so many ships are named in the filter that Parquet's Bloom filters answer.
NAMED_SHIPS = 1000


def _last_report(prefix: str = "") -> Column:
    return F.max(F.struct("gps_timestamp", "position_id", "nav_status_id")).alias(f"{prefix}last")


def plan_reading(
    news: DataFrame,
    closed: DataFrame | None,
    states: DataFrame | None = None,
    full: bool = False,
    withdrawn: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """One row per ship with new reports, and with "full" per ship that lost reports.

    resumed: the new reports are all there is to read. Else read_from is the time to read from
    (NULL: everything), which is a closed stop; settled_until and fresh are what detection
    takes; closed is None where no voyage was ever stored. n_new is the number of its new reports. The state's columns follow, all NULL for a
    ship that has none.

    With "full" the closed voyages (id, ship_id, datetime_stop) of the ships that are read again
    come second, stored; None if there are no such ships.
    """
    ships = news.filter(F.col("ship_id").isNotNull()).groupBy("ship_id").agg(
        F.min("gps_timestamp").alias("first_new"), _last_report("new_"), F.count(F.lit(1)).alias("n_new")
    )
    if full and withdrawn is not None:
        lost = withdrawn.filter(F.col("ship_id").isNotNull()).groupBy("ship_id").agg(F.min("gps_timestamp").alias("first_lost"))
        ships = ships.join(lost, "ship_id", "full")
    else:
        ships = ships.withColumn("first_lost", F.lit(None).cast("timestamp_ntz"))
    changed = F.least("first_new", "first_lost")
    if states is None:
        kinds = {"last_time": "timestamp_ntz", "open_start": "timestamp_ntz", "bounded": "boolean"}
        ships = ships.withColumns({c: F.lit(None).cast(kinds.get(c, "bigint")) for c in [*LAST, *OPEN, "bounded"]})
        if closed is None:
            ships = ships.withColumn("last_stop", F.lit(None).cast("timestamp_ntz"))
        else:
            stops = last_stops(closed).withColumnRenamed("settled_until", "last_stop")
            ships = ships.join(stops, "ship_id", "left")
        resumed = F.lit(False)
    else:
        # A ship without a state has no reports but the new ones.
        ships = ships.join(states.select(*STATE), "ship_id", "left")
        in_order = F.col("last_time").isNull() | (F.col("first_new") > F.col("last_time"))
        resumed = F.coalesce(F.col("first_lost").isNull() & in_order, F.lit(False))
    ships = ships.withColumns({"changed": changed, "resumed": resumed})
    late, doubtful = ~F.col("resumed"), None
    read_from = F.lit(None).cast("timestamp_ntz") if full else F.col("last_stop")
    if full:
        ships = stored(ships, "changed-ships")
        again = ships.filter(late).select("ship_id", "changed")
        n_late = again.count()
        if n_late and closed is not None:
            doubtful = lookup(
                closed.select("id", "ship_id", "datetime_stop"), Sized(again.select("ship_id"), n_late),
                "ship_id", "left_semi", "datetime_stop",
            )
            doubtful = stored(doubtful, "doubtful")
            ships = ships.join(_stop_before(Sized(again, n_late), doubtful), "ship_id", "left")
            read_from = F.col("stop_before")
    ships = ships.withColumn("read_from", F.when(late, read_from))
    fresh = F.when(F.col("resumed"), ~F.coalesce("bounded", F.lit(False))).otherwise(F.col("read_from").isNull())
    plan = ships.select(
        *STATE,
        "new_last",
        "first_new",
        F.coalesce("n_new", F.lit(0)).alias("n_new"),
        "resumed",
        "read_from",
        F.col("read_from").alias("settled_until"),
        fresh.alias("fresh"),
    )
    return plan, doubtful


def _stop_before(ships: Sized, closed: DataFrame) -> DataFrame:
    """ship_id and stop_before: the closed stop before the last one ahead of the first change.

    A report that comes or goes alters what the reports beside it start or stop. The one before
    it is no earlier than the last stop ahead of it, so that stop is in doubt, and no earlier one.
    """
    stops = closed.select("ship_id", "datetime_stop")
    ahead = lookup(stops, ships, "ship_id", "inner", "datetime_stop")
    ahead = ahead.filter(F.col("datetime_stop") < F.col("changed"))
    last = ahead.groupBy("ship_id").agg(F.max("datetime_stop").alias("doubtful"))
    last = Sized(last, ships.count)
    earlier = lookup(ahead, last, "ship_id", "inner", "datetime_stop").filter(F.col("datetime_stop") < F.col("doubtful"))
    return earlier.groupBy("ship_id").agg(F.max("datetime_stop").alias("stop_before"))


def taken_back(plan: DataFrame, closed: DataFrame, n_late: int) -> DataFrame:
    """id of the closed voyages that a "full" run finds anew, as so many ships are read again."""
    late = Sized(plan.filter(~F.col("resumed")).select("ship_id", "read_from"), n_late)
    rows = lookup(closed.select("id", "ship_id", "datetime_stop"), late, "ship_id", "inner", "datetime_stop")
    return rows.filter(F.col("read_from").isNull() | (F.col("datetime_stop") > F.col("read_from"))).select("id")


def reports_since(positions: DataFrame, needs: Sized, day: date | None) -> DataFrame:
    """The reports of the ships from the time each needs (need_from, NULL: all).

    Two scans: days from the given one on for all ships, and all earlier days for those ships
    alone that reach back further. Without such ships no earlier day is read, and few of them
    are named to the files' Bloom filters.
    """
    at, since = F.col("gps_timestamp"), F.col("need_from")
    enough = since.isNull() | (at >= since)
    if day is None:
        return lookup(positions, needs, "ship_id", "inner").filter(enough).drop("need_from")
    begin = F.lit(day.isoformat()).cast("date")
    recent = lookup(positions.filter(F.col("gps_date") >= begin), needs, "ship_id", "inner").filter(enough)
    far = needs.rows.filter(since.isNull() | (since < begin.cast("timestamp_ntz")))
    count = far.count()
    if not count:
        return recent.drop("need_from")
    before = positions.filter(F.col("gps_date") < begin)
    if count <= NAMED_SHIPS:
        before = before.filter(F.col("ship_id").isin([row["ship_id"] for row in far.select("ship_id").collect()]))
    before = lookup(before, Sized(far, count), "ship_id", "inner").filter(enough)
    return recent.unionByName(before).drop("need_from")


def last_reports(reread: DataFrame) -> DataFrame:
    """Of the ships that were not resumed, how many reports were read again (n_again) and which is the last."""
    return reread.groupBy("ship_id").agg(_last_report("again_"), F.count(F.lit(1)).alias("n_again"))


def seeds(plan: DataFrame) -> DataFrame:
    """The last reports of resumed ships, as the predecessors of their new ones."""
    known = plan.filter(F.col("resumed") & F.col("last_time").isNotNull())
    return known.select(
        "ship_id",
        F.col("last_time").alias("gps_timestamp"),
        F.col("last_position_id").alias("position_id"),
        F.col("last_status_id").alias("nav_status_id"),
        F.lit(None).cast("timestamp_ntz").alias("settled_until"),
        "fresh",
        _opened_by_last().cast("int").alias("opens"),
    )


def _opened_by_last() -> Column:
    return F.coalesce(F.col("open_position_id") == F.col("last_position_id"), F.lit(False))


def openings(plan: DataFrame) -> DataFrame:
    """The reports that started resumed ships' open voyages, other than their last ones."""
    going = plan.filter(F.col("resumed") & F.col("open_start").isNotNull() & ~_opened_by_last())
    return going.select(
        "ship_id", F.col("open_start").alias("gps_timestamp"), F.col("open_position_id").alias("position_id"), "fresh"
    )


def next_states(
    plan: DataFrame, found: DataFrame, states: DataFrame | None = None, lasts: DataFrame | None = None
) -> DataFrame:
    """The states after a run: of the ships it read, and as they were of the others.

    `lasts` has the last_reports of ships that were not resumed, as the one of the state may be
    gone. A ship without reports has no state.
    """
    is_open, begun = F.col("is_open"), F.col("datetime_start").isNotNull()
    by_ship = found.groupBy(F.col("ship_id").alias("_ship")).agg(
        F.max(F.when(is_open, F.struct("datetime_start", "start_id"))).alias("started"),
        F.max(~is_open).alias("found_any"),
        F.max(F.when(begun & ~is_open, F.col("datetime_stop"))).alias("stopped"),
    )
    read = plan.join(by_ship, F.col("ship_id") == F.col("_ship"), "left").drop("_ship")
    if lasts is not None:
        again = lasts.select(F.col("ship_id").alias("_ship"), "again_last")
        read = read.join(again, F.col("ship_id") == F.col("_ship"), "left").drop("_ship")
    else:
        read = read.withColumn("again_last", F.lit(None).cast(read.schema["new_last"].dataType))
    last = F.when(F.col("resumed"), F.col("new_last")).otherwise(F.col("again_last"))
    known = F.when(F.col("resumed"), F.coalesce("bounded", F.lit(False))).otherwise(F.col("read_from").isNotNull())
    stop = F.when(F.col("resumed"), F.col("last_stop")).otherwise(F.col("read_from"))
    after = read.withColumn("last", last).filter(F.col("last").isNotNull()).select(
        "ship_id",
        F.col("last.gps_timestamp").alias("last_time"),
        F.col("last.position_id").alias("last_position_id"),
        F.col("last.nav_status_id").alias("last_status_id"),
        F.col("started.datetime_start").alias("open_start"),
        F.col("started.start_id").alias("open_position_id"),
        F.greatest(stop, "stopped").alias("last_stop"),
        (known | F.coalesce("found_any", F.lit(False))).alias("bounded"),
    )
    if states is None:
        return after
    others = states.select(*STATE).join(plan.select("ship_id"), "ship_id", "left_anti")
    return after.unionByName(others)
