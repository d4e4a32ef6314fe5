"""The tables' constraints as queries: what each returns should not be there."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairlead.operators.keys import Sized, lookup
from fairlead.schemas import MMSI_LENGTH


def reject_reason() -> Column:
    """First rule a staging row breaks on its way to a position, or NULL."""
    rules = [
        ("gps_timestamp is missing", F.col("gps_timestamp").isNull()),
        ("nav_status is missing", F.col("nav_status").isNull()),
        ("mmsi is missing", F.col("mmsi").isNull()),
        ("mmsi is too long", F.length("mmsi") > MMSI_LENGTH),
        ("latitude is missing", F.col("latitude").isNull()),
        ("longitude is missing", F.col("longitude").isNull()),
    ]
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in rules])


def reject_rows(staging: DataFrame) -> DataFrame:
    """Staging rows that cannot become positions, with the reason."""
    kept = [c for c in ["position_id", "load_id"] if c in staging.columns]
    return staging.select(*kept, reject_reason().alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(
    rows: DataFrame, parents: DataFrame | Sized, key: str, spread: str = "position_id"
) -> DataFrame:
    """Rows whose key, where they have one, is not among the parents' unique keys."""
    kept = rows.filter(F.col(key).isNotNull())
    return lookup(kept, parents.select(key), key, how="left_anti", spread=spread)


def _broken(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Per rule the number of rows that break it, all counted in one pass over the rows."""
    counts = rows.agg(*[F.count(F.when(broken, 1)).alias(f"r{n}") for n, broken in enumerate(rules.values())])
    pairs = [F.struct(F.lit(rule).alias("rule"), F.col(f"r{n}").alias("broken")) for n, rule in enumerate(rules)]
    return counts.select(F.inline(F.array(*pairs)))


def _marked(rows: DataFrame, parents: DataFrame | Sized, key: str, mark: str, spread: str) -> DataFrame:
    """The rows, with true in `mark` where their key is among the parents' unique keys."""
    return lookup(rows, parents.select(key, F.lit(True).alias(mark)), key, spread=spread)


def _lost(key: str, mark: str) -> Column:
    return F.col(key).isNotNull() & F.col(mark).isNull()


def constraint_report(
    staging: DataFrame,
    ships: DataFrame | Sized,
    statuses: DataFrame | Sized,
    positions: DataFrame,
    limits: DataFrame,
    exports: DataFrame | None = None,
) -> DataFrame:
    """Per rule of the tables, the number of rows (or keys) that break it; each table is read once.

    Rules of staging rows are listed only where rows break them. Exported lines, if given, are
    of a stored voyage by trajectory_id.
    """

    def plain(table: DataFrame | Sized) -> DataFrame:
        return table.rows if isinstance(table, Sized) else table

    ship_ids = ships.select(F.col("id").alias("ship_id"))
    status_ids = statuses.select(F.col("id").alias("nav_status_id"))
    unplaced = F.col("longitude").isNull() | F.col("latitude").isNull()
    no_times = F.col("datetime_start").isNull() | F.col("datetime_stop").isNull()
    reports = positions.select("position_id", "longitude", "latitude", "ship_id", "nav_status_id")
    reports = _marked(reports, ship_ids, "ship_id", "of_ship", "position_id")
    reports = _marked(reports, status_ids, "nav_status_id", "of_status", "position_id")
    voyages = _marked(limits, ship_ids, "ship_id", "of_ship", "datetime_start")
    parts = [
        _broken(duplicate_keys(plain(ships), "mmsi"), {"ship listed twice": F.lit(True)}),
        _broken(duplicate_keys(plain(statuses), "nav_status"), {"status listed twice": F.lit(True)}),
        _broken(
            reports,
            {
                "position without point": unplaced,
                "position of unknown ship": _lost("ship_id", "of_ship"),
                "position of unknown status": _lost("nav_status_id", "of_status"),
            },
        ),
        _broken(voyages, {"voyage without limits": no_times, "voyage of unknown ship": _lost("ship_id", "of_ship")}),
    ]
    if exports is not None:
        lines = exports.select("trajectory_id", "datetime_start")
        ids = limits.select(F.col("id").alias("trajectory_id"))
        lines = _marked(lines, ids, "trajectory_id", "of_voyage", "datetime_start")
        parts.append(_broken(lines, {"line of unknown voyage": _lost("trajectory_id", "of_voyage")}))
    refused = (
        reject_rows(staging)
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("broken"))
        .select(F.concat(F.lit("staging: "), "reason").alias("rule"), "broken")
    )
    return reduce(DataFrame.unionByName, parts, refused)
