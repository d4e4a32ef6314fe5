"""Cutting crowded ships into time slices.

Voyage detection and export look at each ship's reports in time order. A window per ship
would put all reports of a ship into one task, however many there are. So ships with more
reports than a limit are cut into slices that follow each other in time: days first, and
within a day that is still over the limit ever shorter spans, down to reports of one
instant, which are cut by position id. Every operator then works per slice and brings in
what it needs from the neighbouring slices through one summary row per slice.

When no ship is over the limit nothing is cut and the plans are plain windows per ship.
When ships are cut, the extra passes read the cut ships alone, and the small tables a later
step needs (slices, their ends, boundaries, voyage starts) are written to the shared folder,
so that no plan computes them twice.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairlead.functions.columns import span_start
from fairlead.operators.keys import MIN_GROUP_ROWS, oversized
from fairlead.session import stored

# Slice lengths in microseconds, each dividing the one before: a day, ten seconds, a
# millisecond, one instant.
SPANS = [86_400_000_000, 10_000_000, 1_000, 1]
# Slice start of a ship that is not cut: before any timestamp.
WHOLE = -(2**62)


@dataclass(frozen=True)
class Slicing:
    """The crowded slices found at each level; none means that ships are left whole.

    `slices` holds one row per slice of the cut ships: its keys and number of reports.
    """

    limit: int
    crowded: list[DataFrame] = field(default_factory=list)
    slices: DataFrame | None = None

    @property
    def cut(self) -> bool:
        return bool(self.crowded)

    @property
    def time_keys(self) -> list[str]:
        return ["ship_id", "slice_start"] if self.cut else ["ship_id"]

    @property
    def keys(self) -> list[str]:
        """Columns that name a slice, in slice order within a ship."""
        by_id = ["slice_part"] if len(self.crowded) > len(SPANS) else []
        return self.time_keys + by_id

    def assign(self, rows: DataFrame, part: Column | None = None) -> DataFrame:
        """Add the slice columns to rows with ship_id and gps_timestamp.

        `part` replaces the position-id part for rows that are no reports.
        """
        if not self.cut:
            return rows
        rows = rows.withColumn("slice_start", F.lit(WHOLE).cast("bigint"))
        at = F.col("gps_timestamp")
        for level, crowded in enumerate(self.crowded):
            rows = rows.join(
                F.broadcast(crowded.withColumn("crowded", F.lit(True))),
                ["ship_id", "slice_start"],
                "left",
            )
            if level < len(SPANS):
                start = F.when(F.col("crowded"), span_start(at, SPANS[level]))
                rows = rows.withColumn("slice_start", F.coalesce(start, "slice_start"))
            else:
                by_id = F.floor(F.col("position_id") / self.limit) if part is None else part
                rows = rows.withColumn(
                    "slice_part", F.when(F.col("crowded"), by_id).otherwise(F.lit(0)).cast("bigint")
                )
            rows = rows.drop("crowded")
        return rows

    def of_cut_ships(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.crowded[0].select("ship_id")), "ship_id", "left_semi")

    def of_whole_ships(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.crowded[0].select("ship_id")), "ship_id", "left_anti")

    def running_before(self, totals: DataFrame, columns: list[str]) -> DataFrame:
        """Per slice, the sums of the columns over the ship's earlier slices."""
        earlier = (
            Window.partitionBy("ship_id")
            .orderBy(*self.keys[1:])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return totals.select(
            *self.keys,
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in columns],
        )


def plan_slices(
    reports: DataFrame, limit: int | None = None, fullest: int | None = None
) -> Slicing:
    """Count the reports per ship and cut the crowded ships.

    Nothing is counted when no ship is known to have more reports than `fullest`, and that
    is below any limit. Otherwise one pre-aggregated count when no ship is crowded, one more per level otherwise. Each
    list of crowded slices has at most total / limit rows, which keys.row_limit bounds.
    """
    if limit is None and fullest is not None and fullest <= MIN_GROUP_ROWS:
        return Slicing(MIN_GROUP_ROWS)
    reports = reports.filter(F.col("ship_id").isNotNull()).select(
        "ship_id", "gps_timestamp", "position_id"
    )
    limit, rows = oversized(reports, ["ship_id"], limit)
    slicing = Slicing(limit)
    spark = reports.sparkSession
    while rows and len(slicing.crowded) <= len(SPANS):
        found = spark.createDataFrame(
            [(r["ship_id"], r["slice_start"] if slicing.cut else WHOLE) for r in rows],
            "ship_id bigint, slice_start bigint",
        )
        slicing = Slicing(limit, slicing.crowded + [found])
        reports = slicing.of_cut_ships(reports) if len(slicing.crowded) == 1 else reports
        _, rows = oversized(slicing.assign(reports), slicing.time_keys, limit)
    if not slicing.cut:
        return slicing
    slices = slicing.assign(reports).groupBy(*slicing.keys).agg(F.count(F.lit(1)).alias("reports"))
    return replace(slicing, slices=stored(slices, "slices"))
