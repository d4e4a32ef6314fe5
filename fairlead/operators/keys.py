"""Lookups against one-row-per-key tables and surrogate keys, at any size and skew."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.session import stored

# A group of rows larger than this is split; see row_limit.
MIN_GROUP_ROWS = 1_000_000
# No list of oversized groups is longer than this, so it may be collected and broadcast.
MAX_GROUPS = 10_000
# Lookup tables up to this many rows are broadcast (20-character key and a long each).
BROADCAST_ROWS = 1_000_000
# Facts without a key are dealt over this many salts when they are joined by a shuffle.
NULL_SALTS = 4096
# Up to this many keys are numbered by one sort in one task.
ONE_TASK_KEYS = 100_000


@dataclass(frozen=True)
class Sized:
    """A table of one row per key with its counted rows.

    `fullest` is the number of rows of the most frequent key in the data it was made
    from, where that is known.
    """

    rows: DataFrame
    count: int
    fullest: int | None = None

    def select(self, *columns) -> Sized:
        return Sized(self.rows.select(*columns), self.count, self.fullest)


def row_limit(total: int) -> int:
    """Largest group left whole: at most MAX_GROUPS groups of a table can exceed it."""
    return max(MIN_GROUP_ROWS, -(-total // MAX_GROUPS))


def oversized(facts: DataFrame, keys: list[str], limit: int | None = None) -> tuple[int, list]:
    """Row limit and the groups above it, as (keys..., n) rows.

    The counts are pre-aggregated before their shuffle. Without a given limit the table's
    size sets it, and the groups are only listed when the largest one is above it.
    """
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if limit is None:
        total, largest = counts.agg(F.sum("n"), F.max("n")).first()
        limit = row_limit(total or 0)
        if not total or largest <= limit:
            return limit, []
    return limit, counts.filter(F.col("n") > limit).collect()


def lookup(
    facts: DataFrame,
    table: DataFrame | Sized,
    on: str,
    how: str = "left",
    spread: str = "position_id",
    broadcast_rows: int = BROADCAST_ROWS,
    limit: int | None = None,
) -> DataFrame:
    """Join facts to a table that holds each key once.

    A table of a checked size is broadcast. A larger one is joined by a shuffle in which
    every oversized key of the facts is dealt over several salts by the hash of the
    `spread` column, the key's one table row being repeated once per salt. Facts without a
    key match nothing and are dealt likewise.
    """
    count = table.count if isinstance(table, Sized) else table.count()
    table = table.rows if isinstance(table, Sized) else table
    if count <= broadcast_rows:
        return facts.join(F.broadcast(table), on, how)
    limit, hot = oversized(facts.filter(F.col(on).isNotNull()), [on], limit)
    salts = facts.sparkSession.createDataFrame(
        [(row[on], -(-row["n"] // limit)) for row in hot],
        f"{on} {facts.schema[on].dataType.simpleString()}, salts bigint",
    )
    dealt = facts.join(F.broadcast(salts), on, "left").withColumn(
        "salt",
        F.when(F.col(on).isNull(), F.pmod(F.xxhash64(spread), F.lit(NULL_SALTS)))
        .otherwise(F.coalesce(F.pmod(F.xxhash64(spread), F.col("salts")), F.lit(0))),
    )
    repeated = (
        table.join(F.broadcast(salts), on, "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .withColumn("salt", F.col("salt").cast("bigint"))
        .drop("salts")
    )
    return dealt.drop("salts").join(repeated, [on, "salt"], how).drop("salt")


def number_rows(
    rows: DataFrame,
    order: list[str],
    start: int = 0,
    count: int | None = None,
    one_task: int = ONE_TASK_KEYS,
) -> DataFrame:
    """Add `id`: start + 1, start + 2, ... in the given unique order.

    A checked small number of rows is numbered in one task. More are sorted over all
    tasks; the sorted rows are stored so that the places within the partitions and the
    partition sizes come from one and the same sort.
    """
    if count is None:
        count = rows.count()
    if count <= one_task:
        return rows.withColumn(
            "id", F.row_number().over(Window.orderBy(*order)).cast("bigint") + start
        )
    placed = rows.orderBy(*order).withColumn("place", F.monotonically_increasing_id())
    placed = placed.select(
        *rows.columns,
        F.shiftright("place", 33).alias("part"),
        F.col("place").bitwiseAND(F.lit(2**33 - 1)).alias("nth"),
    )
    placed = stored(placed, "numbered")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("skipped"))
    )
    return (
        placed.join(F.broadcast(offsets), "part")
        .withColumn("id", F.col("skipped") + F.col("nth") + 1 + start)
        .drop("part", "nth", "skipped")
    )
