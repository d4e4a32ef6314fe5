"""Ships and navigational statuses: new keys get the next ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.operators.keys import ONE_TASK_KEYS, Sized, number_rows
from fairlead.session import stored


def add_new_keys(
    rows: DataFrame,
    known: DataFrame | None,
    key: str,
    one_task: int = ONE_TASK_KEYS,
    weight: str | None = None,
) -> Sized:
    """Keys of the rows that the known table lacks, numbered on from its largest id.

    `weight` names a column that tells how many rows each one stands for.
    """
    rows = rows.filter(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    start = 0
    if known is not None:
        counts = counts.join(known, key, "left_anti")
        start = known.agg(F.max("id")).first()[0] or 0
    keys, fullest = counts.agg(F.count(F.lit(1)), F.max("n")).first()
    numbered = number_rows(counts.select(key), [key], start, keys, one_task)
    # Rows of keys known before are not counted, so then the fullest key is unknown.
    return Sized(numbered.select("id", key), keys, fullest if known is None else None)


def update_dimensions(
    new_rows: DataFrame, ships: DataFrame | None = None, statuses: DataFrame | None = None
) -> tuple[Sized, Sized]:
    """Ships and statuses to append for the new staging rows, which are read once, for both."""
    pairs = new_rows.groupBy("mmsi", "nav_status").agg(F.count(F.lit(1)).alias("n"))
    pairs = stored(pairs, "dimension-keys")
    return add_new_keys(pairs, ships, "mmsi", weight="n"), add_new_keys(pairs, statuses, "nav_status", weight="n")
