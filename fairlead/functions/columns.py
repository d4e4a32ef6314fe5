"""Small column expressions shared by the operators."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OPEN_END = datetime(9999, 12, 31)
ACTIVE_STATUS = "Engine"
GAP_SECONDS = 15 * 60


def open_end() -> Column:
    """Stop time of a voyage that has not ended yet."""
    return ntz(OPEN_END)


def ntz(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> datetime:
    """The time of a load, without a zone like all times here."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _day_and_seconds(ts: Column) -> tuple[Column, Column]:
    day = F.datediff(ts, F.lit("1970-01-01").cast("date")).cast("bigint")
    return day, (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zoneless timestamp, whatever the session time zone."""
    day, second = _day_and_seconds(ts)
    fraction = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint") % 1_000_000
    return day * 86_400_000_000 + second * 1_000_000 + fraction


def span_start(ts: Column, span: int) -> Column:
    """Start of the span of so many microseconds that the time is in, as micros."""
    day, second = _day_and_seconds(ts)
    if span == 86_400_000_000:
        at = day * 86_400_000_000
    elif span % 1_000_000 == 0:
        at = day * 86_400_000_000 + second * 1_000_000
    else:
        at = micros(ts)
    return at - F.pmod(at, F.lit(span))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def line_wkt(coordinates: Column) -> Column:
    """Well-known text of an ordered array of (lon, lat); NULL for an empty one."""
    pairs = F.transform(coordinates, lambda p: F.concat_ws(" ", p["lon"], p["lat"]))
    return F.when(
        F.size(coordinates) > 0,
        F.concat(F.lit("LINESTRING ("), F.array_join(pairs, ", "), F.lit(")")),
    )
