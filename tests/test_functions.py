from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fairlead.functions.columns import OPEN_END, line_wkt, micros, ntz, open_end, span_start

TIMES = [
    datetime(1969, 12, 31, 23, 59, 59, 999999),
    datetime(1970, 1, 1),
    datetime(2024, 3, 31, 2, 30, 0, 1),
    datetime(2024, 10, 27, 2, 59, 59, 999999),
    datetime(9999, 12, 31),
]


def exact(at):
    delta = at - datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


@pytest.mark.parametrize("zone", ["UTC", "Europe/Amsterdam", "America/New_York"])
def test_micros_and_spans_ignore_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        for at in TIMES:
            spans = [86_400_000_000, 10_000_000, 1_000, 1]
            row = spark.range(1).select(
                micros(ntz(at)), *[span_start(ntz(at), span) for span in spans]
            ).first()
            assert row[0] == exact(at)
            assert list(row[1:]) == [exact(at) // span * span for span in spans]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_open_end(spark):
    assert spark.range(1).select(open_end()).first()[0] == OPEN_END


def test_line_text(spark):
    points = F.array(
        *[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in [(1.5, 2.0), (3.0, -4.25)]]
    )
    empty = F.filter(points, lambda p: F.lit(False))
    row = spark.range(1).select(line_wkt(points), line_wkt(empty)).first()
    assert row[0] == "LINESTRING (1.5 2.0, 3.0 -4.25)" and row[1] is None
