"""Local clock columns at day edges and Java-style rounding of arrival times."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stopwise.functions.timecols import local_time_columns
from stopwise.operators.arrivals import arrival_time

ZONE = timezone(timedelta(hours=1))


def _expect(ms):
    z = datetime.fromtimestamp(ms / 1000, tz=ZONE)
    sod = z.hour * 3600 + z.minute * 60 + z.second
    return (f"{z.hour:02d}:{z.minute:02d}:{z.second:02d}", f"{z.hour + 24:02d}:{z.minute:02d}:{z.second:02d}", sod,
            sod + 86400, z.date().isoformat(), (z.date() - timedelta(days=1)).isoformat())


CASES = [
    datetime(2024, 1, 1, 22, 59, 59, tzinfo=timezone.utc),   # 23:59:59 local
    datetime(2024, 1, 1, 23, 0, 0, tzinfo=timezone.utc),     # local midnight
    datetime(2023, 12, 31, 23, 30, 0, tzinfo=timezone.utc),  # new year locally
    datetime(2024, 2, 28, 23, 15, 0, tzinfo=timezone.utc),   # 29 February locally
    datetime(2024, 3, 1, 0, 0, 1, 999000, tzinfo=timezone.utc),
    datetime(1970, 1, 1, 0, 0, 0, tzinfo=timezone.utc),
]


@pytest.mark.parametrize("when", CASES)
def test_local_time_columns(spark, when):
    ms = int(when.timestamp() * 1000)
    row = spark.range(1).select(*local_time_columns(F.lit(ms))).first()
    assert tuple(row) == _expect(ms)


@pytest.mark.parametrize("t1,t2,s_prev,s_now,stop,expect", [
    (1000, 995, 0.0, 10.0, 5.0, 998),     # out-of-order samples: -2.5 rounds half up to -2
    (1000, 997, 0.0, 10.0, 5.0, 999),     # -1.5 -> -1
    (1000, 2000, 0.0, 10.0, 2.5, 1250),
    (1000, 2000, 5.0, 5.0000001, 5.0, 2000),  # no movement: the sample's own time
    (1000, 2000, 0.0, 10.0, -3.0, 1000),  # clamped to [0, 1]
])
def test_arrival_rounding(spark, t1, t2, s_prev, s_now, stop, expect):
    c = arrival_time(F.lit(stop), F.lit(s_now), F.lit(s_prev), F.lit(t1).cast("long"), F.lit(t2).cast("long"))
    assert spark.range(1).select(c.alias("a")).first().a == expect
