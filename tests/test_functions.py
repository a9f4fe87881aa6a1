import math
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tarmac.functions.lists import bracketed, gather, piped
from tarmac.functions.numbers import (
    float_or_zero,
    lenient_int,
    percent,
    ratio,
    strict_int,
    two_decimals,
)
from tarmac.functions.times import bucket_start, event_time_ms, stamp, stamp_to_ms
from tarmac.settings import DAY_MS, HOUR_MS


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_two_decimals_matches_printf(spark):
    rng = random.Random(7)
    values = [0.125, 0.375, 2.675, 1.005, -0.001, -2.5, 0.0, 0.005, 1e9 + 0.125, 99.995, 1766.0]
    values += [float("inf"), float("-inf"), float("nan")]
    values += [rng.randint(-5000, 500000) / rng.randint(1, 3000) for _ in range(3000)]
    values += [rng.randint(-10**6, 10**6) / 1000 for _ in range(3000)]
    values += [rng.randint(-(2**20), 2**20) / 1024 for _ in range(3000)]
    got = column(spark, values, "double", lambda _: two_decimals("v"))
    assert got == [f"{v:.2f}" for v in values]


def test_float_text(spark):
    texts = ["", "  ", "1.5", " -3 ", "+2.", ".5", "1e3", "abc", "1.5d", "0x1p3", "1 2", "\t7\r"]
    want = [0.0, 0.0, 1.5, -3.0, 2.0, 0.5, 1000.0, None, None, None, None, 7.0]
    assert column(spark, texts, "string", float_or_zero) == want
    assert math.isnan(column(spark, ["nan"], "string", float_or_zero)[0])


def test_int_text(spark):
    texts = ["11298", " 7 ", "+3", "11298.0", "", "x", "99999999999"]
    assert column(spark, texts, "string", strict_int) == [11298, 7, 3, None, None, None, None]
    texts = ["11298", "11298.0", "-1.9", "", "x"]
    assert column(spark, texts, "string", lenient_int) == [11298, 11298, -1, 0, None]


def test_empty_denominator_is_zero(spark):
    row = spark.range(1).select(
        ratio(F.lit(5.0), F.lit(0)), percent(F.lit(0), F.lit(0)), percent(F.lit(1), F.lit(8))
    ).first()
    assert tuple(row) == (0.0, 0.0, 12.5)


@pytest.mark.parametrize(
    "hhmm, hour, minute",
    [(None, 0, 0), (0, 0, 0), (5, 0, 5), (1230, 12, 30), (2359, 23, 59), (2400, 23, 0),
     (1299, 12, 59)],
)
def test_event_time(spark, hhmm, hour, minute):
    rows = spark.createDataFrame([(2025, 2, 28, hhmm)], "y int, m int, d int, t int")
    got = rows.select(event_time_ms(F.col("y"), F.col("m"), F.col("d"), F.col("t"))).first()[0]
    assert got == datetime(2025, 2, 28, hour, minute, tzinfo=timezone.utc).timestamp() * 1000


def test_impossible_date(spark):
    rows = spark.createDataFrame([(2025, 2, 30, 900)], "y int, m int, d int, t int")
    when = [F.col(c) for c in "ymdt"]
    assert rows.select(event_time_ms(*when, strict=False)).first()[0] is None
    with pytest.raises(Exception):
        rows.select(event_time_ms(*when)).collect()


def test_buckets_are_epoch_aligned(spark):
    at = int(datetime(2025, 1, 1, 7, 59, 59, tzinfo=timezone.utc).timestamp() * 1000)
    row = spark.range(1).select(
        stamp(bucket_start(F.lit(at), 6 * HOUR_MS)),
        stamp(bucket_start(F.lit(at), 120 * DAY_MS)),
        bucket_start(F.lit(-1).cast("bigint"), HOUR_MS),
    ).first()
    assert tuple(row) == ("2025-01-01 06:00:00", "2024-11-13 00:00:00", -HOUR_MS)


def test_stamp_and_back(spark):
    row = spark.range(1).select(stamp_to_ms(stamp(F.lit(1735689600000)))).first()
    assert row[0] == 1735689600000


def test_list_text(spark):
    worst = spark.createDataFrame(
        [(1, 2, "DL", 10397, 90.0), (1, 1, "AA", 13303, 1766.0)],
        "origin int, place int, carrier string, dest int, dep_delay double",
    )
    lists = gather(worst, ["origin"])
    row = lists.select(bracketed(F.col("delayed")), piped(F.col("delayed"))).first()
    assert tuple(row) == ("[(AA,13303,1766.00), (DL,10397,90.00)]", "AA|13303|1766.00;DL|10397|90.00")
    empty = lists.select(F.slice("delayed", 1, 0).alias("d"))
    assert tuple(empty.select(bracketed(F.col("d")), piped(F.col("d"))).first()) == ("[]", "")


def test_lists_keep_flights_with_missing_fields(spark):
    rows = [("a", 1, "AA", 5, 90.0), ("a", 2, None, 6, 60.5), ("a", 3, "DL", None, 45.0), ("a", 4, None, None, 31.0)]
    worst = spark.createDataFrame(rows, "k string, place int, carrier string, dest int, dep_delay double")
    got = gather(worst, ["k"]).select(bracketed(F.col("delayed")), piped(F.col("delayed"))).first()
    assert got[0] == "[(AA,5,90.00), (,6,60.50), (DL,,45.00), (,,31.00)]"
    assert got[1] == "AA|5|90.00;|6|60.50;DL||45.00;||31.00"
