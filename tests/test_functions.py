import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import values
from wayflux import domain
from wayflux.functions import (
    band, clip, first_match, flag, half_even, lenient_int, lenient_timestamp, lookup,
    surrogate_key, whole_number)


def apply(spark, column, inputs, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i INT, v {kind}")
    return [r.out for r in df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("text, number", [
    ("85", 85), ("85.5", 85), (" 85 ", 85), ("-40", -40), ("+7", 7), ("85.", 85), (".5", 0),
    ("-3.9", -3), ("1e2", None), ("FAST", None), ("", None), ("  ", None), ("-", None),
    ("+", None), ("8 5", None), ("99999999999", None), ("2147483647", 2147483647),
    ("2147483648", None), ("0085", 85), ("\t85\n", 85), ("8.5.1", None), (None, None)])
def test_lenient_int(spark, text, number):
    assert apply(spark, lenient_int, [text], "STRING") == [number]


def test_lenient_timestamp(spark):
    got = apply(spark, lambda c: lenient_timestamp(c).cast("string"), [
        "2024-01-01T10:00:00.123456+00:00", "2024-01-01 10:00:00", "2024-01-01T12:00:00+02:00",
        "2024-13-01", "soon", None], "STRING")
    assert got == ["2024-01-01 10:00:00.123456", "2024-01-01 10:00:00", "2024-01-01 10:00:00",
                   None, None, None]


def test_speed_and_peak_flags(spark):
    low, high = domain.SPEED_RANGE
    speeds = [-1, 0, 160, 161, None]
    assert apply(spark, lambda c: flag(c.between(low, high)), speeds, "INT") == [0, 1, 1, 0, 0]
    hours = [16, 17, 20, 21, None]
    peak = lambda c: flag(c.between(*domain.PEAK_HOURS))
    assert apply(spark, peak, hours, "INT") == [0, 1, 1, 0, 0]


def test_band(spark):
    got = apply(spark, lambda c: band(c, domain.SPEED_BANDS, domain.TOP_SPEED_BAND),
                [0, 29, 30, 69, 70, 160], "INT")
    assert got == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_lookup_known_and_other_members(spark):
    zones = ["CBD", "TECHPARK", "AIRPORT", "TRAINSTATION", "SUBURB", "HARBOUR"]
    types = apply(spark, lambda c: lookup(c, domain.ZONE_TYPES, domain.OTHER_ZONE_TYPE), zones,
                  "STRING")
    assert types == ["Commercial", "IT HUB", "TRANSIT HUB", "TRANSIT HUB", "Residential",
                     "Residential"]
    risks = apply(spark, lambda c: lookup(c, domain.ZONE_RISKS, domain.OTHER_ZONE_RISK), zones,
                  "STRING")
    assert risks == ["HIGH", "MEDIUM", "HIGH", "LOW", "LOW", "LOW"]
    limits = apply(spark, lambda c: lookup(c, domain.SPEED_LIMITS, domain.OTHER_SPEED_LIMIT),
                   ["R100", "R200", "R300", "R999"], "STRING")
    assert limits == [100, 100, 60, 60]


def test_first_match_order_and_null(spark):
    rules = lambda c: first_match([("small", c < 10), ("even", c % 2 == 0)], "rest")
    assert apply(spark, rules, [4, 12, 13, None], "INT") == ["small", "even", "rest", "rest"]


def test_half_even_equals_numpy(spark):
    random.seed(7)
    numbers = [2.25, 2.35, 0.25, 0.35, 1.45, 2.675, -2.25, 0.05]
    numbers += [random.randrange(10 ** 6) / 20 for _ in range(500)]
    assert apply(spark, lambda c: half_even(c, 1), numbers, "DOUBLE") == list(np.round(numbers, 1))


def test_clip(spark):
    assert apply(spark, lambda c: clip(c, 50.0, 220.0), [0.0, 60.0, 500.0], "DOUBLE") == [
        50.0, 60.0, 220.0]


def test_surrogate_key(spark):
    df = spark.sql("""SELECT * FROM VALUES ('CBD', 'R100', timestamp_ntz'2024-01-01 08:00:00'),
                      ('CBD', NULL, timestamp_ntz'2024-01-01 08:00:00.120') AS t(z, r, at)""")
    got = values(df.select(surrogate_key(F.col("z"), F.col("r")),
                           surrogate_key(F.col("z"), F.col("at"))))
    digest = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert got == sorted([(digest("CBD|R100"), digest("CBD|2024-01-01 08:00:00")),
                          (None, digest("CBD|2024-01-01 08:00:00.12"))], key=repr)


@pytest.mark.parametrize("kind, inputs, numbers", [
    ("DOUBLE", [12.0, 12.5, -3.0, 1e10, float("nan"), None], [12, None, -3, None, None, None]),
    ("STRING", ["12", "12.0", "12.5", "1e2", "99999999999", "x", "", None],
     [12, 12, None, 100, None, None, None, None])])
def test_whole_number(spark, kind, inputs, numbers):
    assert apply(spark, whole_number, inputs, kind) == numbers
