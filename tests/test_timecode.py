import pytest
from pyspark.sql import functions as F

from storyflow.functions import timecode as T


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_readable_times(spark):
    cases = {
        "[00:00:59]": 59_000, " 00:01:02.250 ": 62_250, "[00:00:10.5]": 10_500, "[100:00:00]": 360_000_000, " [00:00:07] ": 7_000, "(01:02:03.04)": 3_723_040,
        "[00:61:00]": None, "00:01": None, "aa:00:01": None, "": None, "  ": None, None: None, "0:00:01": None, "00:00:60": None, "00:00:01.1234": None,
        "00:00:01.": None, "00:00:01 x": None, "00:00:00:00": None, "9" * 25 + ":00:00": None,
    }
    assert column(spark, list(cases), T.readable_ms) == list(cases.values())


def test_readable_ranges(spark):
    ranges = {
        "[00:00:00.000] - [00:01:00.000]": (0, 60_000), "[00:00:00.000] – [00:01:00.000]": (0, 60_000), "00:00:00.000-00:01:00.000": (0, 60_000),
        "[00:01:00.000] - ": (None, None), "n/a": (None, None), "": (None, None), None: (None, None), "[00:01:00] - [00:61:00]": (None, None),
    }
    got = column(spark, list(ranges), lambda c: F.struct(*T.readable_range_ms(c)))
    assert [tuple(g) for g in got] == list(ranges.values())


def test_lenient_seconds(spark):
    cases = {
        "[00:00:59]": 59.0, " 00:01:02.250 ": 62.25, "00:01": 0.0, "aa:00:01": 0.0, None: 0.0, "": 0.0, "00:75:00": 4500.0, "-1:00:00": -3600.0,
        "00:00:1.5e1": 6.0, "00:00:1.5.9": 1.5, "00:00:": 0.0, "[00:61:00:00]": 0.0, "00:00:07 ": 7.0,
    }
    assert column(spark, list(cases), T.parse_seconds) == pytest.approx(list(cases.values()))


def test_formats_round_half_to_even_and_carry(spark):
    assert column(spark, [0.5, 1.5, 2.5, 3599.5, 360000.0], T.format_seconds, "double") == ["[00:00:00]", "[00:00:02]", "[00:00:02]", "[01:00:00]", "[100:00:00]"]
    assert column(spark, [0.9996, 59.9999, 1.25, 0.0], T.format_millis, "double") == ["[00:00:01.000]", "[00:01:00.000]", "[00:00:01.250]", "[00:00:00.000]"]


def test_round_millis_is_by_the_exact_value(spark):
    import random

    random.seed(4)
    xs = [0.0, 2.0005, 1.0005, 0.0625, 0.1875, 0.0005, 0.9995, 12.3456, 3599.9995, 1e11 + 0.0625, 5e14, -0.0625, -2.0005, -0.0004]
    xs += [random.random() * 10 ** random.randrange(0, 7) for _ in range(3000)] + [k / 2000 for k in range(1, 4000, 2)] + [k / 16 for k in range(500)]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(T.round_millis(F.col("x"))).collect()]
    assert got == [round(x, 3) for x in xs]
    assert spark.sql("SELECT CAST(null AS DOUBLE) AS x").select(T.round_millis(F.col("x"))).first()[0] is None
