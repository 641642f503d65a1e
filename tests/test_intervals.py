import random

from pyspark.sql import functions as F

from storyflow.operators import intervals as I


def brute(rows):
    """(key, kind, s, e) by sorting all intervals of a key."""
    by = {}
    for k, a, b in rows:
        if a is not None and b is not None and a != b:
            by.setdefault(k, []).append((min(a, b), max(a, b)))
    out = []
    for k, xs in by.items():
        merged = []
        for s, e in sorted(xs):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(k, "period", s, e) for s, e in merged]
        out += [(k, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])]
    return sorted(out)


def run(spark, rows, shard):
    df = spark.createDataFrame(rows, "k string, a long, b long").withColumn("shard", F.lit("clash"))
    return sorted(tuple(r) for r in I.periods_and_gaps(df, ["k"], "a", "b", shard).select("k", "kind", "start_ms", "end_ms").collect())


def test_random_intervals_at_every_shard_width(spark):
    random.seed(7)
    rows = []
    for k in "abc":
        for _ in range(60):
            a = random.randrange(0, 3000, 10)
            rows.append((k, a, a + random.choice([0, 10, 10, 20, 300, -40])))
    rows += [("d", 0, 5000), ("d", 4000, 4001), ("e", None, 5), ("e", 5, None), ("f", 100, 100), ("g", 100, 200), ("g", 200, 300), ("g", 100, 200)]
    expected = brute(rows)
    for shard in (10, 37, 100, 1000, 100_000):
        assert run(spark, rows, shard) == expected


def test_hot_key_with_repeats(spark):
    rows = [("hot", i % 500 * 7, i % 500 * 7 + 5) for i in range(5000)]
    assert run(spark, rows, 50) == brute(rows)


def test_empty(spark):
    assert run(spark, [], 100) == []


def test_intervals_over_many_shards(spark):
    """However long an interval is, it gives three rows."""
    far = 99_999_999 * 3_600_000
    rows = [("a", 0, far), ("a", 500, 700), ("a", far, far + 20), ("a", far + 50, far + 60), ("b", 95, 2055), ("b", 2060, 2070), ("b", 300, 310), ("b", 1000, 1990), ("b", 10, 20), ("c", 0, 900), ("c", 900, 901)]
    for shard in (10, 100, 120_000):
        assert run(spark, rows, shard) == brute(rows)


def test_random_long_and_short_intervals(spark):
    random.seed(3)
    rows = [(random.choice("abcdefgh"), a := random.randrange(0, 40_000), a + random.choice([1, 3, 7, 40, 200, 3000])) for _ in range(300)]
    for shard in (5, 64, 333):
        assert run(spark, rows, shard) == brute(rows)


def test_an_end_of_a_hundred_million_hours(spark):
    cols = "run_id string, start_time string, end_time string, chunk_time_range string"
    df = spark.createDataFrame([("r", "[00:00:01]", "[99999999:00:00]", "[00:00:00] - [99999:00:00]"), ("r", "00:00:00.5", "00:00:00.75", "no"), (None, None, None, None)], cols)
    got = sorted(tuple(r) for r in I.periods_and_gaps(I.level_intervals(df), ["run_id", "level"], "a", "b").collect())
    assert got == [("r", "chunk", "period", 0, 99_999 * 3_600_000), ("r", "event", "gap", 750, 1000), ("r", "event", "period", 500, 750), ("r", "event", "period", 1000, 99_999_999 * 3_600_000)]
