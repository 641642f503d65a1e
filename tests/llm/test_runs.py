import random

from pyspark.sql import functions as F

from storyflow.llm import runs

COLS = "run_id string, chunk_i int, ev_i int, start_time string, end_time string, step3_synthesized_dense_caption string"


def collapse(spark, rows):
    df = spark.createDataFrame(rows, COLS).withColumns({"ingested_at": F.monotonically_increasing_id(), "k": F.lit("clash"), "seg": F.lit(1)})
    return sorted(tuple(r) for r in runs.collapse_runs(df).collect())


def keys(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.k for r in runs.with_caption_key(df, "t", "k").orderBy("i").collect()]


def test_keys_drop_the_surface_only(spark):
    same = [
        "[Ann] lifts the Straße; slowly.", "  (ANN)  LIFTS THE STRASSE slowly", "Then: [ann] lifts the strasse, slowly (continued)", "「Ann」 lifts the Straße slowly. And so it goes on.",
        "Once more [Ann] lifts the Straße slowly [cont.]",
    ]
    assert len(set(keys(spark, same))) == 1
    assert keys(spark, ["再次，[安]在狭窄的楼梯间。动作仍在继续。"]) == keys(spark, ["[安] 在狭窄楼梯间"])
    assert keys(spark, [None, "", "  ​\n"]) == [None, None, None]
    assert keys(spark, ["...", "Then"]) == ["...", "then"]


def test_slips_and_differences(spark):
    base = "while daka examines the headlights on the table"
    cases = {
        base: True, base.replace("while", "whlie"): True, base.replace("headlights", "headligthts"): True, base.replace("examines", "exaamines"): True, base.replace("the table", "teh table"): True,
        base.replace("daka", "kada"): False, base.replace("daka", "dakaka"): False, base.replace("examines", "polishes"): False, base.replace("on", "in"): False, base + " slowly": False,
        base.replace("daka", "rove"): False, base.replace("headlights", "healdights"): True, base.replace("headlights", "headlight"): False, base.replace("table", "stable"): False,
    }
    df = spark.createDataFrame([(base, c) for c in cases], "a string, b string")
    got = [r[0] for r in df.select(runs.same_telling(F.col("a"), F.col("b"))).collect()]
    assert got == list(cases.values())


def test_slips_on_both_sides(spark):
    pairs = {("healdights", "headligthts"): True, ("suuspicious", "suspiicous"): True, ("visiblemente", "visiblmeentte"): True, ("started", "stared"): False, ("silent", "listen"): False, ("bowl", "bow"): False}
    df = spark.createDataFrame(list(pairs), "a string, b string")
    assert [r[0] for r in df.select(runs.same_telling(F.col("a"), F.col("b"))).collect()] == list(pairs.values())
    long = " ".join(f"word{i} lantern" for i in range(60))
    many = long.replace("lantern", "lanntern")  # sixty slips in one caption
    assert spark.createDataFrame([(long, many)], "a string, b string").select(runs.same_telling(F.col("a"), F.col("b"))).first()[0]


def test_misspelt_linking_phrase(spark):
    assert len(set(keys(spark, ["Once more looking calm, [Ann] waits", "Ocne more Looking calm, [ann] waits.", "looking calm [Ann] waits"]))) == 1


def test_order_is_by_time_however_it_is_written(spark):
    rows = [
        ("r", 0, 0, "[00:00:50]", None, "[A] waits."), ("r", 0, 1, "00:00:52", None, "[B] runs."), ("r", 0, 2, " [00:00:54] ", None, "[B] runs"), ("r", 0, 3, "【00:00:56.5】", "[00:00:57]", "[B] runs"),
        ("r", 0, 4, "[000:01:58]", None, "[A] waits."), ("r", 0, 5, "00:01:59.250", None, "[A] waits"), ("r", 0, 6, "[00:02:01]", None, "[A] waits"),
        ("r", 0, 9, "00:03:00", None, "[C] sits"), ("r", 0, 8, "[00:03:00]", None, "[A] waits"), ("r", 0, 7, " 00:03:00", None, "[A] waits"),  # one time: chunk_i and ev_i decide
    ]
    assert collapse(spark, rows) == [("r", 0, 1, 3, 5_000), ("r", 0, 4, 5, 62_000)]


def test_an_earlier_end_beyond_the_stretch_does_not_count(spark):
    rows = [("r", 0, 0, "[00:00:01]", "[00:30:00]", "[A] waits."), ("r", 0, 1, "[00:00:02]", "[00:00:09]", "[B] runs."), ("r", 0, 2, "[00:00:03]", "[00:00:04]", "[B] runs.")]
    assert collapse(spark, rows) == [("r", 0, 1, 2, 7_000)]


def test_stretches(spark):
    rows = [
        ("r", 0, 0, "[00:00:50]", "[00:00:55]", "[A] waits."), ("r", 0, 0, "[00:00:50]", "[00:00:55]", "[A] waits."),  # delivered twice
        ("r", 0, 1, "[00:00:56]", "[00:09:00]", "Again, [A] waits"), ("r", 1, 0, "[00:01:02]", None, "[a] WAITS (continued)"),  # over a minute's edge
        ("r", 1, 1, "[00:01:03]", "[00:01:04]", " "), ("r", 1, 2, "[00:01:05]", "[00:01:06]", "[A] waits."), ("r", 1, 3, "bad", "[00:01:07]", "[A] waits."),
        ("r", 1, 4, "[00:01:08]", "[00:01:02]", "[A] waits."), ("s", 0, 0, "[00:00:01]", "[00:00:02]", "[A] waits."), ("s", 0, 1, "[00:00:03]", "[00:00:04]", "[B] waits."),
        ("t", 0, 0, "[00:00:01]", None, None), ("t", 0, 1, "[00:00:02]", None, None),
    ]
    assert collapse(spark, rows) == [("r", 0, 0, 3, 490_000), ("r", 1, 2, 2, 3_000)]
    assert collapse(spark, []) == []


def test_one_hot_run_against_brute_force(spark):
    random.seed(11)
    rows = []
    for i in range(900):
        at = i * 7
        t = f"[{at // 3600:02d}:{at // 60 % 60:02d}:{at % 60:02d}]"
        rows.append(("hot", at // 60, i, t, t, random.choice(["[A] waits.", "[A] waits", "[B] runs.", None, ""])))
    for i in range(60):
        rows.append((f"r{i % 7}", 0, i, "[00:00:01]", "[00:00:02]", "[A] waits."))  # ties in start
    want, by = [], {}
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    sec = lambda t: sum(int(x) * m for x, m in zip(t.strip("[]").split(":"), (3_600_000, 60_000, 1000)))
    for run, rs in by.items():
        cur, last = [], None
        for r in [*rs, None]:
            k = (r[5] or "").strip(".") or None if r else None
            if cur and (k is None or k != last):
                if len(cur) > 1:
                    want.append((run, cur[0][1], cur[0][2], len(cur), max(sec(x[4]) for x in cur) - sec(cur[0][3])))
                cur = []
            if k is not None:
                cur.append(r)
            last = k
    assert collapse(spark, rows) == sorted(want)
