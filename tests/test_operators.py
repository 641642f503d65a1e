"""Reference operators against plain-Python recurrences and hand-made cases."""

import math
import random
import re

from pyspark.sql import functions as F

from storyflow.functions import text as X
from storyflow.operators import chapters as C
from storyflow.operators import identity as I
from storyflow.operators import pieces
from storyflow.operators import refine as R
from storyflow.operators import sampling as S
from storyflow.operators import snap
from storyflow.operators import story as Y
from storyflow.operators import usage as U


def test_frame_budget_equals_the_running_rule(spark):
    random.seed(1)
    rows, expected = [], {}
    for g in range(60):
        n, most = random.randint(1, 12), 17
        d = [round(random.random() * random.choice([0.1, 1, 30]), 3) for _ in range(n)]
        left, total = most, sum(d) or 1e-5
        for i, x in enumerate(d):
            take = left if i == n - 1 else max(1, round(x / total * most))
            take = min(take, left)
            left -= take
            expected[g, i] = take
        at = 0.0
        for i, x in enumerate(d):
            rows.append((g, i, at, at + x))
            at += x
    df = spark.createDataFrame(rows, "g int, scene_idx int, s double, e double")
    got = {(r.g, r.scene_idx): r.alloc for r in S.frame_budget(df, ["g"], 17).collect()}
    near = sum(got[k] != v for k, v in expected.items())
    assert near <= 2  # sums of doubles may fall on either side of a half
    assert all(sum(v for (g, _), v in got.items() if g == k) == 17 for k in range(60))


def test_times_and_samples(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first().x
    assert pick(S.inner_points(F.lit(0.0), F.lit(4.0), F.lit(3))) == [1.0, 2.0, 3.0]
    assert pick(S.inner_points(F.lit(0.0), F.lit(4.0), F.lit(1))) == [2.0]
    assert pick(S.inner_points(F.lit(0.0), F.lit(4.0), F.lit(0))) == []
    for n in range(0, 12):
        for k in (1, 2, 3, 4):
            want = list(range(n)) if n <= k else [0] if k == 1 else [0, n - 1] if k == 2 else sorted({0, n - 1} | {round(j * (n - 1) / (k - 1)) for j in range(1, k - 1)})
            assert pick(S.even_sample(F.lit(n), k)) == want
    assert pick(S.clip_frames(F.lit(1.0), F.lit(2.0), F.lit(10.0), 4.0)) == [10, 12, 14, 16, 18, 20]
    assert pick(S.event_frame_count(F.lit(1.0), F.lit(1.0), 1.0, 5)) is None


def test_empty_scene_set_becomes_the_chunk(spark):
    chunks = spark.createDataFrame([("v", 0, 0.0, 60.0), ("v", 1, 60.0, 90.0), ("w", 0, 0.0, 10.0)], "v string, chunk_i int, chunk_start double, chunk_end double")
    scenes = spark.createDataFrame([("v", 0, 50.0, 70.0), ("v", 1, 70.0, 70.0), ("v", 2, 75.0, 500.0)], "v string, scene_idx int, start_sec double, end_sec double")
    got = sorted(tuple(r) for r in S.clip_scenes(scenes, chunks, "v").select("v", "chunk_i", "scene_idx", "s", "e").collect())
    assert got == [("v", 0, 0, 50.0, 60.0), ("v", 1, 0, 60.0, 70.0), ("v", 1, 1, 75.0, 90.0), ("w", 0, 0, 0.0, 10.0)]


def snapped(spark, rows, allowed, start=0.0, end=60.0):
    df = spark.createDataFrame(rows, "i int, start_time string, end_time string")
    df = df.withColumns({"chunk_start": F.lit(start), "chunk_end": F.lit(end), "allowed": snap.timed(F.array(*[F.lit(a) for a in allowed]).cast("array<string>"))})
    return [tuple(r) for r in snap.snap_events(df).select("i", "start_time", "end_time").orderBy("i").collect()]


def test_snap_order(spark):
    allowed = ["[00:00:00]", "[00:00:10]", "[00:00:20]", "[00:01:10]"]
    rows = [
        (0, "[00:00:10.005]", "[00:00:19]"),  # within a hundredth; nearest
        (1, "[00:00:05]", "[00:00:20]"),  # a tie takes the earlier
        (2, "garbage", "[00:00:10]"),  # unreadable reads as 0
        (3, "[00:00:20]", "[00:00:00]"),  # exchanged
        (4, "[00:00:11]", "[00:00:09]"),  # both snap to one: dropped
        (5, "[00:00:10]", "[00:01:30]"),  # clamped at the right edge
        (6, None, None),
    ]
    assert snapped(spark, rows, allowed) == [
        (0, "[00:00:10]", "[00:00:20]"), (1, "[00:00:00]", "[00:00:20]"), (2, "[00:00:00]", "[00:00:10]"), (3, "[00:00:00]", "[00:00:20]"), (5, "[00:00:10]", "[00:00:20]"),
    ]
    assert snapped(spark, [(0, "x", "y")], []) == [(0, "x", "y")]
    assert snapped(spark, [(0, "[00:00:00]", "[00:01:10]")], allowed, 10.0, 80.0) == [(0, "[00:00:10]", "[00:01:10]")]


def test_relay(spark):
    row = spark.createDataFrame([(0.0, 60.0, 4.9, None), (0.0, 60.0, 58.0, 40.0), (0.0, 60.0, 70.1, 1.0), (60.0, 120.0, 120.0, 60.5)], "a double, b double, c double, d double")
    got = [tuple(r) for r in row.select(snap.next_start(F.col("a"), F.col("b"), F.col("c")), snap.next_start(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got == [(48.0, 48.0), (58.0, 40.0), (48.0, 48.0), (120.0, 120.0)]


def test_revisions(spark):
    e = spark.createDataFrame([("r", 0, 0, "[00:00:01]", "[00:00:05]", "a"), ("r", 0, 1, "[00:00:05]", "[00:00:09]", "b"), ("r", 2, 0, "[00:00:09]", "[00:00:12]", "c")], "run_id string, chunk_i int, ev_i int, start_time string, end_time string, step3_synthesized_dense_caption string")
    cols = "run_id string, chunk_i int, need_merge boolean, start_time string, end_time string, step3_synthesized_dense_caption string"
    run = lambda r: [(x.chunk_i, x.ev_i, x.end_time, x.step3_synthesized_dense_caption) for x in snap.apply_revisions(e, spark.createDataFrame(r, cols)).orderBy("chunk_i", "ev_i").collect()]
    base = [(0, 0, "[00:00:05]", "a"), (0, 1, "[00:00:09]", "b"), (2, 0, "[00:00:12]", "c")]
    assert run([("r", 2, True, "[00:00:05.004]", "[00:00:11]", None)]) == [base[0], (0, 1, "[00:00:11]", "b"), base[2]]
    assert run([("r", 2, False, "[00:00:05]", "[00:00:11]", "x")]) == base
    assert run([("r", 2, True, "[00:00:06]", "[00:00:11]", "x")]) == base
    assert run([("r", 0, True, "[00:00:01]", "[00:00:11]", "x")]) == base


def test_chapters_touching_overflow_and_fallback(spark):
    e = spark.createDataFrame([("r", 0, i, s) for i, s in enumerate(["[00:00:00]", "[00:00:09.6]", "[00:00:10]", "[00:00:25]", "[05:00:00]"])] + [("q", 0, 0, "[00:00:01]"), ("q", 0, 1, None)], "run_id string, chunk_i int, ev_i int, start_time string").withColumn("end_time", F.col("start_time"))
    c = spark.createDataFrame([("r", 0, "[00:00:01]", "[00:00:10]"), ("r", 1, "[00:00:10]", "[00:00:20]")], "run_id string, ch_idx int, start_time string, end_time string")
    m = C.mount(e, c)
    got = sorted((r.ch_idx, r.ev_i, r.event_id) for r in m.collect())
    assert got == [(0, 1, "ev_01_001"), (1, 1, "ev_02_001"), (1, 2, "ev_02_002"), (1, 3, "ev_02_003")]  # the second stands in both
    over = sorted((r.ev_i, r.event_id) for r in C.overflow(e.where("run_id = 'r'"), c, m).collect())
    assert over == [(3, "ev_fallback_004"), (4, "ev_fallback_005")]  # also what the last chapter has already
    lost = sorted((r.ev_i, r.event_id) for r in C.overflow(e.where("run_id = 'r'"), c, m, lost_only=True).collect())
    assert lost == [(0, "ev_fallback_004"), (4, "ev_fallback_005")]
    assert sorted((r.ch_idx, r.ev_i) for r in C.mount(e, c, once=True).collect()) == [(0, 1), (1, 2), (1, 3)]
    assert [tuple(r) for r in C.single_chapter(e, c).collect()] == [("q", 0, "ch_01", "[00:00:01]", None)]


def test_names_and_candidates(spark):
    df = spark.createDataFrame([("r", 0, " 【Ann】"), ("r", 1, "[ann]"), ("r", 2, "〈〉"), ("r", 3, None), ("r", 4, "Bob")], "r string, i int, n string")
    assert [(r.i, r.norm, r.n_same) for r in I.first_by_name(df, ["r"], ["i"], "n").orderBy("i").collect()] == [(0, "ann", 2), (4, "bob", 1)]


def test_cluster_fold(spark):
    rows = [
        ("r", 0, "cluster_0001", 99), ("r", 1, "NEW", None), ("r", 2, "cluster_0002", 49), ("r", 3, "cluster_0003", 50), ("r", 4, "cluster_0003", 79),
        ("r", 5, "cluster_0003", 80), ("r", 6, "new", 90), ("r", 7, "cluster_0004", None), ("r", 8, None, 90), ("r", 9, "cluster_4", 90), ("s", 0, " NEW ", 1),
    ]
    df = spark.createDataFrame(rows, "run_id string, p int, match_result string, confidence_score int")
    got = [(r.p, int(r.cluster_id[8:]), r.is_new, r.low_conf) for r in I.fold_clusters(df).where("run_id = 'r'").orderBy("p").collect()]
    assert got == [(0, 1, True, False), (1, 2, True, False), (2, 3, True, False), (3, 3, False, True), (4, 3, False, True), (5, 3, False, False), (6, 4, True, False), (7, 4, False, False), (8, 5, True, False), (9, 6, True, False)]


def test_single_pass_rewriting(spark):
    random.seed(5)
    names = ["A", "AB", "[A]", "a.b", "$1", "x\\Ey", "B A", "中", "中文"]
    rows, want = [], []
    for i in range(150):
        table = {k: random.choice(["<A>", "AB", "$0", "\\", "", "中文"]) for k in random.sample(names, random.randint(0, 5))}
        text = "".join(random.choice([*names, " ", "z"]) for _ in range(random.randint(0, 12)))
        rows.append((i, text, table))
        keys = sorted(table, key=len, reverse=True)
        want.append(re.sub("|".join(map(re.escape, keys)), lambda m, t=table: t[m[0]], text) if keys else text)
    df = spark.createDataFrame(rows, "i int, t string, m map<string,string>")
    got = df.select("i", X.rewrite(F.col("t"), X.any_of(F.map_keys("m")), F.col("m")).alias("x")).orderBy("i").collect()
    assert [r.x for r in got] == want


def test_text_functions(spark):
    df = spark.createDataFrame([(0, "```json\n{}\n```"), (1, "``` {} "), (2, "{}"), (3, " . "), (4, 'a<b>:"c.')], "i int, t string")
    got = [tuple(r) for r in df.select(X.clean_json(F.col("t")), X.sanitize(F.col("t"))).collect()]
    assert [g[0] for g in got[:3]] == ["{}", "{}", "{}"]
    assert [g[1] for g in got[3:]] == ["unnamed", "a_b___c"]
    b = spark.createDataFrame([("Ann and Anna, 中Ann", "Ann", "$1\\"), ("x", "", "y"), (None, "a", "b")], "t string, o string, n string")
    assert [r[0] for r in b.select(X.bounded_replace(F.col("t"), F.col("o"), F.col("n"))).collect()] == ["$1\\ and Anna, 中Ann", "x", None]


def test_refine_helpers(spark):
    e = spark.createDataFrame([("r", 0, "e1", "[00:00:00]", "[00:00:05]", "x"), ("r", 1, "e2", "[00:00:05]", "[00:00:05.2]", ""), ("r", 1, "e3", "[00:00:07]", "[00:00:06]", "z"), ("r", 1, "e4", "[00:00:06]", "[00:00:09]", None)], "run_id string, ch_idx int, event_id string, start_time string, end_time string, cap string")
    got = {r.event_id: r.actual_start for r in R.adjusted_start(e, "run_id", ["ch_idx", "event_id"]).collect()}
    assert got.keys() == {"e1", "e2", "e4"} and math.isclose(got["e2"], 5.19) and math.isclose(got["e4"], 6.5) and got["e1"] == 0
    assert {r.event_id: r.previous for r in R.previous_caption(e, ["run_id", "ch_idx"], "event_id", "cap").collect()} == {"e1": "", "e2": "", "e3": "", "e4": "z"}
    p = R.progress(e, ["run_id"], "cap").first()
    assert (p.total, p.done, p.remaining) == (4, 2, 2)


def test_story_and_usage(spark):
    s = spark.createDataFrame([("r", 0, " a "), ("r", 1, None), ("r", 2, "c")], "r string, i int, s string")
    assert [(r.kept, r.all_lines) for r in Y.story_so_far(s, "r", "i", F.col("s")).orderBy("i").collect()] == [("", ""), ("a", "Part 1:  a \n"), ("a", "Part 1:  a \nPart 2: \n")]
    calls = spark.createDataFrame([("v", "s", 1, 2, 3), ("v", "s", None, None, None), ("v", "t", 5, None, 5), ("w", None, 1, 1, 2)], "video_id string, stage string, prompt_tokens long, completion_tokens long, total_tokens long")
    assert sorted(tuple(r) for r in U.by(calls, "video_id").collect()) == [("v", 6, 2, 8, 2), ("w", 1, 1, 2, 1)]
    assert U.rollup(calls).where("grain = 3").first()[2:6] == (7, 3, 10, 3)


def test_times_of_any_size_give_few_buckets(spark):
    """Readable nonsense in a time neither breaks the mounting nor loses an event."""
    ch = [("r", 0, "[00:00:00]", "[99999999:00:00]"), ("r", 1, "[00:10:00]", "[00:20:00]"), ("r", 2, "[300:00:00]", "[99999999:00:00]"), ("s", 0, "-9999:00:00", "00:00:10")]
    ev = [("r", 0, 0, "[00:00:01]"), ("r", 0, 1, "[00:15:00]"), ("r", 0, 2, "[99999998:00:00]"), ("r", 0, 3, "[200:00:00]"), ("s", 0, 0, "-9998:00:00"), ("s", 0, 1, "00:00:09.9")]
    c = spark.createDataFrame(ch, "run_id string, ch_idx int, start_time string, end_time string")
    e = spark.createDataFrame(ev, "run_id string, chunk_i int, ev_i int, start_time string")
    got = sorted((r.run_id, r.ch_idx, r.ev_i) for r in C.mount(e, c).collect())
    assert got == [("r", 0, 0), ("r", 0, 1), ("r", 0, 2), ("r", 0, 3), ("r", 1, 1), ("r", 2, 2), ("s", 0, 0), ("s", 0, 1)]
    t = spark.range(-3000, 3000).select((F.expr("sign(id) * pow(1.02, abs(id))")).alias("t")).orderBy("t")
    b = [r[0] for r in t.select(C._bucket(F.col("t"), 600.0)).collect()]
    assert b == sorted(b) and max(b) < 6000


def test_scenes_far_beyond_the_video(spark):
    chunks = spark.createDataFrame([("v", 0, 0.0, 60.0), ("v", 1, 60.0, 90.0)], "video_id string, chunk_i int, chunk_start double, chunk_end double")
    scenes = spark.createDataFrame([("v", 0, 10.0, 1e15), ("v", 1, 1e14, 1e15), ("w", 0, 0.0, 9.0)], "video_id string, scene_idx int, start_sec double, end_sec double")
    got = sorted(tuple(r) for r in S.clip_scenes(scenes, chunks, "video_id").collect())
    assert got == [("v", 0, 0.0, 60.0, 0, 10.0, 60.0), ("v", 1, 60.0, 90.0, 0, 60.0, 90.0)]


def test_neighbours_and_numbers_over_pieces(spark):
    random.seed(9)
    rows = [(k, p, i, random.choice([None, 1.0, 2.5, 7.0])) for k in ("a", "b", None) for p in (0, 3, 4, 9) for i in range(random.choice([1, 2, 30]))]
    df = spark.createDataFrame(rows, "k string, p int, i int, v double").withColumns({"_size": F.lit(1), "x": F.lit("y")}).drop("_size")
    want, by = {}, {}
    for r in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        for n, r in enumerate(rs):
            want[r[:3]] = (rs[n - 1][3] if n else None, rs[n + 1][3] if n + 1 < len(rs) else None, n + 1)
    out = pieces.numbered(pieces.neighbour(pieces.neighbour(df, "k", ["p", "i"], F.col("v"), "before"), "k", ["p", "i"], F.col("v"), "after", ahead=True), "k", ["p", "i"], "n")
    assert {(r.k, r.p, r.i): (r.before, r.after, r.n) for r in out.collect()} == want
    assert pieces.numbered(df.limit(0), "k", ["p", "i"], "n").count() == 0
