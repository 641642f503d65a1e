import json
import random

from pyspark.sql import functions as F

from storyflow.operators import nested as N


def brute(payload):
    """The same rows by an ordinary JSON parser."""
    try:
        top = json.loads((payload or "").lstrip("﻿").strip())
    except ValueError:
        return []
    if not isinstance(top, dict):
        return []
    many = lambda v: [(i, x) for i, x in enumerate(v if isinstance(v, list) else [v]) if x is not None] if v is not None else []
    text = lambda v: v if isinstance(v, str) else ""
    obj = lambda v: v if isinstance(v, dict) else {}
    out = []
    for ci, c in many(top.get("chapters")):
        out.append(("chapter", ci, -1, -1, text(obj(c).get("chapter_id"))))
        for ei, e in many(obj(c).get("events")):
            out.append(("event", ci, ei, -1, text(obj(e).get("event_id"))))
            out += [("character", ci, ei, i, text(p.get("name")) if isinstance(p, dict) else text(p)) for i, p in many(obj(e).get("characters_in_event"))]
            out += [("key_frame", ci, ei, i, text(k)) for i, k in many(obj(e).get("key_frame_times"))]
    return sorted(out)


BOARD = {
    "video_path": "/a \"b\" \\ c.mp4", "extra": {"chapters": [1]},
    "chapters": [
        {"chapter_id": "ch_01", "events": [{"event_id": "e1", "characters_in_event": [{"name": "[A] 中 \"q\"", "desc": "x]"}, None, {"desc": "no name"}], "key_frame_times": ["[00:00:01]", None, " x "]}, None, {}]},
        None,
        {"chapter_id": None, "events": {"event_id": "single", "characters_in_event": {"name": "one"}, "key_frame_times": "[00:00:02]"}},
        {"events": []}, {"events": None},
    ],
}


def test_shapes():
    for text in (json.dumps(BOARD), json.dumps(BOARD, indent=2, ensure_ascii=False), "﻿ " + json.dumps(BOARD) + "\n"):
        assert sorted(N.storyboard_rows(text)) == brute(text) != []
    for text in (None, "", " ", "null", "[]", "[1]", "3", '"x"', "{", '{"chapters": [1,]}', '{"chapters": [] } x', '{"a" 1}', '{"a": tru}', '{"a": "\\x"}', '{"a": "\t"}', "{'a': 1}"):
        assert N.storyboard_rows(text) == []
    assert N.storyboard_rows('{"chapters": {"chapter_id": "x"}, "chapters": []}') == []


def test_fuzz_against_parser():
    random.seed(3)
    base = [json.dumps(BOARD), json.dumps(BOARD, indent=1)]
    for _ in range(4000):
        p = list(random.choice(base))
        for _ in range(random.choice([1, 1, 2, 3])):
            i = random.randrange(len(p))
            pick = random.random()
            if pick < 0.4:
                del p[i]
            elif pick < 0.7:
                p[i] = random.choice('{}[],:"\\ \n1nt')
            else:
                p.insert(i, random.choice('{}[],:"\\ 1'))
        text = "".join(p)
        assert sorted(N.storyboard_rows(text)) == brute(text), text


def test_very_long_text():
    board = {"chapters": [{"chapter_id": "c", "title": "\\\"" * 200_000, "events": [{"event_id": str(i)} for i in range(5000)]}]}
    assert len(N.storyboard_rows(json.dumps(board))) == 5001


def test_frames_with_duplicates_and_clashing_columns(spark):
    raw = spark.createDataFrame([("r", json.dumps(BOARD)), ("r", json.dumps(BOARD)), ("s", None), ("t", "{")], "run_id string, payload string").withColumn("level", F.lit(1))
    got = [tuple(r)[1:2] + tuple(r)[3:] for r in N.json_children(raw).dropDuplicates().collect()]
    assert sorted(got) == brute(json.dumps(BOARD))
    chapters = spark.createDataFrame([("r", [{"chapter_id": "a", "events": [{"event_id": "x"}, None]}, None, {"chapter_id": None, "events": None}])], "run_id string, chapters array<struct<chapter_id:string,events:array<struct<event_id:string>>>>")
    assert sorted(tuple(r)[1:] for r in N.chapter_children(chapters).collect()) == [("chapter", "r", 0, -1, -1, "a"), ("chapter", "r", 2, -1, -1, ""), ("event", "r", 0, 0, -1, "x")]
