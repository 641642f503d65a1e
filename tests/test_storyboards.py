"""Storyboard files: tolerant reading, unnamed members, round trips."""

import json

from pyspark.sql import functions as F

from storyflow.sources import storyboards as B

DOC = {
    "video_path": "/in/a.mp4", "video_summary": None, "rating": 5,
    "chapters": [
        {"chapter_id": "ch_01", "title": "One \"x\"", "mood": "calm", "events": [
            {"event_id": "e1", "start_time": "[00:00:01]", "key_frame_times": ["[00:00:01]", None], "characters_in_event": [{"name": "[A]", "desc": "tall"}], "frame_timestamps": [1.5, 2.0],
             "note": "say \"hi\"", "tags": [1, "b", None], "we\"ird": {"a": {"b": True}}, "empty": None},
            None, {"event_id": "e2"}, 7,
        ]},
        {"chapter_id": None, "events": None}, {"events": []}, None,
    ],
}


def test_unnamed_members_of_events_survive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(DOC, indent=2))
    docs = B.read(spark, str(tmp_path / "in"))
    e1 = docs.first().chapters[0].events[0]
    assert (e1.event_id, e1.characters_in_event[0].desc, e1.frame_timestamps) == ("e1", "tall", [1.5, 2.0])
    assert {k: json.loads(v) for k, v in e1.other.items()} == {k: DOC["chapters"][0]["events"][0][k] for k in ("note", "tags", "we\"ird", "empty")}
    B.write(docs.withColumn("video_id", F.lit("v")), str(tmp_path / "out"))
    again = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert again["video_path"] == "/in/a.mp4" and "rating" not in again and "mood" not in again["chapters"][0]
    events = again["chapters"][0]["events"]
    want = dict.fromkeys(B.MEMBERS) | DOC["chapters"][0]["events"][0]
    assert events[0] == want and events[1] is None and events[2] == dict.fromkeys(B.MEMBERS) | {"event_id": "e2"} and events[3] == dict.fromkeys(B.MEMBERS)
    assert again["chapters"][1]["events"] is None and again["chapters"][2]["events"] == [] and again["chapters"][3] is None
    B.write(B.read(spark, str(tmp_path / "out")).withColumn("video_id", F.lit("v")), str(tmp_path / "twice"))
    assert json.loads(spark.read.text(str(tmp_path / "twice")).first().value) == again


def test_files_that_are_no_storyboards(spark, tmp_path):
    for name, text in (("a.json", "not json"), ("b.json", "[1, 2]"), ("c.json", ""), ("d.json", '{"chapters": 5}'), ("e.json", '{"video_path": "x"}')):
        (tmp_path / name).write_text(text)
    got = {r.file.rsplit("/", 1)[1]: (r.video_path, r.chapters) for r in B.read(spark, str(tmp_path)).collect()}
    assert got.pop("e.json") == ("x", None) and all(v == (None, None) for v in got.values())


def test_nesting_in_order_with_other_members(spark):
    ev = spark.createDataFrame([("v", 0, 10, "b", {"k": "1"}), ("v", 0, 2, "a", None), ("v", 11, 1, "c", None)], "video_id string, ch_idx int, ord int, event_id string, other map<string,string>")
    ch = spark.createDataFrame([("v", i, f"ch{i}", None, None, None, None) for i in (11, 2, 0)], "video_id string, ch_idx int, chapter_id string, title string, chapter_summary string, start_time string, end_time string")
    doc = B.nest(ev, ch, spark.createDataFrame([("v", "p", "s"), ("w", "q", None)], "video_id string, video_path string, video_summary string")).orderBy("video_id").collect()
    assert [(c.chapter_id, [e.event_id for e in c.events]) for c in doc[0].chapters] == [("ch0", ["a", "b"]), ("ch2", []), ("ch11", ["c"])]
    assert doc[0].chapters[0].events[1].other == {"k": "1"} and doc[1].chapters == []
