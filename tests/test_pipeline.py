"""The pipeline end to end, with a decoder and a model made up for the test."""

import json
import re

import pytest
from pyspark.sql import functions as F

from storyflow.operators.identity import fold_clusters
from storyflow.pipeline import Config, model, relay, run_batch, stages
from storyflow.pipeline.cli import parser, settings
from storyflow.pipeline.state import Workspace


class FakeDecoder:
    def probe(self, path):
        return None if "broken" in path else {"fps": 10.0, "frame_count": 1505 if "long" in path else 300, "width": 64, "height": 48}

    def frames(self, path, times, max_width, quality):
        return [(t, f"{path}@{t:.3f}".encode()) for t in times]

    def clip(self, path, start, end, max_width, fps):
        return [start + i for i in range(int(end - start) + 1)], f"{path}@{start}".encode()

    def scenes(self, path, threshold):
        return [(0.0, 20.0), (20.0, 90.0)]


def fake_model(request):
    """Answers by rule, from what the request says."""
    text = "\n".join(p["text"] for p in request["parts"] if p["text"])
    usage = {"prompt_tokens": 10, "completion_tokens": 5, "total_tokens": 15}
    if request["stage"] == "perception":
        if any(b"fails" in (p["media"] or b"") for p in request["parts"]):
            raise RuntimeError("no answer")
        t = re.search(r"## Allowed times\n(.*)", text)[1].split(", ")
        mid = t[len(t) // 2]
        out = {
            "chunk_summary": f"From {t[0]}.", "characters_in_chunk": [{"temp_name": "Ann", "visual_description": "tall", "anchor_timestamp": t[0]}, {"temp_name": "【ann】"}],
            "events": [{"start_time": t[0], "end_time": mid, "step3_synthesized_dense_caption": "Ann waits."}, {"start_time": mid, "end_time": t[-1], "step3_synthesized_dense_caption": "[Ann] leaves.", "key_frame_times": [mid]}],
            "prev_event_revision": None,
        }
        return "```json\n" + json.dumps(out) + "\n```", usage
    if request["stage"] == "alignment":
        assert any(p["kind"] == "image_url" for p in request["parts"])
        known = "cluster_0001" if "cluster_0001" in text else "NEW"
        return json.dumps({"chunk_identity_mapping": [{"temp_name_in_chunk": "[Ann]", "match_result": known, "confidence_score": 70}, {"temp_name_in_chunk": "Ann", "match_result": "NEW", "confidence_score": "high"}]}), usage
    if request["stage"] == "review":
        assert 1 <= sum(p["kind"] == "image_url" for p in request["parts"]) <= 3
        return json.dumps({"reviews": [{"cluster_id": "cluster_0001", "final_global_name": "[Anna]", "refined_visual_description": "tall woman"}]}), None
    if request["stage"] == "chapters":
        first = re.search(r"## Timeline\n(\[[^\]]*\])", text)[1]
        return json.dumps({"video_summary": "A wait.", "chapters": [{"title": "One", "start_time": first, "end_time": "[00:00:40]"}, {"chapter_id": "x", "start_time": "[00:00:40]", "end_time": "[00:02:30]"}]}), usage
    if request["stage"] == "refinement":
        return f" Seen {sum(p['kind'] == 'image_url' for p in request['parts'])} frames. ", usage
    body = json.loads(text)
    body["chapters"][0]["events"][0]["caption"] = "Polished."
    return json.dumps(body), usage


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("batch")
    (d / "in" / "sub").mkdir(parents=True)
    for name in ("long.mp4", "sub/short.MKV", "broken.avi", "fails.mov", "note.txt"):
        (d / "in" / name).write_bytes(b"x")
    cfg = Config(max_frames_per_chunk=7, chunk_duration_sec=60)
    backend = model.CallableBackend(fake_model, retries=2, pause=_no_pause)
    out = run_batch(spark, cfg, str(d / "in"), str(d / "out"), backend, FakeDecoder())
    return cfg, d, out


def _no_pause(seconds):
    return None


def test_runs(spark, batch):
    _, _, out = batch
    assert out["videos"] == 4 and out["completed"] == 2
    runs = {r.path.rsplit("/", 1)[1]: r.status for r in spark.read.parquet(out["root"] + "/runs").collect()}
    assert runs == {"long.mp4": "completed", "short.MKV": "completed", "broken.avi": "unreadable", "fails.mov": "failed"}


def test_storyboards(spark, batch):
    _, _, out = batch
    docs = {r.video_path.rsplit("/", 1)[1]: r for r in spark.read.parquet(out["root"] + "/storyboards").collect()}
    assert docs.keys() == {"long.mp4", "short.MKV"}
    long = docs["long.mp4"]
    assert long.video_summary == "A wait." and [c.chapter_id for c in long.chapters] == ["ch_01", "x"] and long.chapters[1].title == "Chapter 2"
    events = [e for c in long.chapters for e in c.events]
    assert len(events) >= 4 and long.chapters[0].events[0].final_caption == "Polished."
    assert all(re.fullmatch(r"Seen \d+ frames\.", e.frame_caption) and e.frame_timestamps for e in events)
    assert events[0].step3_synthesized_dense_caption == "[Anna] waits." and events[1].step3_synthesized_dense_caption == "[Anna] leaves."
    assert [(c.name, c.desc) for c in events[0].characters_in_event] == [("[Anna]", "tall woman")]
    text = spark.read.text(out["root"] + "/documents").first()[0]
    assert json.loads(text)["video_path"].endswith(("long.mp4", "short.MKV"))


def test_identity_flags_and_usage(spark, batch):
    _, _, out = batch
    flags = spark.read.parquet(out["root"] + "/low_confidence")
    assert flags.count() >= 1 and {r.cluster_id for r in flags.collect()} == {"cluster_0001"}
    errors = spark.read.parquet(out["root"] + "/align/errors")
    assert {r.confidence_score for r in errors.collect()} == {"high"}
    total = spark.read.parquet(out["root"] + "/usage").where("grain = 3").first()
    assert total.total_tokens == 15 * total.calls > 0
    stages = {r.stage for r in spark.read.parquet(out["root"] + "/usage").where("grain = 2").collect()}
    assert stages == {"perception", "alignment", "chapters", "refinement", "polish"}


def test_a_second_run_asks_for_nothing(spark, batch):
    cfg, d, out = batch

    def never(request):
        raise AssertionError("called again")

    again = run_batch(spark, cfg, str(d / "in"), str(d / "out"), model.CallableBackend(never, 1), FakeDecoder())
    assert again == out
    assert spark.read.parquet(out["root"] + "/run_log").count() == 8
    words = spark.read.option("recursiveFileLookup", "true").parquet(out["root"] + "/audit")
    assert words.where("n_media > 0 and stage = 'perception'").count() == words.where("stage = 'perception'").count() > 0


def test_going_on_after_a_break_equals_one_run(spark, batch, tmp_path):
    """The last wave and all that came after it are lost; the rest is kept."""
    import shutil

    cfg, d, out = batch
    root = tmp_path / "out" / cfg.digest()
    shutil.copytree(out["root"], root)
    waves = sorted(int(p.name.split("=")[1]) for p in (root / "relay" / "state").iterdir() if p.name.startswith("wave="))
    shutil.rmtree(root / "relay" / "state" / f"wave={waves[-1]}")
    shutil.rmtree(root / "_marks")
    again = run_batch(spark, cfg, str(d / "in"), str(tmp_path / "out"), model.CallableBackend(fake_model, 2, _no_pause), FakeDecoder())
    read = lambda r: sorted(str(x) for x in spark.read.parquet(r + "/storyboards").collect())
    assert read(again["root"]) == read(out["root"]) != []


def test_a_second_call_perceives_new_and_replaced_videos(spark, tmp_path):
    cfg = Config(max_frames_per_chunk=3)
    backend = model.CallableBackend(fake_model, 1, _no_pause)

    def totals(listing, videos):
        ws = Workspace(spark, str(tmp_path))
        ws.key("video_meta", listing, ())
        ws.key("perception", cfg.digest(), ("video_meta",))
        meta = spark.createDataFrame(videos, "video_id string, path string, duration_sec double")
        waves = relay.perceive(ws, meta, None, FakeDecoder(), backend, cfg)
        state = spark.read.parquet(f"{ws.root}/relay/state/wave={waves}")
        return {r.video_id: (r.total, r.at) for r in state.collect()}, spark.read.parquet(f"{ws.root}/relay/answers").count()

    assert totals("a", [("one", "one.mp4", 30.5)]) == ({"one": (30.0, 30.0)}, 1)
    more = [("one", "one.mp4", 20.0), ("two", "two.mp4", 30.5)]
    assert totals("b", more) == ({"one": (20.0, 20.0), "two": (30.0, 30.0)}, 2)
    assert totals("b", more)[1] == 2


def test_thresholds_of_confidence_reach_the_fold(spark, monkeypatch, tmp_path):
    cols = "video_id string, p int, match_result string, confidence_score double"
    df = spark.createDataFrame([("v", 0, "NEW", None), ("v", 1, "cluster_0001", 85.0), ("v", 2, "cluster_0001", 70.0), ("v", 3, "cluster_0001", 95.0)], cols)
    fold = lambda *a: [(r.cluster_id[-1], r.low_conf) for r in fold_clusters(df, "video_id", "p", *a).orderBy("p").collect()]
    assert fold() == [("1", False), ("1", False), ("1", True), ("1", False)]
    assert fold(75, 90) == [("1", False), ("1", True), ("2", False), ("1", False)]
    seen = []
    monkeypatch.setattr(stages.I, "fold_clusters", lambda *a, **k: seen.append(k) or fold_clusters(*a, **k))
    cand = spark.createDataFrame([("v", 0, 0, "Ann", "tall", "00:00:01")], "video_id string, chunk_i int, cand_i int, temp_name string, descr string, anchor_ts string")
    chunks = spark.createDataFrame([("v", 0, "s")], "video_id string, chunk_i int, chunk_summary string")
    meta = spark.createDataFrame([("v", "v.mp4")], "video_id string, path string")
    cfg = Config(confidence_threshold=90, hard_split_threshold=75)
    stages.align(Workspace(spark, str(tmp_path)), chunks, cand, meta, FakeDecoder(), model.CallableBackend(fake_model, 1, _no_pause), cfg)
    assert [(k["split_below"], k["flag_below"]) for k in seen] == [(75, 90)]


def test_clips_instead_of_frames(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "short.mp4").write_bytes(b"x")
    cfg = Config(input_payload_format="video_base64", review_enable=False)
    out = run_batch(spark, cfg, str(tmp_path / "in" / "short.mp4"), str(tmp_path / "out"), model.CallableBackend(fake_model, 1, _no_pause), FakeDecoder())
    assert out["completed"] == 1
    doc = spark.read.parquet(out["root"] + "/storyboards").first()
    assert doc.chapters[0].events[0].step3_synthesized_dense_caption == "[Ann] waits."


def test_replay_and_retry(spark):
    rows = spark.createDataFrame([("v", "hello"), ("w", "bye")], "video_id string, t string")
    rq = model.requests(rows, "refinement", F.lit("s"), F.array(model.text_part(F.col("t"))), 10, 0.0, "text")
    ids = {r.video_id: r.request_id for r in rq.collect()}
    assert len(set(ids.values())) == 2 and ids == {r.video_id: r.request_id for r in rq.collect()}
    recorded = spark.createDataFrame([(ids["v"], "hi", [(1, 2, 3)])], f"request_id string, answer string, usage {model.USAGE}")
    got = {r.request_id: (r.status, r.answer) for r in model.ReplayBackend(recorded).call(rq).collect()}
    assert got == {ids["v"]: ("ok", "hi"), ids["w"]: ("missing", None)}
    assert [tuple(r) for r in model.usage_rows(rq, model.ReplayBackend(recorded).call(rq)).collect()] == [("v", "refinement", 0, 1, 2, 3)]
    waits, answers = [], ["not json", "```json\n{}\n```"]
    assert model.attempt(lambda r: (answers.pop(0), {"total_tokens": 1}), {"want": "json"}, 3, waits.append)[:3] == ("ok", "{}", None) and waits == [2]
    status, _, error, used = model.attempt(lambda r: (_ for _ in ()).throw(OSError("down")), {"want": "text"}, 3, waits.append)
    assert (status, used) == ("failed", []) and "down" in error and waits == [2, 3, 6]


def test_settings():
    cfg = settings(parser().parse_args(["--input", "a", "--output", "b", "--chunk", "30", "--api-key", "secret", "--payload", "video_base64"]))
    assert cfg.chunk_duration_sec == 30 and "secret" not in json.dumps(cfg.snapshot()) and cfg.digest() != Config().digest()
    assert cfg.digest() == cfg.with_(api_key="other", max_retries=9).digest()


def test_a_failed_call_of_a_later_stage_fails_its_video_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("good.mp4", "sad.mp4"):
        (tmp_path / "in" / name).write_bytes(b"x")

    def sad(request):
        seen = [p["media"] or b"" for p in request["parts"]]
        if request["stage"] == "alignment" and any(b"sad" in m for m in seen):
            return "no json at all", {"total_tokens": 1}
        return fake_model(request)

    cfg = Config(max_frames_per_chunk=3, review_enable=False)
    out = run_batch(spark, cfg, str(tmp_path / "in"), str(tmp_path / "out"), model.CallableBackend(sad, 2, _no_pause), FakeDecoder())
    runs = {r.path.rsplit("/", 1)[1]: (r.status, r.error) for r in spark.read.parquet(out["root"] + "/runs").collect()}
    assert runs["good.mp4"] == ("completed", None) and runs["sad.mp4"][0] == "failed" and runs["sad.mp4"][1].startswith("alignment: JSONDecodeError")
    assert [r.video_path.rsplit("/", 1)[1] for r in spark.read.parquet(out["root"] + "/storyboards").collect()] == ["good.mp4"]
    calls = spark.read.parquet(out["root"] + "/calls")
    bad = calls.where("status = 'failed'").first()
    assert (bad.stage, bad.attempts) == ("alignment", 2) and bad.seconds >= 0
    assert spark.read.parquet(out["root"] + "/align/answers").where("status = 'failed'").first().answer == "no json at all"
    assert {r.stage for r in calls.join(spark.read.parquet(out["root"] + "/runs").where("status = 'failed'"), "video_id").collect()} == {"perception", "alignment"}
    numbers = json.loads(spark.read.text(out["root"] + "/summary.json", wholetext=True).first()[0])
    assert all(r.run_dir.endswith(f"out/{r.path.rsplit(chr(47), 1)[1][:-4]}/model__chk60s__image_list__mf3__sc27_0__fw960__ovlp0") for r in spark.read.parquet(out["root"] + "/runs").collect())
    assert numbers["status"] == {"completed": 1, "failed": 1} and numbers["seconds"] > 0 and numbers["tokens"]["total_tokens"] > 0


def test_alignment_goes_on_after_the_last_whole_round(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def note(request):
        (asked / request["request_id"]).write_bytes(b"x")
        return fake_model(request)

    cand = spark.createDataFrame([("v", i, j, n, "tall", f"00:00:0{i}") for i in range(4) for j, n in enumerate(("Ann", "Bob"))], "video_id string, chunk_i int, cand_i int, temp_name string, descr string, anchor_ts string")
    chunks = spark.createDataFrame([("v", i, f"part {i}") for i in range(4)], "video_id string, chunk_i int, chunk_summary string")
    meta = spark.createDataFrame([("v", "v.mp4")], "video_id string, path string")

    def once(inputs):
        ws = Workspace(spark, str(tmp_path / "ws"))
        ws.key("people", inputs, ())
        sightings, flags = stages.align(ws, chunks, cand, meta, FakeDecoder(), model.CallableBackend(note, 1, _no_pause), Config())
        n = len(list(asked.iterdir()))
        for f in asked.iterdir():
            f.unlink()
        return ws, n, sorted(tuple(r) for r in sightings.collect()), sorted(tuple(r) for r in flags.collect())

    ws, n, sightings, flags = once("a")
    assert n == 4 and {s[-1] for s in sightings} == {"cluster_0001"} and len(sightings) == 4 and len(flags) == 3
    ws.remove(f"{ws.root}/align/bank/round=3")
    assert once("a")[1:] == (1, sightings, flags)
    assert once("a")[1:] == (0, sightings, flags)
    assert once("b")[1:] == (4, sightings, flags)
