"""The stages after perception: identities, chapters, refinement, polish."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.timecode import round_millis
from ..operators import chapters as C
from ..operators import identity as I
from ..operators import refine as R
from ..operators import sampling as S
from ..operators import story as Y
from . import media, model, prompts
from .config import Config
from .state import Workspace

_MAPPING = "chunk_identity_mapping array<struct<temp_name_in_chunk:string,match_result:string,confidence_score:string>>"
_REVIEWS = "reviews array<struct<cluster_id:string,final_global_name:string,refined_visual_description:string,chosen_reason:string,preserve_temp_names:array<string>,preserve_reason:string>>"
_CHAPTERS = "video_summary string, chapters array<struct<chapter_id:string,title:string,chapter_summary:string,start_time:string,end_time:string>>"
_POLISHED = "chapters array<struct<chapter_id:string,events:array<struct<event_id:string,caption:string>>>>"
SIGHTING = "video_id string, p int, chunk_i int, temp_name string, descr string, anchor_ts string, cluster_id string"
ENDED = "video_id string, stage string, error string"
#: Stages without a way around a failed call; other failures end a video only if failures are strict.
_NO_WAY_ROUND = ("chapters", "polish")


def _ask(ws: Workspace, name: str, rq: DataFrame, backend) -> DataFrame:
    """Answers of one round, kept as a table before anything is read from them."""
    ws.put(f"audit/{name}", model.audit(rq))
    keep = [c for c in rq.columns if c not in ("parts", "system", "max_tokens", "temperature", "want")]
    return ws.put(name, rq.select(*keep).join(backend.call(rq), "request_id"))


def ended_by(answers: DataFrame, cfg: Config) -> DataFrame:
    """(video_id, stage, error) of each video that a failed call among the
    answers ends, once."""
    bad = answers.where("status <> 'ok'") if cfg.strict_failure else answers.where(F.col("stage").isin(*_NO_WAY_ROUND) & (F.col("status") != "ok"))
    return bad.groupBy("video_id").agg(F.min("stage").alias("stage"), F.min(F.coalesce("error", "status")).alias("error"))


def align(ws: Workspace, chunks: DataFrame, candidates: DataFrame, videos: DataFrame, decoder: media.Decoder, backend, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(sightings, flags): one round for each chunk number, all videos at once.

    A round's requests name the persons known from the rounds before. What one
    round hands to the next is the bank, the first sighting of every name of
    every person, so a round's work follows its own rows and the persons, not the
    rounds before. Chunks without candidates are never asked about; a video a
    failed call has ended is left out of later rounds. A batch that was broken
    off goes on after the last whole round of the same inputs.
    """
    spark = ws.spark
    ws.begin("align", "people")
    one = ws.put("align/candidates", I.first_by_name(candidates, ["video_id", "chunk_i"], ["cand_i"], "temp_name"))
    rounds = [r[0] for r in one.select("chunk_i").distinct().orderBy("chunk_i").collect()]  # chunk numbers, not rows
    bank, ended = spark.createDataFrame([], SIGHTING), spark.createDataFrame([], ENDED)
    for i in rounds:
        if ws.exists(f"{ws.root}/align/bank/round={i}/_SUCCESS"):  # the last table of a round
            bank, ended = ws.table(f"align/bank/round={i}"), ws.table(f"align/ended/round={i}")
            continue
        now = one.where(F.col("chunk_i") == i).join(ended, "video_id", "left_anti")
        cast = Y.joined(now, ["video_id"], ["cand_i"], F.concat(F.lit("- "), "temp_name", F.lit(": "), Y.flat(F.col("descr"))), name="cast")
        names = I.clusters(bank, "video_id").select("video_id", "cluster_id", F.array_join(F.transform("names", lambda n: n["name"]), ", ").alias("names"))
        known = Y.joined(names, ["video_id"], ["cluster_id"], F.concat("cluster_id", F.lit(": "), "names"), name="known")
        row = cast.join(known, "video_id", "left").join(chunks.where(F.col("chunk_i") == i).select("video_id", "chunk_summary"), "video_id", "left")
        words = prompts.filled(("This stretch", F.col("chunk_summary")), ("Known persons", F.col("known")), ("Persons here", F.col("cast")))
        # One picture for each known person, of its first sighting, then one for each person here.
        old = bank.groupBy("video_id", "cluster_id").agg(F.min_by("anchor_ts", "p").alias("anchor_ts"))
        who = old.select("video_id", F.col("cluster_id").alias("name"), "anchor_ts", F.lit(0).alias("kind")).unionByName(now.select("video_id", F.col("temp_name").alias("name"), "anchor_ts", F.lit(1).alias("kind")))
        who = who.join(now.select("video_id").distinct(), "video_id", "left_semi").withColumns({"item": F.concat_ws("|", "video_id", "kind", "name"), "ord": F.lit(0)}).where("coalesce(anchor_ts, '') <> ''")
        shots = media.anchored(who, videos, decoder, cfg.frame_max_width, cfg.frame_jpg_quality)
        pics = who.join(shots, "item").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("kind", "name", F.element_at("shots", 1)["jpeg"].alias("jpeg")))).alias("pics"))
        row = row.join(pics, "video_id", "left").withColumn("chunk_i", F.lit(i))
        shown = F.flatten(F.transform(F.coalesce("pics", F.array()), lambda x: F.array(model.text_part(x["name"]), model.image_part(x["jpeg"]))))
        rq = model.requests(row, "alignment", F.lit(prompts.ALIGN), F.concat(shown, F.array(model.text_part(words))), cfg.align_max_tokens, cfg.align_temperature).drop("pics")
        answers = _ask(ws, f"align/answers/round={i}", rq, backend)
        m = answers.where("status = 'ok'").select("video_id", "chunk_i", F.posexplode(F.from_json("answer", _MAPPING)["chunk_identity_mapping"]).alias("j", "m"))
        m = m.select("video_id", "chunk_i", "j", "m.*").withColumn("match_result", F.trim(F.coalesce("match_result", F.lit(""))))
        # A confidence that is no number makes its row an error, a missing one counts as sure.
        wrong = F.col("confidence_score").isNotNull() & F.col("confidence_score").try_cast("double").isNull()
        ws.put(f"align/errors/round={i}", m.where(wrong))
        m = m.where(~wrong).withColumn("confidence_score", F.col("confidence_score").try_cast("double"))
        kept = I.dedup_mappings(m, now, ["video_id", "chunk_i"], ["j"]).select("video_id", "chunk_i", "j", "norm", "temp_name", "match_result", "confidence_score")
        made = bank.groupBy("video_id").agg(F.max(F.substring_index("cluster_id", "_", -1).cast("bigint")).alias("made"))
        own = kept.withColumn("p", (F.col("chunk_i") * 100_000 + F.col("j")).cast("int")).join(made, "video_id", "left")
        own = ws.put(f"align/decisions/round={i}", own)
        fold = I.fold_clusters(own, "video_id", split_below=cfg.hard_split_threshold, flag_below=cfg.confidence_threshold, made_before="made")
        info = own.join(fold, ["video_id", "p"]).join(now.select("video_id", "norm", "descr", "anchor_ts"), ["video_id", "norm"])
        new = ws.put(f"align/state/round={i}", info).select(*bank.columns)
        ended = ws.put(f"align/ended/round={i}", ended.unionByName(ended_by(answers, cfg)))
        bank = ws.put(f"align/bank/round={i}", I.first_by_name(bank.unionByName(new), ["video_id", "cluster_id"], ["p"], "temp_name").select(*bank.columns))
    if not rounds:
        return bank, spark.createDataFrame([], "video_id string, chunk_i int, temp_name string, cluster_id string, confidence_score double")
    info = ws.table("align/state")
    sightings = info.select("video_id", "p", "chunk_i", "temp_name", "descr", "anchor_ts", "cluster_id")
    return sightings, info.where("low_conf").select("video_id", "chunk_i", "temp_name", "cluster_id", "confidence_score")


def review(ws: Workspace, sightings: DataFrame, videos: DataFrame, decoder: media.Decoder, backend, cfg: Config) -> DataFrame:
    """Final names: (video_id, cluster_id, n, final_name, final_desc, preserved, status)."""
    from pyspark.sql import Window as W

    bank = ws.put("review/bank", I.clusters(sightings, "video_id"))
    empty = ws.spark.createDataFrame([], "video_id string, cluster_id string, final_global_name string, refined_visual_description string, preserve_temp_names array<string>")
    if not cfg.review_enable:
        out = I.review(bank, empty, "video_id")
        return out.withColumns({"preserved": F.array().cast("array<string>"), "status": F.lit("off")})
    size = cfg.review_batch_size if cfg.review_batch_size > 0 else 1 << 30
    n = F.row_number().over(W.partitionBy("video_id").orderBy("cluster_id"))
    b = bank.withColumn("batch", F.floor((n - 1) / size).cast("int"))
    lines = Y.joined(b, ["video_id", "batch"], ["cluster_id"], F.concat("cluster_id", F.lit(": "), F.array_join(F.transform("names", lambda x: x["name"]), ", "), F.lit("; "), Y.flat(F.col("first_desc"))), name="persons")
    # A few sightings of each person, spread evenly over its first and last.
    placed = sightings.withColumns({"ord": F.row_number().over(W.partitionBy("video_id", "cluster_id").orderBy("p")) - 1, "n": F.count(F.lit(1)).over(W.partitionBy("video_id", "cluster_id"))})
    some = placed.where(F.array_contains(S.even_sample(F.col("n").cast("int"), cfg.review_max_frames_per_cluster), F.col("ord")) & (F.coalesce("anchor_ts", F.lit("")) != ""))
    some = some.withColumn("item", F.concat_ws("|", "video_id", "cluster_id"))
    shots = media.anchored(some, videos, decoder, cfg.review_frame_max_width, cfg.review_jpg_quality)
    pics = b.withColumn("item", F.concat_ws("|", "video_id", "cluster_id")).join(shots, "item").groupBy("video_id", "batch").agg(F.array_sort(F.collect_list(F.struct("cluster_id", "shots"))).alias("pics"))
    shown = F.flatten(F.transform(F.coalesce("pics", F.array()), lambda x: F.concat(F.array(model.text_part(x["cluster_id"])), F.transform(x["shots"], lambda s: model.image_part(s["jpeg"], "high")))))
    words = model.text_part(prompts.filled(("Persons", F.col("persons"))))
    rq = model.requests(lines.join(pics, ["video_id", "batch"], "left"), "review", F.lit(prompts.REVIEW), F.concat(shown, F.array(words)), cfg.review_max_tokens, cfg.review_temperature).drop("pics")
    got = _ask(ws, "review/answers", rq, backend).where("status = 'ok'")
    r = got.select("video_id", F.posexplode(F.from_json("answer", _REVIEWS)["reviews"]).alias("j", "r")).where("coalesce(r.cluster_id, '') <> ''")
    last = r.groupBy("video_id", "r.cluster_id").agg(F.max_by("r", "j").alias("r"))
    return I.review(bank, last.select("video_id", "cluster_id", "r.final_global_name", "r.refined_visual_description", "r.preserve_temp_names"), "video_id")


def rewrite_captions(events: DataFrame, sightings: DataFrame, final: DataFrame) -> DataFrame:
    """Events whose captions name persons by their final names."""
    pairs = I.chunk_pairs(sightings, final, ["video_id", "chunk_i"], run="video_id")
    cap = F.col("step3_synthesized_dense_caption")
    return events.join(pairs, ["video_id", "chunk_i"], "left").withColumn("step3_synthesized_dense_caption", X.rewrite(cap, F.col("pattern"), F.col("table"))).drop("pattern", "table")


def chapters(ws: Workspace, chunks: DataFrame, events: DataFrame, final: DataFrame, backend, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(chapter definitions with the video's summary, mounted events)."""
    cast = Y.joined(final, ["video_id"], ["cluster_id"], F.concat(F.lit("- "), "final_name", F.lit(": "), Y.flat(F.col("final_desc"))), name="cast")
    parts = Y.joined(chunks, ["video_id"], ["chunk_i"], F.concat("chunk_time_range", F.lit(": "), Y.flat(F.col("chunk_summary"))), name="parts")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    line = F.concat(blank("start_time"), F.lit(" - "), blank("end_time"), F.lit(" : "), blank("step3_synthesized_dense_caption"))
    told = Y.joined(events, ["video_id"], ["chunk_i", "ev_i"], line, name="timeline")
    row = told.join(cast, "video_id", "left").join(parts, "video_id", "left")
    words = prompts.filled(("Persons", F.col("cast")), ("Stretches", F.col("parts")), ("Timeline", F.col("timeline")))
    rq = model.requests(row.drop("timeline", "cast", "parts").join(row.select("video_id", words.alias("_w")), "video_id"), "chapters", F.lit(prompts.CHAPTERS), F.array(model.text_part(F.col("_w"))), cfg.chapter_max_tokens, cfg.chapter_temperature)
    got = _ask(ws, "chapters/answers", rq.drop("_w"), backend).where("status = 'ok'").withColumn("d", F.from_json("answer", _CHAPTERS))
    c = got.select("video_id", F.coalesce("d.video_summary", F.lit("")).alias("video_summary"), F.posexplode_outer("d.chapters").alias("ch_idx", "c"))
    named = c.where("c is not null").select(
        "video_id", "video_summary", "ch_idx", F.coalesce("c.chapter_id", F.format_string("ch_%02d", F.col("ch_idx") + 1)).alias("chapter_id"),
        F.coalesce("c.title", F.concat(F.lit("Chapter "), (F.col("ch_idx") + 1).cast("string"))).alias("title"), F.coalesce("c.chapter_summary", F.lit("")).alias("chapter_summary"), "c.start_time", "c.end_time",
    )
    lone = C.single_chapter(events, named, "video_id").withColumns({"video_summary": F.lit(""), "title": F.lit("Whole video"), "chapter_summary": F.lit("")})
    defs = ws.put("chapters/defs", named.unionByName(lone.select(*named.columns)))
    mounted = ws.put("chapters/mounted", C.mount(events, defs, "video_id"))
    more = C.overflow(events, defs, mounted, "video_id", lost_only=True)
    return defs, mounted.unionByName(more)


def refine(ws: Workspace, story: DataFrame, videos: DataFrame, decoder: media.Decoder, backend, cfg: Config) -> DataFrame:
    """Adds frame_caption and frame_timestamps to the story's events.

    The caption before stays inside a chapter, so the n-th events of all
    chapters of all videos are one round; a round hands on the last caption of
    each chapter that goes on. Events of no length and events whose frames
    cannot be read are passed over; a video a failed call has ended is left out
    of later rounds. A batch that was broken off goes on after the last whole
    round of the same inputs.
    """
    from pyspark.sql import Window as W

    spark = ws.spark
    ws.begin("refine", "refined")
    adj = R.adjusted_start(story, "video_id", ["ch_idx", "ord"], cfg.refine_start_offset)
    n = S.event_frame_count(F.col("actual_start"), F.col("end_sec"), cfg.refine_fps, cfg.refine_max_frames)
    work = adj.select("video_id", "ch_idx", "ord", "event_id", "step3_synthesized_dense_caption", S.inner_points(F.col("actual_start"), F.col("end_sec"), n).alias("times"))
    work = work.withColumns({"turn": F.row_number().over(W.partitionBy("video_id", "ch_idx").orderBy("ord")), "item": F.concat_ws("|", "video_id", "ch_idx", "ord")})
    work = ws.put("refine/work", work.join(videos.select("video_id", "path"), "video_id"))
    prev, ended = spark.createDataFrame([], "video_id string, ch_idx int, prev string"), spark.createDataFrame([], ENDED)
    turns = work.agg(F.max("turn")).first()[0] or 0
    for t in range(1, turns + 1):
        if ws.exists(f"{ws.root}/refine/prev/turn={t}/_SUCCESS"):  # the last table of a round
            prev, ended = ws.table(f"refine/prev/turn={t}"), ws.table(f"refine/ended/turn={t}")
            continue
        now = work.where(F.col("turn") == t).join(ended, "video_id", "left_anti")
        frames = ws.put(f"refine/frames/turn={t}", media.grab(now, decoder, "item", cfg.refine_frame_max_width, cfg.refine_jpg_quality))
        shots = frames.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("ord", "ts", "jpeg"))).alias("shots"))
        row = now.join(shots, "item").join(prev, ["video_id", "ch_idx"], "left")
        images = F.transform("shots", lambda x: model.image_part(x["jpeg"]))
        words = model.text_part(prompts.filled(("Caption before", F.col("prev")), ("Draft", F.col("step3_synthesized_dense_caption"))))
        row = row.withColumn("frame_timestamps", F.transform("shots", lambda x: round_millis(x["ts"])))
        rq = model.requests(row, "refinement", F.lit(prompts.REFINE), F.concat(images, F.array(words)), cfg.refine_max_tokens, cfg.refine_temperature, want="text").drop("shots", "turn")
        answers = _ask(ws, f"refine/answers/turn={t}", rq, backend)
        own = ws.put(f"refine/told/turn={t}", answers.where("status = 'ok'").select("video_id", "ch_idx", "ord", F.col("answer").alias("frame_caption"), "frame_timestamps"))
        ended = ws.put(f"refine/ended/turn={t}", ended.unionByName(ended_by(answers, cfg)))
        going = work.where(F.col("turn") == t + 1).select("video_id", "ch_idx")
        said = own.select("video_id", "ch_idx", F.col("frame_caption").alias("prev"))
        last = said.unionByName(prev.join(said, ["video_id", "ch_idx"], "left_anti"))
        prev = ws.put(f"refine/prev/turn={t}", last.join(going, ["video_id", "ch_idx"], "left_semi"))
    told = ws.table("refine/told").drop("turn") if turns else spark.createDataFrame([], "video_id string, ch_idx int, ord int, frame_caption string, frame_timestamps array<double>")
    return story.join(told, ["video_id", "ch_idx", "ord"], "left")


def polish(ws: Workspace, refined: DataFrame, defs: DataFrame, backend, cfg: Config) -> DataFrame:
    """Adds final_caption: the polished text, else the refined, else the draft."""
    cap = R.first_filled(F.col("frame_caption"), F.col("step3_synthesized_dense_caption"))
    some = refined.withColumn("caption", cap).where("caption <> ''")
    inner = some.groupBy("video_id", "ch_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "event_id", "caption"))), lambda x: F.struct(x["event_id"].alias("event_id"), x["caption"].alias("caption"))).alias("events"))
    c = inner.join(defs.select("video_id", "ch_idx", "chapter_id", F.col("title").alias("chapter_title")), ["video_id", "ch_idx"])
    body = c.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("ch_idx", "chapter_id", "chapter_title", "events"))).alias("cs"))
    body = body.select("video_id", F.to_json(F.struct(F.transform("cs", lambda x: F.struct(x["chapter_id"].alias("chapter_id"), x["chapter_title"].alias("chapter_title"), x["events"].alias("events"))).alias("chapters"))).alias("payload"))
    rq = model.requests(body, "polish", F.lit(prompts.POLISH), F.array(model.text_part(F.col("payload"))), cfg.polish_max_tokens, cfg.polish_temperature)
    got = _ask(ws, "polish/answers", rq.drop("payload"), backend).where("status = 'ok'")
    flat = got.select("video_id", F.posexplode(F.from_json("answer", _POLISHED)["chapters"]).alias("ci", "c")).select("video_id", "ci", F.posexplode("c.events").alias("ei", "e"))
    p = R.polished_captions(flat.select("video_id", "ci", "ei", F.col("e.event_id").alias("event_id"), F.col("e.caption").alias("caption")).where("coalesce(event_id, '') <> ''"), ["video_id", "event_id"], ["ci", "ei"])
    out = refined.join(p, ["video_id", "event_id"], "left")
    return out.withColumn("final_caption", R.first_filled(F.col("polished"), F.col("frame_caption"), F.col("step3_synthesized_dense_caption"))).drop("polished")


def characters(events: DataFrame, final: DataFrame) -> DataFrame:
    """Adds characters_in_event: the persons a caption mentions, described."""
    bank = final.groupBy("video_id", F.col("final_name").alias("name")).agg(F.max_by("final_desc", "cluster_id").alias("descr"))
    t = events.select("video_id", F.concat_ws("|", "ch_idx", "ord").alias("item"), "step3_synthesized_dense_caption")
    c = C.event_characters(t, bank, "video_id", "item", "step3_synthesized_dense_caption")
    g = c.groupBy("video_id", "item").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "name", "descr"))), lambda x: F.struct(x["name"].alias("name"), x["descr"].alias("desc"))).alias("characters_in_event"))
    return events.withColumn("item", F.concat_ws("|", "ch_idx", "ord")).join(g, ["video_id", "item"], "left").drop("item")


