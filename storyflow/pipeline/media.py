"""Frames and clips from videos, through a pluggable decoder.

A decoder opens a video once for a batch of times. The OpenCV decoder is used
where that library is installed; anything with the same three methods will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timecode import parse_seconds


class Decoder(Protocol):
    def probe(self, path: str) -> dict | None:
        """fps, frame_count, width and height; None if it cannot be opened."""

    def frames(self, path: str, times: list[float], max_width: int, quality: int) -> list[tuple[float, bytes]]:
        """(time, JPEG) of the times that could be read."""

    def clip(self, path: str, start: float, end: float, max_width: int, fps: float) -> tuple[list[float], bytes]:
        """(times of the frames kept, MP4): every n-th frame of the inclusive range."""

    def scenes(self, path: str, threshold: float) -> list[tuple[float, float]]:
        """(start, end) in seconds."""


class OpenCvDecoder:
    """Decoding by cv2 and scenedetect, imported where the work is done."""

    def probe(self, path: str) -> dict | None:
        import cv2

        v = cv2.VideoCapture(path)
        try:
            if not v.isOpened():
                return None
            return {"fps": v.get(cv2.CAP_PROP_FPS), "frame_count": int(v.get(cv2.CAP_PROP_FRAME_COUNT)), "width": int(v.get(cv2.CAP_PROP_FRAME_WIDTH)), "height": int(v.get(cv2.CAP_PROP_FRAME_HEIGHT))}
        finally:
            v.release()

    def frames(self, path: str, times: list[float], max_width: int, quality: int) -> list[tuple[float, bytes]]:
        import cv2

        v = cv2.VideoCapture(path)
        try:
            fps, w, h = v.get(cv2.CAP_PROP_FPS), v.get(cv2.CAP_PROP_FRAME_WIDTH), v.get(cv2.CAP_PROP_FRAME_HEIGHT)
            scale = min(1.0, max_width / w) if max_width and max_width > 0 and w else 1.0
            out = []
            for t in times:
                v.set(cv2.CAP_PROP_POS_FRAMES, int(t * fps))
                ok, image = v.read()
                if ok:
                    small = cv2.resize(image, (int(w * scale), int(h * scale)), interpolation=cv2.INTER_AREA)
                    out.append((t, cv2.imencode(".jpg", small, [int(cv2.IMWRITE_JPEG_QUALITY), quality])[1].tobytes()))
            return out
        finally:
            v.release()

    def clip(self, path: str, start: float, end: float, max_width: int, fps: float) -> tuple[list[float], bytes]:
        import os
        import tempfile

        import cv2

        v = cv2.VideoCapture(path)
        rate, w, h = v.get(cv2.CAP_PROP_FPS), v.get(cv2.CAP_PROP_FRAME_WIDTH), v.get(cv2.CAP_PROP_FRAME_HEIGHT)
        scale = min(1.0, max_width / w) if max_width and max_width > 0 and w else 1.0
        size, first, last = (int(w * scale), int(h * scale)), int(start * rate), int(end * rate)
        step, times = max(1, round(rate / fps)), []
        handle, name = tempfile.mkstemp(suffix=".mp4")  # the encoder's own scratch file, gone before the task ends
        os.close(handle)
        out = cv2.VideoWriter(name, cv2.VideoWriter_fourcc(*"mp4v"), fps, size)
        try:
            v.set(cv2.CAP_PROP_POS_FRAMES, first)
            for i in range(first, last + 1):
                ok, image = v.read()
                if not ok:
                    break
                if (i - first) % step == 0:
                    out.write(cv2.resize(image, size, interpolation=cv2.INTER_AREA))
                    times.append(i / rate)
            out.release()
            with open(name, "rb") as f:
                return times, f.read()
        finally:
            v.release()
            os.remove(name)

    def scenes(self, path: str, threshold: float) -> list[tuple[float, float]]:
        from scenedetect import ContentDetector, detect

        return [(a.get_seconds(), b.get_seconds()) for a, b in detect(path, ContentDetector(threshold=threshold))]


def probe(videos: DataFrame, decoder: Decoder) -> DataFrame:
    """(video_id, fps, frame_count, width, height, duration_sec); a video that
    cannot be opened has nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [decoder.probe(p) or {} for p in b.column(1).to_pylist()]
            dur = [g["frame_count"] / g["fps"] if g.get("fps") else None for g in got]
            cols = [pa.array([g.get(k) for g in got], t) for k, t in (("fps", pa.float64()), ("frame_count", pa.int64()), ("width", pa.int32()), ("height", pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols, pa.array(dur, pa.float64())], names=["video_id", "fps", "frame_count", "width", "height", "duration_sec"])

    return videos.select("video_id", "path").mapInArrow(run, "video_id string, fps double, frame_count bigint, width int, height int, duration_sec double")


def scenes(videos: DataFrame, decoder: Decoder, threshold: float) -> DataFrame:
    """(video_id, scene_idx, start_sec, end_sec), once for each video."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(v, i, s, e) for v, p in zip(*(c.to_pylist() for c in b.columns)) for i, (s, e) in enumerate(decoder.scenes(p, threshold))]
            cols = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["video_id", "scene_idx", "start_sec", "end_sec"])

    return videos.select("video_id", "path").mapInArrow(run, "video_id string, scene_idx int, start_sec double, end_sec double")


def grab(wanted: DataFrame, decoder: Decoder, key: str, max_width: int, quality: int) -> DataFrame:
    """(key, ord, ts, jpeg) for rows (key, path, times): frames that could not be
    read are left out together with their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, p, times in zip(*(c.to_pylist() for c in b.columns)):
                got = decoder.frames(p, times or [], max_width, quality)
                if got:
                    ts, jpg = zip(*got)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(ts), pa.string()), pa.array(range(len(ts)), pa.int32()), pa.array(ts, pa.float64()), pa.array(jpg, pa.binary())], names=[key, "ord", "ts", "jpeg"])

    return wanted.select(F.col(key).cast("string").alias(key), "path", "times").mapInArrow(run, f"{key} string, ord int, ts double, jpeg binary")


def clips(wanted: DataFrame, decoder: Decoder, max_width: int, fps: float) -> DataFrame:
    """(video_id, times, mp4) for rows (video_id, path, chunk_start, chunk_end);
    stretches of which nothing could be read are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for v, p, s, e in zip(*(c.to_pylist() for c in b.columns)):
                times, mp4 = decoder.clip(p, s, e, max_width, fps)
                if times and mp4:
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()), pa.array([times], pa.list_(pa.float64())), pa.array([mp4], pa.binary())], names=["video_id", "times", "mp4"])

    return wanted.select("video_id", "path", "chunk_start", "chunk_end").mapInArrow(run, "video_id string, times array<double>, mp4 binary")


def anchored(rows: DataFrame, videos: DataFrame, decoder: Decoder, max_width: int, quality: int) -> DataFrame:
    """(item, shots): the frames of each item at the anchor times of ``rows``
    (video_id, item, ord, anchor_ts); an item without a readable frame has none."""
    at = rows.join(videos.select("video_id", "path"), "video_id").groupBy("item", "path").agg(F.array_sort(F.collect_list(F.struct("ord", parse_seconds(F.col("anchor_ts")).alias("t")))).alias("ts"))
    got = grab(at.select("item", "path", F.transform("ts", lambda x: x["t"]).alias("times")), decoder, "item", max_width, quality)
    return got.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("ord", "ts", "jpeg"))).alias("shots"))
