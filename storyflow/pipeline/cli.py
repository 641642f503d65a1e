"""Command line: ``python -m storyflow.pipeline.cli --input FOLDER --output FOLDER``."""

from __future__ import annotations

import argparse
import json
import os

from .config import Config


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Annotate long videos into storyboards.")
    p.add_argument("--input", required=True, help="a video or a folder of videos")
    p.add_argument("--output", required=True, help="folder of the results, shared by all executors")
    p.add_argument("--workers", type=int, default=None, help="local cores, where no master is set")
    for flag, kind in (("model", str), ("base-url", str), ("chunk", int), ("max-frames", int), ("scene-thresh", float), ("frame-width", int), ("target-fps", float), ("conf-thresh", int)):
        p.add_argument(f"--{flag}", type=kind, default=None)
    p.add_argument("--api-key", default=os.environ.get("STORYFLOW_API_KEY"), help="default: the environment variable STORYFLOW_API_KEY")
    p.add_argument("--payload", choices=["image_list", "video_base64"], default=None)
    return p


def settings(args: argparse.Namespace) -> Config:
    return Config().with_(
        model_name=args.model, base_url=args.base_url, api_key=args.api_key, chunk_duration_sec=args.chunk, input_payload_format=args.payload, max_frames_per_chunk=args.max_frames,
        scene_detect_threshold=args.scene_thresh, frame_max_width=args.frame_width, target_fps=args.target_fps, confidence_threshold=args.conf_thresh,
    )


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from .run import run_batch

    b = SparkSession.builder.appName("storyflow")
    if args.workers:
        b = b.master(f"local[{args.workers}]")
    out = run_batch(b.getOrCreate(), settings(args), args.input, args.output)
    print(json.dumps(out), f"numbers of the batch: {out['root']}/summary.json", sep="\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
