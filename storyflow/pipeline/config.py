"""Settings of a batch."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, replace

from ..sources.videos import EXTENSIONS


@dataclass(frozen=True)
class Config:
    """All settings with the values a batch has unless told otherwise. The key
    of the model service is never part of a snapshot or hash."""

    # The defaults a user knows.
    model_name: str = "model"
    base_url: str = ""
    api_key: str = ""
    llm_timeout: float = 600.0
    max_retries: int = 3
    chunk_duration_sec: int = 60
    input_payload_format: str = "image_list"
    frame_extraction_strategy: str = "scenedetect"
    max_frames_per_chunk: int = 240
    scene_detect_threshold: float = 27.0
    target_fps: float = 1.0
    frame_max_width: int = 960
    frame_jpg_quality: int = 90
    llm_temperature: float = 0.2
    llm_max_tokens: int = 16384
    prev_event_overlap_count: int = 0
    align_temperature: float = 0.1
    align_max_tokens: int = 16384
    confidence_threshold: int = 80
    hard_split_threshold: int = 50
    review_enable: bool = True
    review_frame_max_width: int = 0
    review_jpg_quality: int = 92
    review_max_frames_per_cluster: int = 3
    review_temperature: float = 0.1
    review_max_tokens: int = 8192
    review_batch_size: int = 0
    chapter_temperature: float = 0.3
    chapter_max_tokens: int = 16384
    refine_fps: float = 1.0
    refine_max_frames: int = 100
    refine_temperature: float = 0.2
    refine_max_tokens: int = 8192
    refine_start_offset: float = 0.5
    refine_frame_max_width: int = 960
    refine_jpg_quality: int = 90
    polish_temperature: float = 0.4
    polish_max_tokens: int = 16384
    strict_failure: bool = True
    video_extensions: tuple[str, ...] = EXTENSIONS

    def snapshot(self) -> dict:
        """The settings without secrets."""
        return {k: v for k, v in asdict(self).items() if k != "api_key"}

    def digest(self) -> str:
        """A hash of every setting that can change a result."""
        own = {k: v for k, v in self.snapshot().items() if k not in ("llm_timeout", "max_retries", "base_url")}
        return hashlib.sha256(json.dumps(own, sort_keys=True).encode()).hexdigest()[:16]

    def with_(self, **changes) -> Config:
        return replace(self, **{k: v for k, v in changes.items() if v is not None})
