"""The annotation pipeline as tables: each stage is a pure DataFrame transform,
recurrences run in waves over all videos at once, and only two things are
plugged in from outside, a media decoder and a model backend."""

from .config import Config
from .run import run_batch

__all__ = ["Config", "run_batch"]
