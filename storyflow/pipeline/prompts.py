"""Our own templates of what the model is asked, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERCEIVE = (
    "You annotate one stretch of a longer video from frames with their times. Answer with one JSON object with the members chunk_summary, "
    "characters_in_chunk (list of temp_name, visual_description, anchor_timestamp), events (list of start_time, end_time, step1_objective_visual, "
    "step2_contextual_reasoning, step3_synthesized_dense_caption, key_frame_times) and prev_event_revision (null, or need_merge, start_time and the "
    "members to replace in the last event of the stretch before). Use only the times listed; write names in square brackets."
)
ALIGN = (
    "Match the persons of one stretch with the known persons of the video. Answer with one JSON object with the member chunk_identity_mapping, a list of "
    "temp_name_in_chunk, match_result (a cluster id, or NEW) and confidence_score (0 to 100)."
)
REVIEW = (
    "Settle a final name and description for each person. Answer with one JSON object with the member reviews, a list of cluster_id, final_global_name, "
    "refined_visual_description, chosen_reason, preserve_temp_names and preserve_reason."
)
CHAPTERS = (
    "Divide the timeline into chapters of the story. Answer with one JSON object with the members video_summary and chapters, a list of chapter_id, title, "
    "chapter_summary, start_time and end_time; a chapter begins with its first event and ends with its last one, times as written."
)
REFINE = "Describe what the frames show, going on from the caption before and correcting the draft. Answer with the text only."
POLISH = "Polish the captions so that they read as one story; keep ids and facts. Answer with one JSON object of the same shape as the input."


def filled(*pairs: tuple[str, Column | str]) -> Column:
    """Titled paragraphs of a request, one below the other; null reads as '-'."""
    return F.concat_ws("\n\n", *[F.concat(F.lit(f"## {title}\n"), F.coalesce(value if isinstance(value, Column) else F.lit(value), F.lit("-"))) for title, value in pairs])


def perceive(chunk: Column, allowed: Column, before: Column) -> Column:
    return filled(("Stretch", chunk), ("Allowed times", F.array_join(allowed, ", ")), ("What came before", before))
