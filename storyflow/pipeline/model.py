"""Model calls as a DataFrame transform: requests in, responses out.

A request is a row; its id is a hash of all it contains, so a task that runs
again asks for the same answer. The replay backend joins recorded answers, the
callable and http backends call from the executors. A missing or failed answer
is a row with its status, never an invented text.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,media:binary,detail:string>>"
REQUEST = f"request_id string, stage string, system string, parts {PARTS}, max_tokens int, temperature double, want string"
USAGE = "array<struct<prompt_tokens:bigint,completion_tokens:bigint,total_tokens:bigint>>"
RESPONSE = f"request_id string, status string, answer string, error string, usage {USAGE}, seconds double"


def text_part(c: Column) -> Column:
    return F.struct(F.lit("text").alias("kind"), c.alias("text"), F.lit(None).cast("binary").alias("media"), F.lit(None).cast("string").alias("detail"))


def image_part(c: Column, detail: str = "low") -> Column:
    return F.struct(F.lit("image_url").alias("kind"), F.lit(None).cast("string").alias("text"), c.alias("media"), F.lit(detail).alias("detail"))


def video_part(c: Column) -> Column:
    return F.struct(F.lit("video_url").alias("kind"), F.lit(None).cast("string").alias("text"), c.alias("media"), F.lit(None).cast("string").alias("detail"))


def audit(rows: DataFrame) -> DataFrame:
    """What was asked, without media: (request_id, stage, system, words, n_media)."""
    return rows.select("request_id", "stage", "system", F.concat_ws("\n", F.transform("parts", lambda p: p["text"])).alias("words"), F.size(F.filter("parts", lambda p: p["media"].isNotNull())).alias("n_media"))


def requests(df: DataFrame, stage: str, system: Column, parts: Column, max_tokens: int, temperature: float, want: str = "json") -> DataFrame:
    """Adds the request columns to ``df``; the id covers stage, texts and media."""
    df = df.withColumns(
        {"stage": F.lit(stage), "system": system, "parts": parts.cast(PARTS), "max_tokens": F.lit(max_tokens), "temperature": F.lit(float(temperature)), "want": F.lit(want)}
    )
    media = F.array_join(F.transform("parts", lambda p: F.concat_ws("|", p["kind"], p["text"], F.sha2(p["media"], 256))), "\n")
    return df.withColumn("request_id", F.sha2(F.concat_ws("\n", "stage", "system", media, F.lit(f"{max_tokens} {temperature} {want}")), 256))


def strip_fence(text: str) -> str:
    t = text.strip()
    for fence in ("```json", "```"):
        if t.startswith(fence):
            t = t[len(fence) :]
            break
    return t.removesuffix("```").strip()


def attempt(ask: Callable[[dict], tuple[str, dict | None]], request: dict, retries: int, pause: Callable[[float], None] = time.sleep) -> tuple[str, str | None, str | None, list[dict]]:
    """(status, answer, error, usage of every attempt that reported any). The
    answer of a failed request is the last one that could not be read. A broken
    JSON answer is asked for again after 2, 4, ... seconds, any other
    failure after 3, 6, ...; usage counts before the answer is read."""
    used: list[dict] = []
    error = raw = None
    for n in range(1, retries + 1):
        step = 3
        try:
            raw, usage = ask(request)
            if usage:
                used.append({k: int(usage.get(k) or 0) for k in ("prompt_tokens", "completion_tokens", "total_tokens")})
            if request["want"] != "json":
                return "ok", (raw or "").strip(), None, used
            step = 2
            cleaned = strip_fence(raw or "")
            json.loads(cleaned)
            return "ok", cleaned, None, used
        except Exception as e:  # noqa: BLE001 - any failure of a call is tried again
            error = f"{type(e).__name__}: {e}"
            if n < retries:
                pause(step * n)
    return "failed", raw, error, used


class CallableBackend:
    """Calls ``ask(request) -> (answer, usage)`` from the executors."""

    def __init__(self, ask: Callable[[dict], tuple[str, dict | None]], retries: int = 3, pause: Callable[[float], None] = time.sleep):
        self.ask, self.retries, self.pause = ask, retries, pause

    def call(self, rows: DataFrame) -> DataFrame:
        ask, retries, pause = self.ask, self.retries, self.pause

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got, took = [], []
                for r in b.to_pylist():
                    began = time.monotonic()
                    got.append(attempt(ask, r, retries, pause))
                    took.append(time.monotonic() - began)
                usage = pa.array([g[3] for g in got], pa.list_(pa.struct([(k, pa.int64()) for k in ("prompt_tokens", "completion_tokens", "total_tokens")])))
                texts = [pa.array([g[i] for g in got], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays([b.column(0), *texts, usage, pa.array(took, pa.float64())], names=["request_id", "status", "answer", "error", "usage", "seconds"])

        names = [f.split()[0] for f in REQUEST.split(", ")]
        return rows.select(*names).dropDuplicates(["request_id"]).mapInArrow(run, RESPONSE)


class HttpBackend(CallableBackend):
    """An OpenAI-compatible chat endpoint, with verified TLS."""

    def __init__(self, base_url: str, api_key: str, model: str, timeout: float = 600.0, retries: int = 3):
        def ask(request: dict) -> tuple[str, dict | None]:
            import base64

            content = []
            for p in request["parts"]:
                if p["kind"] == "text":
                    content.append({"type": "text", "text": p["text"]})
                else:
                    mime = "image/jpeg" if p["kind"] == "image_url" else "video/mp4"
                    link = {"url": f"data:{mime};base64,{base64.b64encode(p['media']).decode()}"}
                    content.append({"type": p["kind"], p["kind"]: link | ({"detail": p["detail"]} if p["detail"] else {})})
            body = {
                "model": model, "max_tokens": request["max_tokens"], "temperature": request["temperature"],
                "messages": [{"role": "system", "content": request["system"]}, {"role": "user", "content": content}],
            }
            call = urllib.request.Request(f"{base_url.rstrip('/')}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {api_key}"})
            with urllib.request.urlopen(call, timeout=timeout) as r:
                out = json.load(r)
            return out["choices"][0]["message"]["content"] or "", out.get("usage")

        super().__init__(ask, retries)


class ReplayBackend:
    """Answers from a recorded table (request_id, answer, usage columns)."""

    def __init__(self, recorded: DataFrame):
        self.recorded = recorded

    def call(self, rows: DataFrame) -> DataFrame:
        r = self.recorded.select("request_id", "answer", "usage")
        out = rows.select("request_id").distinct().join(r, "request_id", "left")
        missing = F.col("answer").isNull()
        return out.select(
            "request_id", F.when(missing, "missing").otherwise("ok").alias("status"), "answer", F.when(missing, "no recorded answer").alias("error"),
            F.coalesce("usage", F.array().cast(USAGE)).alias("usage"), F.lit(0.0).alias("seconds"),
        )


def usage_rows(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """(video_id, stage, attempt, counts): one row for each attempt that
    reported usage."""
    j = asked.select("video_id", "stage", "request_id").join(answers, "request_id")
    u = j.select("video_id", "stage", F.posexplode("usage").alias("attempt", "u"))
    return u.select("video_id", "stage", "attempt", "u.prompt_tokens", "u.completion_tokens", "u.total_tokens")
