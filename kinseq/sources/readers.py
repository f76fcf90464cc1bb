"""Sources: metadata, vocabularies, split and segment files, listings, packed tensors, frame streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLIP_META = "video_id string, signer_id string, fps int, resolution int, gloss string, num_frames int, length_seconds double"
LANDMARKS = "clip_id string, frame_idx int, ts_ms double, component string, point string, x double, y double, z double, conf double"


def read_metadata(spark: SparkSession, folder: str, cameras: list[str]) -> DataFrame:
    """SRC1, SET1: one JSON array a camera, declared types; only the asked cameras are read."""
    parts = [spark.read.schema(CLIP_META).option("multiLine", True).json(f"{folder}/{cam}.json").withColumn("cam", F.lit(cam)) for cam in cameras]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: ``id,gloss`` without a header."""
    return spark.read.schema("gloss_id int, gloss string").csv(path, header=False)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: ``video_id,split`` with a header; ids stay strings, whatever they look like."""
    return spark.read.schema("video_id string, split string").csv(path, header=True)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: a cut-time file: index, start and end in seconds."""
    return spark.read.schema("idx int, start_time double, end_time double").csv(path, header=True)


def read_landmarks(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: observations in the engine's own form; filters on component and clip reach the scan."""
    return spark.read.schema(LANDMARKS).parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: packed tensors, which bypass the transforms."""
    return spark.read.parquet(path)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.{mp4,avi,mov,mkv}", newest_last: bool = True) -> DataFrame:
    """SRC7, SRT1: paths in a folder, not below it, sorted; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length")
    return found.orderBy(F.asc("path") if newest_last else F.desc("path"))


def frame_range(frames: DataFrame, fps: float, start_s: float = 0.0, end_s: float | None = None) -> DataFrame:
    """SRC8, FLT6, MTH17: frames of a range of seconds, half-open; the bounds reach the scan."""
    out = frames.filter(F.col("frame_idx") >= round(start_s * fps))
    return out if end_s is None else out.filter(F.col("frame_idx") < round(end_s * fps))


def segment_range(segments: DataFrame, start: int, stop: int) -> DataFrame:
    """FLT7: segments start..stop-1 by index."""
    return segments.filter(F.col("seg_idx").between(start, stop - 1))


def detected(frames: DataFrame, pose: str = "pose") -> DataFrame:
    """FLT9: frames without a detection go."""
    return frames.filter(F.col(pose).isNotNull())


def frame_requests(stream: DataFrame, value: str = "value") -> DataFrame:
    """SRC9, JSN1: pushed frames: JSON with a base64 image, as bytes."""
    body = F.from_json(F.col(value).cast("string"), "image string")
    return stream.select(F.unbase64(F.element_at(F.split(body["image"], ","), -1)).alias("image"))
