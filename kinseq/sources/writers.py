"""Sinks.  All write through Spark to a path the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_segments(segments: DataFrame, path: str) -> None:
    """SNK1: index, start and end, with a header."""
    segments.select(F.col("seg_idx").alias("idx"), F.col("start_s").alias("start_time"), F.col("end_s").alias("end_time")).write.mode("overwrite").csv(path, header=True)


def write_packed(clips: DataFrame, path: str, by: str = "cam") -> None:
    """SNK2: tensors in a folder a camera."""
    clips.write.mode("overwrite").partitionBy(by).parquet(path)


def metadata_name(subset: str) -> str:
    """SNK3: what a subset's metadata folder is called."""
    cams = subset.split("_")[1:]
    return f"cam_{cams[0]}" if len(cams) == 1 else subset if subset else "metadata"


def write_metadata(clips: DataFrame, path: str, per_camera: bool = True) -> None:
    """SNK3: JSON lines, a folder a camera or one file."""
    if per_camera:
        clips.write.mode("overwrite").partitionBy("cam").json(path)
    else:
        clips.coalesce(1).write.mode("overwrite").json(path)


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """SNK4"""
    vocab.select("gloss_id", "gloss").write.mode("overwrite").csv(path, header=False)


def write_evaluation(metrics: DataFrame, predictions: DataFrame, path: str) -> None:
    """SNK5: the metrics row as JSON, predictions and references as a table beside it."""
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    predictions.write.mode("overwrite").parquet(f"{path}/predictions")


def write_history(history: DataFrame, path: str) -> None:
    """SNK7, SNK8: times with three decimals, scores with six."""
    three = [F.format_string("%.3f", c).alias(c) for c in ("start_time", "end_time", "inference_time")]
    history.select(*three, "gloss", F.format_string("%.6f", "score").alias("score")).write.mode("overwrite").csv(path, header=True)


def state_json(df: DataFrame) -> DataFrame:
    """SNK10, JSN1: each row as a JSON answer."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
