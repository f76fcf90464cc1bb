"""Normalisers of landmark frames (wide: one struct<x, y> column a landmark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinseq.functions.geometry import distance
from kinseq.operators.sequence import carry_forward


def point(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def body_normalise(df: DataFrame, keys: list[str], order: str, landmarks: list[str], anchor: str = "box", neck_source: str = "zero") -> DataFrame:
    """MTH3-6, WIN2: scale the body landmarks of each frame by its box or its anchor.

    ``neck_source``: ``zero`` takes the neck as it is observed, always (0, 0), so that the neck
    anchor leaves frames alone; ``column`` uses the frame's neck; ``mid_shoulder`` derives it.
    A frame without scale or anchor takes the last frame's; before the first one it stays.  A box
    is clamped at 0 after its end is computed, and it is the clamped box that is carried on.
    """
    if anchor not in ("box", "neck", "nose"):
        raise ValueError(f"unknown anchor {anchor}")
    left, right, nose, eye = (F.col(c) for c in ("leftShoulder", "rightShoulder", "nose", "leftEye"))
    if neck_source == "zero":
        df = df.withColumn("neck", point(F.lit(0), F.lit(0)))
    elif neck_source == "mid_shoulder":
        df = df.withColumn("neck", F.when((left.x != 0) & (right.x != 0), point((left.x + right.x) / 2, (left.y + right.y) / 2)).otherwise(point(F.lit(0), F.lit(0))))
    neck = F.col("neck")
    shoulders, head = (left.x != 0) & (right.x != 0), (neck.x != 0) & (nose.x != 0)
    h = F.when(shoulders, distance(left.x, left.y, right.x, right.y)).otherwise(distance(neck.x, neck.y, nose.x, nose.y))
    usable = shoulders | head
    if anchor != "box":
        usable = usable & (F.col(anchor)["x"] != 0)
    low = lambda v: F.greatest(v, F.lit(0.0))
    if anchor == "box":
        top = eye.y + h
        frame = F.struct(low(neck.x - 3 * h).alias("sx"), low(top).alias("sy"), low(neck.x + 3 * h).alias("ex"), low(top - 6 * h).alias("ey"))
    else:
        frame = F.struct(F.col(anchor)["x"].alias("ax"), F.col(anchor)["y"].alias("ay"), h.alias("h"))
    df = carry_forward(df, keys, order, {"_frame": F.when(usable, frame)})
    f = F.col("_frame")
    if anchor == "box":
        fits = f.isNotNull() & (f.ex - f.sx != 0) & (f.sy - f.ey != 0)
        new = lambda p: point((p.x - f.sx) / (f.ex - f.sx), (p.y - f.ey) / (f.sy - f.ey))
    else:
        fits = f.isNotNull() & (f.h != 0)
        new = lambda p: point((p.x - f.ax) / f.h, (p.y - f.ay) / f.h)
    return df.withColumns({c: F.when(fits & (F.col(c)["x"] != 0), new(F.col(c))).otherwise(F.col(c)) for c in landmarks}).drop("_frame")


def hand_normalise(df: DataFrame, wrist: str, points: list[str]) -> DataFrame:
    """MTH7: shift points by the wrist, if both were seen (x not 0)."""
    w = F.col(wrist)
    moved = {c: F.when((w.x != 0) & (F.col(c)["x"] != 0), point(F.col(c)["x"] - w.x, F.col(c)["y"] - w.y)).otherwise(F.col(c)) for c in points}
    return df.withColumns(moved)


def shift_half(df: DataFrame, coords: list[str]) -> DataFrame:
    """MTH8"""
    return df.withColumns({c: F.col(c) - 0.5 for c in coords})


def root_centre(df: DataFrame, clip: str, joint: str, coords: list[str], root: int = 0, root_only: bool = False) -> DataFrame:
    """MTH9, AGG10: subtract the root joint's mean over the clip's frames, from all joints or from the root."""
    w = Window.partitionBy(clip)
    mean = {c: F.avg(F.when(F.col(joint) == root, F.col(c))).over(w) for c in coords}
    return df.withColumns({c: F.when((F.col(joint) == root) | F.lit(not root_only), F.col(c) - m).otherwise(F.col(c)) for c, m in mean.items()})


def standardise(df: DataFrame, keys: list[str], coords: list[str]) -> DataFrame:
    """AGG11: z-scores by population deviation; constant coordinates become 0."""
    w = Window.partitionBy(*keys)
    return df.withColumns({c: F.coalesce((F.col(c) - F.avg(c).over(w)) / F.nullif(F.stddev_pop(c).over(w), F.lit(0.0)), F.lit(0.0)) for c in coords})
