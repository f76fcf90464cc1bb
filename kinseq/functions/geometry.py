"""Column functions for planar geometry, time and formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joint_angle(ax, ay, bx, by, cx, cy) -> Column:
    """MTH1: the angle at b between a and c in degrees, folded to [0, 180]."""
    turn = F.abs(F.degrees(F.atan2(cy - by, cx - bx) - F.atan2(ay - by, ax - bx)))
    return F.when(turn > 180.0, 360.0 - turn).otherwise(turn)


def distance(ax, ay, bx, by) -> Column:
    """MTH2"""
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def rotate(ox, oy, px, py, radians) -> tuple[Column, Column]:
    """MTH13: (px, py) turned about (ox, oy)."""
    c, s = F.cos(radians), F.sin(radians)
    return ox + c * (px - ox) - s * (py - oy), oy + s * (px - ox) + c * (py - oy)


def squeeze(x, y, left, right) -> tuple[Column, Column]:
    """MTH14: both sides cut by a share of the width."""
    return left + (1.0 - left - right) * x, y


def perspective(x, y, move, on_left) -> tuple[Column, Column]:
    """MTH14: one side moved in by ``move`` and its height reduced by it at both corners."""
    k = 1.0 - 2.0 * move
    a, g, d = (1.0 - move) / k, 2.0 * move / k, move / k
    t = F.when(on_left, 1.0 - x).otherwise(x)
    nx, ny = a * t / (g * t + 1.0), (d * t + y) / (g * t + 1.0)
    return F.when(on_left, 1.0 - nx).otherwise(nx), ny


def unless_origin(x, y, new) -> Column:
    """MTH15: points at (0, 0) are missing and stay there."""
    return F.when((x == 0) & (y == 0), 0.0).otherwise(new)


def visible_or_zero(value, visibility, threshold: float = 0.0) -> Column:
    """FLT8: the value of a point seen well enough, else 0; absent points are 0."""
    return F.coalesce(F.when(visibility >= threshold, value).otherwise(0.0), F.lit(0.0))


def frame_truncated(seconds, fps) -> Column:
    """MTH16: towards zero."""
    return (seconds * fps).cast("int")


def frame_rounded(seconds, fps) -> Column:
    """MTH17: halves to even."""
    return F.bround(seconds * fps, 0).cast("int")


def crop(x, y, spec: str = "1080:1080:420:0") -> tuple[Column, Column, Column]:
    """MTH18, STR5: a point in the crop ``w:h:x:y``, and whether it lies inside."""
    w, h, left, top = (int(part) for part in spec.split(":"))
    cx, cy = x - left, y - top
    return cx, cy, (cx >= 0) & (cx < w) & (cy >= 0) & (cy < h)


def fit_scale(width, height, most: float) -> Column:
    """MTH20: the scale that keeps the aspect and neither side above ``most``; never enlarges."""
    return F.least(F.lit(1.0), F.lit(float(most)) / F.greatest(width, height))


def softmax(scores: Column) -> Column:
    """MTH19, AGG15: over an array."""
    e = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def uniform(key: Column, seed: int, tag: str) -> Column:
    """A draw in [0, 1) that depends on the key, the seed and the tag alone (any engine's md5)."""
    hashed = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(tag)))
    return F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") / 4294967296.0


def gaussian(key: Column, seed: int, tag: str) -> Column:
    """RND5: Box-Muller on two such draws."""
    u, v = uniform(key, seed, tag + "u"), uniform(key, seed, tag + "v")
    return F.sqrt(-2.0 * F.log(1.0 - u)) * F.cos(6.283185307179586 * v)


def percent_message(predictions: Column) -> Column:
    """STR1: ``gloss (12.34%), ...`` of an array of (gloss, score)."""
    return F.array_join(F.transform(predictions, lambda p: F.format_string("%s (%.2f%%)", p["gloss"], p["score"] * 100)), ", ")
