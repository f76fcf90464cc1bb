"""Ordered-sequence operators over frames of clips.

Every function keeps to one window specification per call, so a chain of them on the same keys needs
one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interpolate(df: DataFrame, keys: list[str], order: str, coords: list[str], conf: str, threshold: float = 0.5) -> DataFrame:
    """WIN1, JN9: linear interpolation of missing points over the frame index.

    A point is missing if its first two coordinates are 0 or its confidence is below the
    threshold (strictly).  Ends take the nearest valid value, all-missing points stay, the
    confidence of what is filled becomes the threshold.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    missing = ((F.col(coords[0]) == 0) & (F.col(coords[1]) == 0)) | (F.col(conf) < threshold)
    good = F.when(~missing, F.struct(F.col(order).cast("double").alias("i"), *[F.col(c) for c in coords]))
    near = df.withColumns({"_missing": missing, "_prev": F.last(good, ignorenulls=True).over(back), "_next": F.first(good, ignorenulls=True).over(ahead)})

    def filled(c: str) -> Column:
        p, n = F.col("_prev"), F.col("_next")
        line = p[c] + (n[c] - p[c]) * (F.col(order) - p["i"]) / (n["i"] - p["i"])
        return F.when(F.col("_missing"), F.coalesce(line, p[c], n[c], F.col(c))).otherwise(F.col(c))

    found = F.col("_prev").isNotNull() | F.col("_next").isNotNull()
    made = {c: filled(c) for c in coords}
    made[conf] = F.when(F.col("_missing") & found, F.lit(threshold)).otherwise(F.col(conf))
    return near.withColumns(made).drop("_missing", "_prev", "_next")


def carry_forward(df: DataFrame, keys: list[str], order: str, values: dict[str, Column]) -> DataFrame:
    """WIN2, WIN4: each named value where it is not null, else the last one before it."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.last(v, ignorenulls=True).over(w) for name, v in values.items()})


def motion(df: DataFrame, keys: list[str], order: str, coords: list[str]) -> DataFrame:
    """WIN3: the next frame less this one; 0 in the last frame."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({c: F.coalesce(F.lead(c).over(w) - F.col(c), F.lit(0.0)) for c in coords})


def pad_array(frames: Column, n: int) -> Column:
    """WIN5: ``n`` frames, out[i] = in[i mod length]; empty input gives null."""
    cyclic = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.element_at(frames, (i % F.size(frames)).cast("int") + 1))
    return F.when(F.size(frames) > 0, cyclic)


def pad_frames(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """WIN5 in long form; frames count from 0 without gaps in each clip."""
    length = Window.partitionBy(*keys)
    counted = df.withColumn("_length", F.max(order).over(length) + 1).filter(F.col(order) < n)
    copies = F.sequence(F.col(order).cast("int"), F.lit(n - 1), F.col("_length").cast("int"))
    return counted.withColumn(order, F.explode(copies)).drop("_length")


def even_sample(length: Column, most: int = 48) -> Column:
    """WIN6: at most ``most`` evenly spaced indices of 0..length-1, truncated; empty if none."""
    n = F.least(length, F.lit(most))
    step = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.floor(i * (length - 1) / F.greatest(n - 1, F.lit(1))).cast("int"))
    return F.when(length > 0, step).otherwise(F.array().cast("array<int>"))


def with_row_index(df: DataFrame, keys: list[str], order: list, name: str = "idx") -> DataFrame:
    """WIN7: 0-based position."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
