"""Clip metadata: vocabulary, splits, sampling, paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinseq.functions.names import BY_CAMERA, SHARED_SIGNERS, TEST_SIGNERS, VAL_SIGNERS


def select_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """PRJ1: the named columns that exist."""
    return df.select([c for c in columns if c in df.columns])


def camera_id(cam: Column) -> Column:
    """PRJ2: the last character."""
    return F.right(cam, F.lit(1))


def clip_columns(df: DataFrame) -> DataFrame:
    """PRJ2, PRJ3: camera id and the video's and pose file's names."""
    return df.withColumns({"cam_id": camera_id(F.col("cam")), "video": F.concat_ws("/", "cam", F.format_string("%s.mp4", "video_id")), "pose": F.concat_ws("/", "cam", F.format_string("%s.pose", "video_id"))})


def subset_cameras(subset: Column) -> Column:
    """PRJ4: ``name_1_2`` gives cameras 1 and 2."""
    parts = F.split(subset, "_")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def clip_info(df: DataFrame) -> DataFrame:
    """PRJ5: ``width:height``, frame rate to the nearest whole (halves to even), frames."""
    return df.withColumns({"resolution": F.concat_ws(":", "width", "height"), "fps": F.bround("fps", 0).cast("int")})


def needs_normalising(df: DataFrame, resolution: str, fps: int) -> DataFrame:
    """FLT11: clips of another resolution or frame rate."""
    return df.filter((F.col("resolution") != resolution) | (F.col("fps") != fps))


def vocabulary(df: DataFrame, gloss: str = "gloss") -> DataFrame:
    """AGG1, SRT3: (gloss_id, gloss): distinct values in code-point order, numbered from 0.

    The vocabulary is small against the clips, and numbering happens after the distinct."""
    found = df.select(F.col(gloss).alias("gloss")).filter(F.col("gloss").isNotNull()).distinct()
    return found.select((F.row_number().over(Window.orderBy("gloss")) - 1).alias("gloss_id"), "gloss")


def inverse(vocab: DataFrame) -> DataFrame:
    """MAP1: one gloss an id; the last in gloss order wins where an id repeats."""
    return vocab.groupBy("gloss_id").agg(F.max("gloss").alias("gloss"))


def with_gloss_id(df: DataFrame, vocab: DataFrame, gloss: str = "gloss") -> DataFrame:
    """JN1: left join; AQE broadcasts the vocabulary while it is small."""
    return df.join(vocab.select(F.col("gloss").alias(gloss), "gloss_id"), gloss, "left")


def last_of_each(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The last row of each key in file order, as a map built row by row would hold."""
    w = Window.partitionBy(key).orderBy(*[c.desc() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def with_split(df: DataFrame, split_map: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """JN2: left join with the last split given for each key."""
    return df.join(last_of_each(split_map, key, order).select(key, "split"), key, "left")


def named_splits(df: DataFrame) -> DataFrame:
    """FLT1, FLT2: train, val (also ``validation``) and test; rows of other splits go."""
    return df.withColumn("split", F.when(F.col("split") == "validation", "val").otherwise(F.col("split"))).filter(F.col("split").isin("train", "val", "test"))


def sample_rank(df: DataFrame, strata: list[str], row_id: Column, frac: float = 0.5, seed: int = 42) -> DataFrame:
    """AGG3: ``sampled``: half of each stratum (halves to even) by a seeded hash of the row id.

    Rows with a null stratum are never sampled."""
    draw = F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed))))
    ranked = df.withColumn("_draw", draw)
    w = Window.partitionBy(*strata)
    n = F.row_number().over(w.orderBy("_draw", row_id))
    whole = F.lit(True)
    for s in strata:
        whole = whole & F.col(s).isNotNull()
    return ranked.withColumn("sampled", (n <= F.bround(F.lit(frac) * F.count("*").over(w), 0)) & whole).drop("_draw")


def signer_split(df: DataFrame, row_id: Column, seed: int = 42) -> DataFrame:
    """FLT3, FLT4, SET1-3, JN4: split by signer, for some by signer and camera, in one pass.

    Signers shared by val and test are halved by ``sample_rank`` over (gloss, camera); the rest of
    them is test (the complement, so no anti join is needed).  Everyone else trains.
    """
    signer, cam = F.col("signer_id"), F.col("cam_id")
    shared = signer.isin(SHARED_SIGNERS)
    df = sample_rank(df.withColumn("_shared", shared), ["_shared", "gloss_id", "cam_id"], row_id, 0.5, seed)
    split = F.when(signer.isin(VAL_SIGNERS), "val").when(signer.isin(TEST_SIGNERS), "test")
    split = split.when(shared, F.when(F.col("sampled"), "val").otherwise("test"))
    for who, cams in BY_CAMERA.items():
        for camera, name in zip(cams, ("train", "val", "test"), strict=True):
            split = split.when((signer == who) & (cam == camera), name)
        split = split.when(signer == who, F.lit(None))  # a camera the rule does not name
    return df.withColumn("split", split.otherwise("train")).drop("_shared", "sampled")


def complement(df: DataFrame, part: DataFrame, row_id: str) -> DataFrame:
    """JN4, SET3: rows whose id is not in ``part``."""
    return df.join(part.select(row_id), row_id, "left_anti")


def existing(df: DataFrame, listing: DataFrame, path: str = "path") -> DataFrame:
    """FLT5, JN5: rows whose file is listed."""
    return df.join(listing.select(path), path, "left_semi")


def not_yet_written(df: DataFrame, outputs: DataFrame, path: str = "path", overwrite: bool = False) -> DataFrame:
    """SNK11, JN6: rows whose output is not listed; all if outputs may be overwritten."""
    return df if overwrite else df.join(outputs.select(path), path, "left_anti")


def resolve_paths(clips: DataFrame, listing: DataFrame, key: str, candidates: list[Column]) -> DataFrame:
    """SRC10: the first candidate that is listed, else the first candidate."""
    options = F.posexplode(F.array(*candidates)).alias("priority", "path")
    found = clips.select(key, options).join(listing.select("path"), "path", "left_semi")
    best = found.groupBy(key).agg(F.min_by("path", "priority").alias("_found"))
    return clips.join(best, key, "left").withColumn("path", F.coalesce("_found", candidates[0])).drop("_found")


def shuffle_key(row_id: Column, seed: int = 42) -> Column:
    """SRT2: order by this for a seeded shuffle."""
    return F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit("shuffle")))


def debug_take(df: DataFrame, row_id: Column, n: int = 10, by: str = "split", seed: int = 42) -> DataFrame:
    """LIM1: the first rows of each split after the shuffle."""
    w = Window.partitionBy(by).orderBy(shuffle_key(row_id, seed), row_id)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def latest(df: DataFrame, seq: str, n: int = 40, key: str | None = None) -> DataFrame:
    """LIM3: the newest rows, newest first (of each key if given)."""
    if key is None:
        return df.orderBy(F.desc(seq)).limit(n)
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))).filter(F.col("_n") <= n).drop("_n")


def camera_of_path(path: Column, cams: list[str]) -> Column:
    """STR6: the first camera named in a path."""
    return F.coalesce(*[F.when(path.contains(c), c) for c in cams])


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """AGG8, AGG9"""
    return df.groupBy(status).agg(F.count("*").alias("n"))


def first_failures(df: DataFrame, order: str, n: int = 10) -> DataFrame:
    """LIM2: the first failures, each with how many more there are."""
    failed = df.filter(F.col("status") == "failed")
    total = failed.agg(F.greatest(F.count("*") - n, F.lit(0)).alias("more"))
    return failed.orderBy(order).limit(n).crossJoin(F.broadcast(total))
