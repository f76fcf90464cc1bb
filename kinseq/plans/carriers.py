"""Tables of the keypoint domain on the star-schema tables at hand, each with its SQL.

The data hold no poses, so columns that behave alike stand in: per-user events are clips of frames,
their values angles, ``props.k`` a visibility; order lines per supplier are frames with landmarks;
customers are clip metadata; embeddings are logits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinseq.operators.normalise import point


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, frame_idx, t_ms, angle, vis, value, hand, point): 25 frames a second a user."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(
        F.col("user_id").alias("clip_id"), at.alias("frame_idx"), (at * 40.0).alias("t_ms"), (F.col("value") % 180.0).alias("angle"),
        (F.get_json_object("props", "$.k").cast("int") / 100.0).alias("vis"), "value", F.when(F.col("event_id") % 2 == 0, "left").otherwise("right").alias("hand"),
        (F.col("event_id") % 3).cast("int").alias("point"),
    )


FRAMES = """frames AS (
  SELECT clip_id, frame_idx, frame_idx * CAST(40 AS DOUBLE) AS t_ms, value % CAST(180 AS DOUBLE) AS angle,
    CAST(regexp_extract(props, '-?[0-9]+') AS INTEGER) / CAST(100 AS DOUBLE) AS vis, value,
    CASE WHEN event_id % 2 = 0 THEN 'left' ELSE 'right' END AS hand, CAST(event_id % 3 AS INTEGER) AS point
  FROM (SELECT *, user_id AS clip_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame_idx FROM events))"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, point, frame_idx, x, y, conf), some of them missing."""
    gone = F.col("vis") < 0.15
    return frames(spark, sf_dir).select("clip_id", "point", "frame_idx", F.when(gone, 0.0).otherwise(F.col("value")).alias("x"), F.when(gone, 0.0).otherwise(F.col("value") * 7.0 % 100.0).alias("y"), F.col("vis").alias("conf"))


OBSERVATIONS = (
    FRAMES
    + """, obs AS (
  SELECT clip_id, point, frame_idx, CASE WHEN vis < CAST(0.15 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE value END AS x,
    CASE WHEN vis < CAST(0.15 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE value * CAST(7 AS DOUBLE) % CAST(100 AS DOUBLE) END AS y, vis AS conf FROM frames)"""
)


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, frame_idx, landmarks as structs): a supplier's order lines in order."""
    line = read(spark, sf_dir, "lineitem")
    q, d, t = F.col("l_quantity") / 50.0, F.col("l_discount"), F.col("l_tax")
    at = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax")) - 1
    return line.select(
        F.col("l_suppkey").alias("clip_id"), at.alias("frame_idx"), point(d, t).alias("leftShoulder"), point(q, d).alias("rightShoulder"),
        point(t, q).alias("neck"), point(q, t).alias("nose"), point(F.lit(0.5), d).alias("leftEye"), point(d, q).alias("leftElbow"), point(t, d).alias("leftWrist"),
    )


BODIES = """bodies AS (
  SELECT l_suppkey AS clip_id, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS INTEGER) AS frame_idx,
    l_discount AS lsx, l_tax AS lsy, l_quantity / CAST(50 AS DOUBLE) AS rsx, l_discount AS rsy, l_tax AS nex, l_quantity / CAST(50 AS DOUBLE) AS ney,
    l_quantity / CAST(50 AS DOUBLE) AS nox, l_tax AS noy, CAST(0.5 AS DOUBLE) AS lex, l_discount AS ley,
    l_discount AS elx, l_quantity / CAST(50 AS DOUBLE) AS ely, l_tax AS wrx, l_discount AS wry FROM lineitem)"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, row_id, signer_id, cam, cam_id, gloss)"""
    c = read(spark, sf_dir, "customer")
    cam = F.concat(F.lit("cam_"), (F.col("c_custkey") % 3 + 1).cast("string"))
    return c.select(F.col("c_name").alias("video_id"), F.col("c_custkey").alias("row_id"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("signer_id"), cam.alias("cam"), F.right(cam, F.lit(1)).alias("cam_id"), F.col("c_mktsegment").alias("gloss"))


CLIPS = """clips AS (
  SELECT c_name AS video_id, c_custkey AS row_id, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS signer_id,
    'cam_' || (c_custkey % 3 + 1) AS cam, CAST(c_custkey % 3 + 1 AS VARCHAR) AS cam_id, c_mktsegment AS gloss FROM customer),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY gloss) - 1 AS INTEGER) AS gloss_id, gloss FROM (SELECT DISTINCT gloss FROM clips WHERE gloss IS NOT NULL))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip_id, logits, label): ten logits of each embedding."""
    e = read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("clip_id"), F.transform(F.slice("embedding", 1, 10), lambda x: x.cast("double")).alias("logits"), "label")


SCORED = """scored AS (
  SELECT vec_id AS clip_id, CAST(embedding[1:10] AS DOUBLE[]) AS logits, label FROM embeddings),
flat AS (SELECT clip_id, label, generate_subscripts(logits, 1) - 1 AS id, unnest(logits) AS s FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY s DESC, id) AS rn FROM flat)"""
