"""Queries over the reference operators, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinseq.functions import geometry as g
from kinseq.functions.names import BONES, JOINTS
from kinseq.operators import augment as aug
from kinseq.operators import metadata as md
from kinseq.operators import metrics as mt
from kinseq.operators import normalise as nm
from kinseq.operators import segment as sg
from kinseq.operators import sequence as sq
from kinseq.operators import skeleton as sk
from kinseq.plans import carriers as c

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

THETA, VISIBLE, MIN_UP, MIN_DOWN, DELAY, FPS = 40.0, 0.2, 1, 1, 400.0, 25.0


def query(name: str, sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


# --------------------------------------------------------------------------- segmentation

_RUNS = f"""{c.FRAMES}, cls AS (
  SELECT *, CASE WHEN angle < {THETA} AND vis > CAST({VISIBLE} AS DOUBLE) THEN 'U' WHEN (angle > {THETA} AND vis > CAST({VISIBLE} AS DOUBLE)) OR vis < CAST({VISIBLE} AS DOUBLE) THEN 'D' END AS st FROM frames),
new_ AS (SELECT *, CASE WHEN st = lag(st) OVER (PARTITION BY clip_id ORDER BY frame_idx) THEN 0 ELSE 1 END AS nw FROM cls WHERE st IS NOT NULL),
run_ AS (SELECT *, sum(nw) OVER (PARTITION BY clip_id ORDER BY frame_idx) AS run FROM new_),
place AS (SELECT *, row_number() OVER (PARTITION BY clip_id, run ORDER BY frame_idx) AS n, min(t_ms) OVER (PARTITION BY clip_id, run) AS t0 FROM run_),
cand AS (SELECT * FROM place WHERE n = CASE WHEN st = 'U' THEN {MIN_UP + 1} ELSE {MIN_DOWN + 1} END),
conf AS (SELECT clip_id, frame_idx, st AS kind, CASE WHEN st = 'U' THEN t0 - {DELAY} ELSE t0 + {DELAY} END AS bound
  FROM (SELECT *, lag(st, 1, 'D') OVER (PARTITION BY clip_id ORDER BY frame_idx) AS prev FROM cand) WHERE st <> prev),
pair AS (SELECT *, lead(bound) OVER (PARTITION BY clip_id ORDER BY frame_idx) AS e FROM conf),
seg AS (SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) - 1 AS INTEGER) AS seg_idx, bound / 1000 AS start_s, e / 1000 AS end_s
  FROM pair WHERE kind = 'U' AND e IS NOT NULL)"""


def _confirmed(spark: SparkSession, sf_dir: str, by_hand: bool = False) -> DataFrame:
    f = c.frames(spark, sf_dir).withColumn("st", sg.hand_class(F.col("angle"), F.col("vis"), THETA, VISIBLE))
    return sg.confirmations(f, ["clip_id"] + ["hand"] * by_hand, "frame_idx", "t_ms", "st", MIN_UP, MIN_DOWN, DELAY)


@query("seg1_confirmations", f"WITH {_RUNS} SELECT clip_id, frame_idx, kind, bound FROM conf")
def seg1_confirmations(spark, sf_dir):
    return _confirmed(spark, sf_dir)


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sg.single_hand_segments(_confirmed(spark, sf_dir), ["clip_id"], "frame_idx")


@query("seg1_single_hand", f"WITH {_RUNS} SELECT clip_id, seg_idx, start_s, end_s FROM seg")
def seg1_single_hand(spark, sf_dir):
    return _segments(spark, sf_dir)


@query(
    "seg1_segment_frames",
    f"""WITH {_RUNS} SELECT s.clip_id, s.seg_idx, s.start_s, s.end_s, count(*) AS n_frames, round(sum(f.angle), 2) AS sum_angle
FROM seg s JOIN frames f ON s.clip_id = f.clip_id AND f.frame_idx BETWEEN CAST(trunc(s.start_s * {FPS}) AS INTEGER) AND CAST(trunc(s.end_s * {FPS}) AS INTEGER)
GROUP BY ALL""",
)
def seg1_segment_frames(spark, sf_dir):
    """Flagship: frames -> classes -> confirmations -> segments -> interval join (JN7)."""
    joined = sg.frames_of_segments(c.frames(spark, sf_dir), _segments(spark, sf_dir), "clip_id", FPS)
    return joined.groupBy("clip_id", "seg_idx", "start_s", "end_s").agg(F.count("*").alias("n_frames"), F.round(F.sum("angle"), 2).alias("sum_angle"))


@query("seg4_min_duration", f"WITH {_RUNS} SELECT clip_id, seg_idx, start_s, end_s FROM seg WHERE end_s - start_s >= CAST(0.9 AS DOUBLE)")
def seg4_min_duration(spark, sf_dir):
    return sg.at_least(_segments(spark, sf_dir), 0.9)


@query("flt7_segment_range", f"WITH {_RUNS} SELECT clip_id, seg_idx, start_s, end_s FROM seg WHERE seg_idx BETWEEN 1 AND 2")
def flt7_segment_range(spark, sf_dir):
    from kinseq.sources.readers import segment_range

    return segment_range(_segments(spark, sf_dir), 1, 3)


def _two_hands_sql() -> str:
    """Event by event: a frame's events of both hands, then whether a sign is whole (bounds of 0 read as unset)."""
    runs = _RUNS.replace("PARTITION BY clip_id", "PARTITION BY clip_id, hand").replace("SELECT clip_id, frame_idx, st AS kind", "SELECT clip_id, hand, frame_idx, st AS kind")
    runs = runs[: runs.index(",\npair AS")]
    pick = lambda h, what: f"max({what}) FILTER (WHERE hand = '{h}')"
    bound = lambda h, k, old: f"CASE WHEN e.{h}k = '{k}' THEN nullif(e.{h}b, 0) ELSE p.{old} END AS {old}"
    return f"""WITH RECURSIVE {runs},
ev AS (SELECT clip_id, frame_idx, row_number() OVER (PARTITION BY clip_id ORDER BY frame_idx) AS i, {pick('left', 'kind')} AS lk, {pick('left', 'bound')} AS lb, {pick('right', 'kind')} AS rk, {pick('right', 'bound')} AS rb
  FROM conf GROUP BY clip_id, frame_idx),
f AS (
  SELECT DISTINCT clip_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS DOUBLE) AS ls, CAST(NULL AS DOUBLE) AS le, 'D' AS lu, CAST(NULL AS DOUBLE) AS rs, CAST(NULL AS DOUBLE) AS re, 'D' AS ru, CAST(NULL AS DOUBLE) AS s, CAST(NULL AS DOUBLE) AS t FROM ev
  UNION ALL
  SELECT clip_id, i, ls, le, lu, rs, re, ru,
    CASE WHEN ls IS NOT NULL AND le IS NOT NULL AND rs IS NULL THEN ls WHEN rs IS NOT NULL AND re IS NOT NULL AND ls IS NULL THEN rs WHEN ls IS NOT NULL AND le IS NOT NULL AND rs IS NOT NULL AND re IS NOT NULL AND lu = 'D' AND ru = 'D' THEN least(ls, rs) END AS s,
    CASE WHEN ls IS NOT NULL AND le IS NOT NULL AND rs IS NULL THEN le WHEN rs IS NOT NULL AND re IS NOT NULL AND ls IS NULL THEN re WHEN ls IS NOT NULL AND le IS NOT NULL AND rs IS NOT NULL AND re IS NOT NULL AND lu = 'D' AND ru = 'D' THEN greatest(le, re) END AS t
  FROM (SELECT e.clip_id, e.i, {bound('l', 'U', 'ls')}, {bound('l', 'D', 'le')}, coalesce(e.lk, p.lu) AS lu, {bound('r', 'U', 'rs')}, {bound('r', 'D', 're')}, coalesce(e.rk, p.ru) AS ru
    FROM (SELECT clip_id, i, lu, ru, CASE WHEN s IS NULL THEN ls END AS ls, CASE WHEN s IS NULL THEN le END AS le, CASE WHEN s IS NULL THEN rs END AS rs, CASE WHEN s IS NULL THEN re END AS re FROM f) p
    JOIN ev e ON e.clip_id = p.clip_id AND e.i = p.i + 1))
SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY i) - 1 AS INTEGER) AS seg_idx, s / 1000 AS start_s, t / 1000 AS end_s FROM f WHERE s IS NOT NULL"""


@query("seg1_two_hands", _two_hands_sql())
def seg1_two_hands(spark, sf_dir):
    """Event fold of both hands; also tested against a frame-by-frame automaton."""
    return sg.merge_hands(_confirmed(spark, sf_dir, by_hand=True), ["clip_id"], "frame_idx")


def _live_frames(spark, sf_dir) -> DataFrame:
    f = c.frames(spark, sf_dir)
    return f.select("clip_id", "frame_idx", "t_ms", F.when(F.col("vis") >= 0.1, F.col("angle")).alias("left_angle"), F.when(F.col("vis") < 0.9, F.col("value") * 3.0 % 180.0).alias("right_angle"))


def _live_sql(theta: float = 90, up: int = 1, down: int = 1, delay: float = 100) -> str:
    """Frame by frame, both arms' runs and bounds as columns; a closed sign starts the next frame anew."""
    fresh = {"c": "false", "n": "0", "t": "CAST(0 AS DOUBLE)", "u": "false", "s": "CAST(0 AS DOUBLE)", "e": "CAST(0 AS DOUBLE)"}
    names = [a + k for a in "lr" for k in fresh]
    first = ", ".join(f"{fresh[n[1]]} AS {n}" for n in names)
    again = ", ".join(f"CASE WHEN z0 IS NULL THEN {n} ELSE {fresh[n[1]]} END AS {n}" for n in names)
    one = ", ".join(f"coalesce(f.{a}seen, p.{a}c) AS {a}c, CASE WHEN coalesce(f.{a}seen, p.{a}c) = p.{a}c AND p.{a}n > 0 THEN p.{a}n + 1 ELSE 1 END AS {a}n, CASE WHEN coalesce(f.{a}seen, p.{a}c) = p.{a}c AND p.{a}n > 0 THEN p.{a}t ELSE f.t_ms END AS {a}t, p.{a}u AS {a}v, p.{a}s AS {a}s0, p.{a}e AS {a}e0" for a in "lr")
    two = ", ".join(f"{a}c, {a}n, {a}t, CASE WHEN {a}c AND NOT {a}v AND {a}n = {up + 1} THEN true WHEN NOT {a}c AND {a}v AND {a}n = {down + 1} THEN false ELSE {a}v END AS {a}u, CASE WHEN {a}v THEN {a}s0 WHEN {a}c THEN {a}t - {delay} ELSE 0 END AS {a}s, CASE WHEN NOT {a}v THEN {a}e0 WHEN {a}c THEN 0 ELSE {a}t + {delay} END AS {a}e" for a in "lr")
    whole = {a: f"({a}s > 0 AND {a}e > 0)" for a in "lr"}
    pick = lambda l, r, b: f"CASE WHEN bn = 0 THEN NULL WHEN {whole['l']} AND rs = 0 THEN {l} WHEN {whole['r']} AND ls = 0 THEN {r} WHEN {whole['l']} AND {whole['r']} AND NOT lu AND NOT ru THEN {b} END"  # noqa: E731, E741
    return f"""WITH RECURSIVE {c.FRAMES},
seen AS (SELECT clip_id, frame_idx, t_ms, CASE WHEN vis >= CAST(0.1 AS DOUBLE) THEN angle > 0 AND angle < {theta} END AS lseen,
  CASE WHEN vis < CAST(0.9 AS DOUBLE) THEN value * CAST(3 AS DOUBLE) % CAST(180 AS DOUBLE) > 0 AND value * CAST(3 AS DOUBLE) % CAST(180 AS DOUBLE) < {theta} END AS rseen FROM frames),
fold AS (
  SELECT DISTINCT clip_id, -1 AS i, {first}, 0 AS bn, 0 AS ba, 0 AS bb, CAST(NULL AS DOUBLE) AS z0, CAST(NULL AS DOUBLE) AS z1 FROM seen
  UNION ALL
  SELECT *, {pick('ls', 'rs', 'least(ls, rs)')} AS z0, {pick('le', 're', 'greatest(le, re)')} AS z1 FROM (
    SELECT clip_id, i, {', '.join(names)}, bn0 + CASE WHEN lu OR ru THEN 1 ELSE 0 END AS bn, CASE WHEN bn0 = 0 AND (lu OR ru) THEN i ELSE ba0 END AS ba, CASE WHEN lu OR ru THEN i ELSE bb0 END AS bb FROM (
      SELECT clip_id, i, {two}, bn0, ba0, bb0 FROM (
        SELECT f.clip_id, f.frame_idx AS i, {one}, bn AS bn0, ba AS ba0, bb AS bb0 FROM (
          SELECT clip_id, i, {again}, CASE WHEN z0 IS NULL THEN bn ELSE 0 END AS bn, CASE WHEN z0 IS NULL THEN ba ELSE 0 END AS ba, CASE WHEN z0 IS NULL THEN bb ELSE 0 END AS bb FROM fold) p
        JOIN seen f ON f.clip_id = p.clip_id AND f.frame_idx = p.i + 1))))
"""


_LIVE = _live_sql()
_LIVE_SIGNS = _LIVE + "SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY i) - 1 AS INTEGER) AS seg_idx, z0 / 1000 AS start_s, z1 / 1000 AS end_s, bn AS n_frames, ba AS first_frame, bb AS last_frame FROM fold WHERE z0 IS NOT NULL"


@query("seg2_live", _LIVE_SIGNS)
def seg2_live(spark, sf_dir):
    """The live automaton in batch; also tested against golden traces and the stream."""
    return sg.live_segments(_live_frames(spark, sf_dir), theta=90, min_up=1, min_down=1, delay=100)


@query(
    "seg3_clip_frames",
    _LIVE + """, sign AS (SELECT clip_id, i, row_number() OVER (PARTITION BY clip_id ORDER BY i) - 1 AS seg_idx, lag(i, 1, -1) OVER (PARTITION BY clip_id ORDER BY i) AS after FROM fold WHERE z0 IS NOT NULL)
SELECT fold.clip_id, fold.i AS frame_idx, CAST(seg_idx AS INTEGER) AS seg_idx FROM fold JOIN sign ON fold.clip_id = sign.clip_id AND fold.i > sign.after AND fold.i <= sign.i WHERE lu OR ru""",
)
def seg3_clip_frames(spark, sf_dir):
    """The frames that a live sign buffers."""
    return sg.live_clip_frames(_live_frames(spark, sf_dir), theta=90, min_up=1, min_down=1, delay=100).select("clip_id", "frame_idx", "seg_idx")


@query("seg2_live_stream", _LIVE_SIGNS)
def seg2_live_stream(spark, sf_dir):
    """The same as a stateful stream over the events file, run to its end."""
    import tempfile
    import uuid

    from kinseq.streaming.live import live_stream, run_available

    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="kinseq-")
    root = f"{root.rstrip('/')}/live-{uuid.uuid4().hex[:12]}"
    # frame numbers need each clip in order, so they are given to the frames before they are streamed
    _live_frames(spark, sf_dir).write.parquet(f"{root}/frames")
    stream = spark.readStream.schema(_live_frames(spark, sf_dir).schema).option("maxFilesPerTrigger", 1000).parquet(f"{root}/frames")
    return run_available(live_stream(stream, theta=90, min_up=1, min_down=1, delay=100), f"{root}/out", f"{root}/state")


# --------------------------------------------------------------------------- sequences


@query(
    "win1_interpolate",
    f"""WITH {c.OBSERVATIONS}, m AS (SELECT *, (x = 0 AND y = 0) OR conf < CAST(0.5 AS DOUBLE) AS miss FROM obs),
n AS (SELECT *, last_value(CASE WHEN NOT miss THEN frame_idx END IGNORE NULLS) OVER a AS pi, last_value(CASE WHEN NOT miss THEN x END IGNORE NULLS) OVER a AS px, last_value(CASE WHEN NOT miss THEN y END IGNORE NULLS) OVER a AS py,
  first_value(CASE WHEN NOT miss THEN frame_idx END IGNORE NULLS) OVER b AS ni, first_value(CASE WHEN NOT miss THEN x END IGNORE NULLS) OVER b AS nx, first_value(CASE WHEN NOT miss THEN y END IGNORE NULLS) OVER b AS ny FROM m
  WINDOW a AS (PARTITION BY clip_id, point ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY clip_id, point ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT clip_id, point, frame_idx,
  round(CASE WHEN miss THEN coalesce(px + (nx - px) * (frame_idx - pi) / CAST(ni - pi AS DOUBLE), px, nx, x) ELSE x END, 6) AS x,
  round(CASE WHEN miss THEN coalesce(py + (ny - py) * (frame_idx - pi) / CAST(ni - pi AS DOUBLE), py, ny, y) ELSE y END, 6) AS y,
  CASE WHEN miss AND (pi IS NOT NULL OR ni IS NOT NULL) THEN CAST(0.5 AS DOUBLE) ELSE conf END AS conf FROM n""",
)
def win1_interpolate(spark, sf_dir):
    return sq.interpolate(c.observations(spark, sf_dir), ["clip_id", "point"], "frame_idx", ["x", "y"], "conf").select("clip_id", "point", "frame_idx", *r6("x", "y"), "conf")


@query(
    "win2_anchor_locf",
    f"""WITH {c.BODIES} SELECT clip_id, frame_idx, last_value(CASE WHEN lsx <> 0 AND rsx <> 0 THEN round(sqrt((lsx-rsx)*(lsx-rsx)+(lsy-rsy)*(lsy-rsy)), 6) END IGNORE NULLS)
  OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS scale FROM bodies""",
)
def win2_anchor_locf(spark, sf_dir):
    b = c.bodies(spark, sf_dir)
    a, z = F.col("leftShoulder"), F.col("rightShoulder")
    scale = F.when((a.x != 0) & (z.x != 0), F.round(g.distance(a.x, a.y, z.x, z.y), 6))
    return sq.carry_forward(b, ["clip_id"], "frame_idx", {"scale": scale}).select("clip_id", "frame_idx", "scale")


@query("win3_motion", f"WITH {c.OBSERVATIONS} SELECT clip_id, point, frame_idx, round(coalesce(lead(x) OVER w - x, 0), 6) AS x, round(coalesce(lead(y) OVER w - y, 0), 6) AS y FROM obs WINDOW w AS (PARTITION BY clip_id, point ORDER BY frame_idx)")
def win3_motion(spark, sf_dir):
    return sq.motion(c.observations(spark, sf_dir), ["clip_id", "point"], "frame_idx", ["x", "y"]).select("clip_id", "point", "frame_idx", *r6("x", "y"))


@query(
    "win4_arm_angle_locf",
    f"""WITH {c.FRAMES} SELECT clip_id, frame_idx, coalesce(last_value(CASE WHEN vis >= CAST(0.5 AS DOUBLE) THEN angle END IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS angle FROM frames""",
)
def win4_arm_angle_locf(spark, sf_dir):
    f = c.frames(spark, sf_dir)
    held = sq.carry_forward(f, ["clip_id"], "frame_idx", {"angle": F.when(F.col("vis") >= 0.5, F.col("angle"))})
    return held.select("clip_id", "frame_idx", F.coalesce("angle", F.lit(0.0)).alias("angle"))


@query(
    "win5_cyclic_pad",
    f"""WITH {c.FRAMES}, n AS (SELECT clip_id, list(value ORDER BY frame_idx) AS v FROM frames GROUP BY clip_id), r AS (SELECT clip_id, v, unnest(range(96)) AS i FROM n)
SELECT clip_id, CAST(i AS INTEGER) AS frame_idx, v[CAST(i % len(v) AS INTEGER) + 1] AS value FROM r""",
)
def win5_cyclic_pad(spark, sf_dir):
    return sq.pad_frames(c.frames(spark, sf_dir).select("clip_id", "frame_idx", "value"), ["clip_id"], "frame_idx", 96)


@query(
    "win5_pad_packed",
    f"""WITH {c.FRAMES}, n AS (SELECT clip_id, list(value ORDER BY frame_idx) AS v FROM frames GROUP BY clip_id)
SELECT clip_id, round(list_sum(list_transform(range(120), lambda i: v[CAST(i % len(v) AS INTEGER) + 1])), 4) AS total, v[CAST(119 % len(v) AS INTEGER) + 1] AS last FROM n""",
)
def win5_pad_packed(spark, sf_dir):
    """ARR1, ARR2: frames packed to an array in order, then padded."""
    rows = F.array_sort(F.collect_list(F.struct("frame_idx", "value")))
    packed = c.frames(spark, sf_dir).groupBy("clip_id").agg(F.transform(rows, lambda r: r["value"]).alias("v"))
    padded = packed.select("clip_id", sq.pad_array(F.col("v"), 120).alias("p"))
    return padded.select("clip_id", F.round(F.aggregate("p", F.lit(0.0), lambda a, b: a + b), 4).alias("total"), F.element_at("p", -1).alias("last"))


@query(
    "win6_even_sample",
    """WITH n AS (SELECT conv_id, CAST(count(*) AS INTEGER) AS l FROM conversations GROUP BY conv_id), r AS (SELECT conv_id, l, unnest(range(least(l, 3))) AS i FROM n)
SELECT conv_id, CAST(i AS INTEGER) AS k, CAST(floor(i * (l - 1) / greatest(least(l, 3) - 1, 1)) AS INTEGER) AS turn FROM r""",
)
def win6_even_sample(spark, sf_dir):
    n = c.read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").cast("int").alias("l"))
    return n.select("conv_id", F.posexplode(sq.even_sample(F.col("l"), 3)).alias("k", "turn"))


@query("win7_row_index", "SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS idx FROM conversations")
def win7_row_index(spark, sf_dir):
    return sq.with_row_index(c.read(spark, sf_dir, "conversations"), ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "idx")


@query("flt6_frame_range", f"WITH {c.FRAMES} SELECT clip_id, frame_idx, value FROM frames WHERE frame_idx >= 12 AND frame_idx < 38")
def flt6_frame_range(spark, sf_dir):
    """SRC8, MTH17: 0.5 s and 1.5 s at 25 frames a second: halves to even."""
    from kinseq.sources.readers import frame_range

    return frame_range(c.frames(spark, sf_dir), 25, 0.5, 1.5).select("clip_id", "frame_idx", "value")


@query("flt8_visibility_gate", f"WITH {c.FRAMES} SELECT clip_id, frame_idx, CASE WHEN vis >= CAST(0.3 AS DOUBLE) THEN value ELSE CAST(0 AS DOUBLE) END AS x FROM frames")
def flt8_visibility_gate(spark, sf_dir):
    return c.frames(spark, sf_dir).select("clip_id", "frame_idx", g.visible_or_zero(F.col("value"), F.col("vis"), 0.3).alias("x"))


# --------------------------------------------------------------------------- geometry and normalisers


@query(
    "mth1_joint_angle",
    f"""WITH {c.BODIES}, a AS (SELECT *, abs(degrees(atan2(wry-ely, wrx-elx) - atan2(lsy-ely, lsx-elx))) AS t FROM bodies)
SELECT clip_id, frame_idx, round(CASE WHEN t > 180 THEN 360 - t ELSE t END, 6) AS angle FROM a""",
)
def mth1_joint_angle(spark, sf_dir):
    s, e, w = (F.col(n) for n in ("leftShoulder", "leftElbow", "leftWrist"))
    return c.bodies(spark, sf_dir).select("clip_id", "frame_idx", F.round(g.joint_angle(s.x, s.y, e.x, e.y, w.x, w.y), 6).alias("angle"))


@query("mth2_distance", f"WITH {c.BODIES} SELECT clip_id, frame_idx, round(sqrt((lsx-rsx)*(lsx-rsx)+(lsy-rsy)*(lsy-rsy)), 6) AS d FROM bodies")
def mth2_distance(spark, sf_dir):
    a, b = F.col("leftShoulder"), F.col("rightShoulder")
    return c.bodies(spark, sf_dir).select("clip_id", "frame_idx", F.round(g.distance(a.x, a.y, b.x, b.y), 6).alias("d"))


_MARKS = ["leftShoulder", "nose", "leftElbow"]


def _flat(df: DataFrame, marks=tuple(_MARKS)) -> DataFrame:
    return df.select("clip_id", "frame_idx", *[F.round(F.col(m)[k], 6).alias(f"{m}_{k}") for m in marks for k in "xy"])


_H = "CASE WHEN lsx <> 0 AND rsx <> 0 THEN sqrt((lsx-rsx)*(lsx-rsx)+(lsy-rsy)*(lsy-rsy)) ELSE sqrt((nex-nox)*(nex-nox)+(ney-noy)*(ney-noy)) END"
_LOCF = "IGNORE NULLS) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _box_sql() -> str:
    usable = "(lsx <> 0 AND rsx <> 0) OR (nex <> 0 AND nox <> 0)"
    cols = ", ".join(
        f"round(CASE WHEN sx IS NOT NULL AND ex - sx <> 0 AND sy - ey <> 0 AND {p}x <> 0 THEN ({p}x - sx) / (ex - sx) ELSE {p}x END, 6) AS {m}_x, round(CASE WHEN sx IS NOT NULL AND ex - sx <> 0 AND sy - ey <> 0 AND {p}x <> 0 THEN ({p}y - ey) / (sy - ey) ELSE {p}y END, 6) AS {m}_y"
        for m, p in zip(_MARKS, ("ls", "no", "el"), strict=True)
    )
    return f"""WITH {c.BODIES}, h AS (SELECT *, {_H} AS h, {usable} AS ok FROM bodies),
b AS (SELECT *, last_value(CASE WHEN ok THEN greatest(nex - 3 * h, 0) END {_LOCF} AS sx, last_value(CASE WHEN ok THEN greatest(ley + h, 0) END {_LOCF} AS sy,
  last_value(CASE WHEN ok THEN greatest(nex + 3 * h, 0) END {_LOCF} AS ex, last_value(CASE WHEN ok THEN greatest(ley + h - 6 * h, 0) END {_LOCF} AS ey FROM h)
SELECT clip_id, frame_idx, {cols} FROM b"""


@query("mth3_body_box", _box_sql())
def mth3_body_box(spark, sf_dir):
    return _flat(nm.body_normalise(c.bodies(spark, sf_dir), ["clip_id"], "frame_idx", _MARKS, "box", "column"))


def _anchor_sql(a: str) -> str:
    cols = ", ".join(f"round(CASE WHEN h <> 0 AND {p}x <> 0 THEN ({p}x - ax) / h ELSE {p}x END, 6) AS {m}_x, round(CASE WHEN h <> 0 AND {p}x <> 0 THEN ({p}y - ay) / h ELSE {p}y END, 6) AS {m}_y" for m, p in zip(_MARKS, ("ls", "no", "el"), strict=True))
    return f"""WITH {c.BODIES}, g AS (SELECT *, {_H} AS h0, ((lsx <> 0 AND rsx <> 0) OR (nex <> 0 AND nox <> 0)) AND {a}x <> 0 AS ok FROM bodies),
b AS (SELECT *, last_value(CASE WHEN ok THEN h0 END {_LOCF} AS h, last_value(CASE WHEN ok THEN {a}x END {_LOCF} AS ax, last_value(CASE WHEN ok THEN {a}y END {_LOCF} AS ay FROM g)
SELECT clip_id, frame_idx, {cols} FROM b"""


@query("mth4_body_neck", _anchor_sql("ne"))
def mth4_body_neck(spark, sf_dir):
    return _flat(nm.body_normalise(c.bodies(spark, sf_dir), ["clip_id"], "frame_idx", _MARKS, "neck", "column"))


@query("mth4_body_nose", _anchor_sql("no"))
def mth4_body_nose(spark, sf_dir):
    return _flat(nm.body_normalise(c.bodies(spark, sf_dir), ["clip_id"], "frame_idx", _MARKS, "nose", "column"))


@query("mth4_body_neck_as_observed", f"WITH {c.BODIES} SELECT clip_id, frame_idx, round(lsx, 6) AS \"leftShoulder_x\", round(lsy, 6) AS \"leftShoulder_y\", round(nox, 6) AS nose_x, round(noy, 6) AS nose_y, round(elx, 6) AS \"leftElbow_x\", round(ely, 6) AS \"leftElbow_y\" FROM bodies")
def mth4_body_neck_as_observed(spark, sf_dir):
    """A neck that is always (0, 0) leaves every frame alone."""
    return _flat(nm.body_normalise(c.bodies(spark, sf_dir), ["clip_id"], "frame_idx", _MARKS, "neck", "zero"))


@query("mth7_hand", f"WITH {c.BODIES} SELECT clip_id, frame_idx, round(CASE WHEN wrx <> 0 AND elx <> 0 THEN elx - wrx ELSE elx END, 6) AS \"leftElbow_x\", round(CASE WHEN wrx <> 0 AND elx <> 0 THEN ely - wry ELSE ely END, 6) AS \"leftElbow_y\" FROM bodies")
def mth7_hand(spark, sf_dir):
    return _flat(nm.hand_normalise(c.bodies(spark, sf_dir), "leftWrist", ["leftElbow"]), ("leftElbow",))


@query("mth8_shift", f"WITH {c.OBSERVATIONS} SELECT clip_id, point, frame_idx, round(x - 0.5, 6) AS x, round(y - 0.5, 6) AS y FROM obs")
def mth8_shift(spark, sf_dir):
    return nm.shift_half(c.observations(spark, sf_dir), ["x", "y"]).select("clip_id", "point", "frame_idx", *r6("x", "y"))


_JOINTS = "SELECT l_orderkey AS clip_id, l_linenumber - 1 AS joint, l_quantity AS x, l_extendedprice AS y FROM lineitem"


def _joints(spark, sf_dir) -> DataFrame:
    return c.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip_id"), (F.col("l_linenumber") - 1).alias("joint"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


@query("mth9_root_centre", f"WITH j AS ({_JOINTS}) SELECT clip_id, joint, round(x - avg(x) FILTER (joint = 0) OVER w, 4) AS x, round(y - avg(y) FILTER (joint = 0) OVER w, 4) AS y FROM j WINDOW w AS (PARTITION BY clip_id)")
def mth9_root_centre(spark, sf_dir):
    out = nm.root_centre(_joints(spark, sf_dir), "clip_id", "joint", ["x", "y"])
    return out.select("clip_id", "joint", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("mth9_root_only", f"WITH j AS ({_JOINTS}) SELECT clip_id, joint, round(CASE WHEN joint = 0 THEN x - avg(x) FILTER (joint = 0) OVER w ELSE x END, 4) AS x FROM j WINDOW w AS (PARTITION BY clip_id)")
def mth9_root_only(spark, sf_dir):
    out = nm.root_centre(_joints(spark, sf_dir), "clip_id", "joint", ["x"], root_only=True)
    return out.select("clip_id", "joint", F.round("x", 4).alias("x"))


@query("agg11_zscore", f"WITH {c.OBSERVATIONS} SELECT clip_id, point, frame_idx, round(coalesce((x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0), 0), 5) AS x FROM obs WINDOW w AS (PARTITION BY clip_id, point)")
def agg11_zscore(spark, sf_dir):
    return nm.standardise(c.observations(spark, sf_dir), ["clip_id", "point"], ["x"]).select("clip_id", "point", "frame_idx", F.round("x", 5).alias("x"))


@query("mth14_squeeze_perspective", f"""WITH {c.OBSERVATIONS}, z AS (SELECT *, x / 500 AS u, y / 100 AS v FROM obs)
SELECT clip_id, point, frame_idx, round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE 0.1 + (1 - 0.1 - 0.05) * u END, 6) AS sx,
 round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE ((1-0.07)/(1-0.14)) * u / ((0.14/(1-0.14)) * u + 1) END, 6) AS px,
 round(CASE WHEN u = 0 AND v = 0 THEN 0 ELSE ((0.07/(1-0.14)) * u + v) / ((0.14/(1-0.14)) * u + 1) END, 6) AS py FROM z""")  # fmt: skip
def mth14_squeeze_perspective(spark, sf_dir):
    o = c.observations(spark, sf_dir)
    u, v = F.col("x") / 500.0, F.col("y") / 100.0
    sx, _ = g.squeeze(u, v, F.lit(0.1), F.lit(0.05))
    px, py = g.perspective(u, v, F.lit(0.07), F.lit(False))
    keep = lambda n: F.round(g.unless_origin(u, v, n), 6)
    return o.select("clip_id", "point", "frame_idx", keep(sx).alias("sx"), keep(px).alias("px"), keep(py).alias("py"))


@query("mth16_17_frames_of_times", f"WITH {c.FRAMES} SELECT clip_id, frame_idx, CAST(trunc((t_ms - 400) / 1000 * 25) AS INTEGER) AS cut, CAST(round_even(t_ms / 1000 * 12.5, 0) AS INTEGER) AS near FROM frames")
def mth16_17_frames_of_times(spark, sf_dir):
    t = F.col("t_ms")
    return c.frames(spark, sf_dir).select("clip_id", "frame_idx", g.frame_truncated((t - 400.0) / 1000.0, 25).alias("cut"), g.frame_rounded(t / 1000.0, 12.5).alias("near"))


@query("mth18_crop", f"WITH {c.OBSERVATIONS} SELECT clip_id, point, frame_idx, round(x - 40, 6) AS x, round(y - 10, 6) AS y, x - 40 >= 0 AND x - 40 < 300 AND y - 10 >= 0 AND y - 10 < 60 AS inside FROM obs")
def mth18_crop(spark, sf_dir):
    x, y, inside = g.crop(F.col("x"), F.col("y"), "300:60:40:10")
    return c.observations(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), inside.alias("inside"))


@query("mth20_fit_scale", "SELECT p_partkey, round(least(1, 720 / greatest(p_size * 50, p_retailprice)), 6) AS scale FROM part")
def mth20_fit_scale(spark, sf_dir):
    return c.read(spark, sf_dir, "part").select("p_partkey", F.round(g.fit_scale(F.col("p_size") * 50.0, F.col("p_retailprice"), 720), 6).alias("scale"))


# --------------------------------------------------------------------------- skeleton


def _bone_sql(mode: str) -> str:
    terms = sk.bone_terms(mode)
    cols = ", ".join("round(" + " + ".join(f"({k}) * CAST(embedding[{j + 1}] AS DOUBLE)" for k, j in terms.get(i, [(1, i)])) + f", 6) AS j{i}" for i in range(27))
    return f"SELECT vec_id AS clip_id, {cols} FROM embeddings"


def _bones(spark, sf_dir, mode: str) -> DataFrame:
    e = c.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("clip_id"), F.transform(F.slice("embedding", 1, 27), lambda x: x.cast("double")).alias("v"))
    e = e.withColumn("b", sk.bone_stream(F.col("v"), mode))
    return e.select("clip_id", *[F.round(F.get("b", F.lit(i)), 6).alias(f"j{i}") for i in range(27)])


@query("mth10_bones", _bone_sql("true"))
def mth10_bones(spark, sf_dir):
    return _bones(spark, sf_dir, "true")


@query("mth10_bones_in_place", _bone_sql("in_place"))
def mth10_bones_in_place(spark, sf_dir):
    return _bones(spark, sf_dir, "in_place")


_POINTS = "(VALUES " + ", ".join(f"({i}, {j})" for i, j in enumerate(JOINTS[27])) + ") AS d(joint, idx)"


@query("mth11_select_joints", f"SELECT vec_id AS clip_id, d.joint, round(CAST(embedding[(d.idx % 64) + 1] AS DOUBLE), 6) AS x FROM embeddings, {_POINTS}")
def mth11_select_joints(spark, sf_dir):
    """Each whole-body index of the layout, looked up in a long observation table."""
    e = c.read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("clip_id"), F.posexplode("embedding").alias("at", "x"))
    names = [("POSE", str(i)) for i in JOINTS[27]]
    wanted = sk.select_points(spark.createDataFrame([("POSE", str(i), i % 64) for i in JOINTS[27]], "component string, point string, at int"), names)
    return e.join(F.broadcast(wanted), "at").select("clip_id", "joint", F.round(F.col("x").cast("double"), 6).alias("x"))


_EDGES = "(VALUES " + ", ".join(f"({a}, {b}), ({b}, {a})" for a, b in BONES) + ") AS e(i, j)"
_HOPS = f"walk(i, j, hops) AS (SELECT CAST(n AS INTEGER), CAST(n AS INTEGER), 0 FROM range(27) r(n) UNION SELECT w.i, e.j, w.hops + 1 FROM walk w JOIN {_EDGES} ON w.j = e.i WHERE w.hops < 27), hop AS (SELECT i, j, min(hops) AS hops FROM walk GROUP BY i, j)"
_PARTS = f"{_HOPS}, part AS (SELECT CASE WHEN h.hops = 0 THEN 0 WHEN b.hops < a.hops THEN 1 ELSE 2 END AS part, h.i, h.j FROM hop h JOIN hop a ON a.i = h.i AND a.j = 0 JOIN hop b ON b.i = h.j AND b.j = 0 WHERE h.hops <= 1)"


@query("grf1_hops", f"WITH RECURSIVE {_HOPS} SELECT i, j, hops FROM hop")
def grf1_hops(spark, sf_dir):
    return sk.hop_distances(spark)


@query("grf2_partitions", f"WITH RECURSIVE {_PARTS} SELECT part, i, j FROM part")
def grf2_partitions(spark, sf_dir):
    return sk.partitions(sk.hop_distances(spark))


@query("grf3_adjacency", f"WITH RECURSIVE {_PARTS} SELECT part, i, j, round(1.0 / count(*) OVER (PARTITION BY part, j), 6) AS a FROM part")
def grf3_adjacency(spark, sf_dir):
    return sk.normalised_adjacency(sk.partitions(sk.hop_distances(spark))).select("part", "i", "j", F.round("a", 6).alias("a"))


@query("grf3_uniform", f"WITH e AS (SELECT i, j FROM {_EDGES} UNION ALL SELECT CAST(n AS INTEGER), CAST(n AS INTEGER) FROM range(27) r(n)) SELECT i, j, round(1.0 / count(*) OVER (PARTITION BY j), 6) AS a FROM e")
def grf3_uniform(spark, sf_dir):
    return sk.uniform_adjacency(spark).select("i", "j", F.round("a", 6).alias("a"))


# --------------------------------------------------------------------------- metadata


@query("agg1_vocabulary", f"WITH {c.CLIPS} SELECT gloss_id, gloss FROM vocab")
def agg1_vocabulary(spark, sf_dir):
    return md.vocabulary(c.clips(spark, sf_dir))


@query("agg2_cameras", f"WITH {c.CLIPS} SELECT DISTINCT cam_id FROM clips")
def agg2_cameras(spark, sf_dir):
    return c.clips(spark, sf_dir).select("cam_id").distinct()


def _with_ids(spark, sf_dir) -> DataFrame:
    clips = c.clips(spark, sf_dir)
    return md.with_gloss_id(clips, md.vocabulary(clips))


@query("jn1_gloss_ids", f"WITH {c.CLIPS} SELECT video_id, gloss, gloss_id FROM clips LEFT JOIN vocab USING (gloss)")
def jn1_gloss_ids(spark, sf_dir):
    return _with_ids(spark, sf_dir).select("video_id", "gloss", "gloss_id")


_SPLITS = "CASE o_orderpriority WHEN '1-URGENT' THEN 'val' WHEN '2-HIGH' THEN 'validation' WHEN '3-MEDIUM' THEN 'test' WHEN '5-LOW' THEN 'other' ELSE 'train' END"


def _split_map(spark, sf_dir) -> DataFrame:
    p = F.col("o_orderpriority")
    split = F.when(p == "1-URGENT", "val").when(p == "2-HIGH", "validation").when(p == "3-MEDIUM", "test").when(p == "5-LOW", "other").otherwise("train")
    return c.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("row_id"), "o_orderkey", split.alias("split"))


_LAST = f"last_ AS (SELECT o_custkey AS row_id, {_SPLITS} AS split, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders)"


@query("jn2_split_map", f"WITH {c.CLIPS}, {_LAST} SELECT video_id, l.split FROM clips LEFT JOIN last_ l ON clips.row_id = l.row_id AND l.n = 1")
def jn2_split_map(spark, sf_dir):
    return md.with_split(c.clips(spark, sf_dir), _split_map(spark, sf_dir), "row_id", [F.col("o_orderkey")]).select("video_id", "split")


@query("flt1_2_named_splits", f"WITH {c.CLIPS}, {_LAST} SELECT video_id, CASE l.split WHEN 'validation' THEN 'val' ELSE l.split END AS split FROM clips JOIN last_ l ON clips.row_id = l.row_id AND l.n = 1 WHERE l.split IN ('train', 'val', 'validation', 'test')")
def flt1_2_named_splits(spark, sf_dir):
    return md.named_splits(md.with_split(c.clips(spark, sf_dir), _split_map(spark, sf_dir), "row_id", [F.col("o_orderkey")])).select("video_id", "split")


_SAMPLE = f"""{c.CLIPS}, ranked_ AS (SELECT *, row_number() OVER (PARTITION BY gloss_id, cam_id ORDER BY md5(row_id || ':42'), row_id) AS n, count(*) OVER (PARTITION BY gloss_id, cam_id) AS total
  FROM clips LEFT JOIN vocab USING (gloss))"""


@query("agg3_stratified_sample", f"WITH {_SAMPLE} SELECT video_id, gloss_id, cam_id FROM ranked_ WHERE n <= round_even(0.5 * total, 0) AND gloss_id IS NOT NULL")
def agg3_stratified_sample(spark, sf_dir):
    out = md.sample_rank(_with_ids(spark, sf_dir), ["gloss_id", "cam_id"], F.col("row_id"))
    return out.filter("sampled").select("video_id", "gloss_id", "cam_id")


@query("jn4_sample_complement", f"WITH {_SAMPLE} SELECT video_id FROM ranked_ WHERE NOT (n <= round_even(0.5 * total, 0) AND gloss_id IS NOT NULL)")
def jn4_sample_complement(spark, sf_dir):
    out = md.sample_rank(_with_ids(spark, sf_dir), ["gloss_id", "cam_id"], F.col("row_id"))
    return md.complement(out, out.filter("sampled"), "row_id").select("video_id")


_CAMERA = {"020": ("1", "2", "3"), "014": ("2", "3", "1"), "015": ("3", "1", "2")}
_BY_CAM = " ".join(f"WHEN signer_id = '{s}' AND cam_id = '{k}' THEN '{n}'" for s, cams in _CAMERA.items() for k, n in zip(cams, ("train", "val", "test"), strict=True))


@query(
    "set2_signer_split",
    f"""WITH {c.CLIPS}, r AS (SELECT *, signer_id = '009' AS sh, row_number() OVER (PARTITION BY signer_id = '009', gloss_id, cam_id ORDER BY md5(row_id || ':42'), row_id) AS n,
  count(*) OVER (PARTITION BY signer_id = '009', gloss_id, cam_id) AS total FROM clips LEFT JOIN vocab USING (gloss))
SELECT video_id, CASE WHEN signer_id = '007' THEN 'val' WHEN signer_id = '024' THEN 'test' WHEN sh THEN CASE WHEN n <= round_even(0.5 * total, 0) AND gloss_id IS NOT NULL THEN 'val' ELSE 'test' END {_BY_CAM} ELSE 'train' END AS split FROM r""",
)
def set2_signer_split(spark, sf_dir):
    return md.signer_split(_with_ids(spark, sf_dir), F.col("row_id")).select("video_id", "split")


@query("agg9_split_sizes", ORACLES["set2_signer_split"].replace("SELECT video_id, CASE", "SELECT split, count(*) AS n FROM (SELECT CASE") + ") GROUP BY split")
def agg9_split_sizes(spark, sf_dir):
    return md.status_counts(set2_signer_split(spark, sf_dir), "split")


@query("lim1_debug_take", f"WITH {c.CLIPS} SELECT video_id, cam_id FROM (SELECT *, row_number() OVER (PARTITION BY cam_id ORDER BY md5(row_id || ':42:shuffle'), row_id) AS n FROM clips) WHERE n <= 10")
def lim1_debug_take(spark, sf_dir):
    return md.debug_take(c.clips(spark, sf_dir), F.col("row_id"), 10, "cam_id").select("video_id", "cam_id")


@query("prj3_clip_columns", f"WITH {c.CLIPS} SELECT video_id, cam_id, cam || '/' || video_id || '.mp4' AS video, cam || '/' || video_id || '.pose' AS pose FROM clips")
def prj3_clip_columns(spark, sf_dir):
    return md.select_present(md.clip_columns(c.clips(spark, sf_dir)), ["video_id", "cam_id", "video", "pose", "absent"])


@query("prj4_subset_cameras", "SELECT s_suppkey, unnest(string_split('set_' || (s_suppkey % 3 + 1) || '_' || (s_nationkey % 2 + 1), '_')[2:]) AS cam FROM supplier")
def prj4_subset_cameras(spark, sf_dir):
    s = c.read(spark, sf_dir, "supplier")
    name = F.concat_ws("_", F.lit("set"), (F.col("s_suppkey") % 3 + 1).cast("string"), (F.col("s_nationkey") % 2 + 1).cast("string"))
    return s.select("s_suppkey", F.explode(md.subset_cameras(name)).alias("cam"))


@query("prj5_flt11_clip_info", "SELECT p_partkey, (p_size * 40) || ':' || (p_size * 30) AS resolution, CAST(round_even(p_retailprice / 50, 0) AS INTEGER) AS fps FROM part WHERE (p_size * 40) || ':' || (p_size * 30) <> '400:300' OR round_even(p_retailprice / 50, 0) <> 25")
def prj5_flt11_clip_info(spark, sf_dir):
    p = c.read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 40).alias("width"), (F.col("p_size") * 30).alias("height"), (F.col("p_retailprice") / 50.0).alias("fps"))
    return md.needs_normalising(md.clip_info(p), "400:300", 25).select("p_partkey", "resolution", "fps")


@query(
    "src10_resolve_paths",
    f"""WITH {c.CLIPS}, listing AS (SELECT 'data/' || video_id || '.pose' AS path FROM clips WHERE row_id % 3 = 0 UNION ALL SELECT 'data/' || cam || '/' || video_id || '.pose' FROM clips WHERE row_id % 4 = 0)
SELECT video_id, CASE WHEN 'data/' || cam || '/' || video_id || '.pose' IN (SELECT path FROM listing) THEN 'data/' || cam || '/' || video_id || '.pose'
  WHEN 'data/' || video_id || '.pose' IN (SELECT path FROM listing) THEN 'data/' || video_id || '.pose' ELSE 'keys/' || cam || '/' || video_id || '.pose' END AS path FROM clips""",
)
def src10_resolve_paths(spark, sf_dir):
    clips = c.clips(spark, sf_dir)
    name = F.format_string("%s.pose", "video_id")
    options = [F.concat_ws("/", F.lit("keys"), "cam", name), F.concat_ws("/", F.lit("keys"), name), F.concat_ws("/", F.lit("data"), "cam", name), F.concat_ws("/", F.lit("data"), name)]
    listing = clips.filter("row_id % 3 = 0").select(options[3].alias("path")).unionByName(clips.filter("row_id % 4 = 0").select(options[2].alias("path")))
    return md.resolve_paths(clips, listing, "video_id", options).select("video_id", "path")


@query("flt5_existing_files", f"WITH {c.CLIPS} SELECT video_id FROM clips WHERE row_id % 3 = 0")
def flt5_existing_files(spark, sf_dir):
    clips = c.clips(spark, sf_dir).withColumn("path", F.format_string("%s.mp4", "video_id"))
    return md.existing(clips, clips.filter("row_id % 3 = 0").select("path")).select("video_id")


@query("snk11_not_yet_written", f"WITH {c.CLIPS} SELECT video_id FROM clips WHERE row_id % 3 <> 0")
def snk11_not_yet_written(spark, sf_dir):
    clips = c.clips(spark, sf_dir).withColumn("path", F.format_string("%s.pose", "video_id"))
    return md.not_yet_written(clips, clips.filter("row_id % 3 = 0").select("path")).select("video_id")


@query("str6_camera_of_path", f"WITH {c.CLIPS} SELECT video_id, cam FROM clips")
def str6_camera_of_path(spark, sf_dir):
    path = F.concat_ws("/", F.lit("data"), "cam", "video_id")
    return c.clips(spark, sf_dir).select("video_id", md.camera_of_path(path, ["cam_1", "cam_2", "cam_3"]).alias("cam"))


@query("agg8_status_counts", "SELECT CASE o_orderstatus WHEN 'O' THEN 'processed' WHEN 'F' THEN 'skipped' ELSE 'failed' END AS status, count(*) AS n FROM orders GROUP BY 1")
def agg8_status_counts(spark, sf_dir):
    s = F.col("o_orderstatus")
    return md.status_counts(c.read(spark, sf_dir, "orders").select(F.when(s == "O", "processed").when(s == "F", "skipped").otherwise("failed").alias("status")))


@query("lim2_first_failures", "SELECT o_orderkey, greatest((SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) - 10, 0) AS more FROM orders WHERE o_orderstatus NOT IN ('O', 'F') ORDER BY o_orderkey LIMIT 10")
def lim2_first_failures(spark, sf_dir):
    o = c.read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus").isin("O", "F"), "ok").otherwise("failed").alias("status"))
    return md.first_failures(o, "o_orderkey").select("o_orderkey", "more")


@query("lim3_history", "SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n <= 40")
def lim3_history(spark, sf_dir):
    return md.latest(c.read(spark, sf_dir, "events"), "event_id", 40, "user_id").select("event_id", "user_id")


@query("srt2_seeded_shuffle", f"WITH {c.CLIPS} SELECT video_id, row_number() OVER (PARTITION BY cam_id ORDER BY md5(row_id || ':42:shuffle'), row_id) AS place FROM clips")
def srt2_seeded_shuffle(spark, sf_dir):
    w = Window.partitionBy("cam_id").orderBy(md.shuffle_key(F.col("row_id")), "row_id")
    return c.clips(spark, sf_dir).select("video_id", F.row_number().over(w).cast("long").alias("place"))


# --------------------------------------------------------------------------- metrics


def _predicted(spark, sf_dir) -> DataFrame:
    return c.scored(spark, sf_dir).withColumn("pred", mt.argmax(F.col("logits")))


_PRED = f"{c.SCORED}, pred AS (SELECT clip_id, label, CAST(id AS INTEGER) AS pred FROM ranked WHERE rn = 1)"


@query("top1_argmax", f"WITH {_PRED} SELECT clip_id, pred FROM pred")
def top1_argmax(spark, sf_dir):
    return _predicted(spark, sf_dir).select("clip_id", "pred")


_TOP2 = f"{c.SCORED}, k3 AS (SELECT clip_id, CAST(id AS INTEGER) AS gloss_id, rn, exp(s - max(s) OVER (PARTITION BY clip_id)) AS e FROM ranked WHERE rn <= 3)"


@query("top2_topk_softmax", f"WITH {_TOP2} SELECT clip_id, CAST(rn - 1 AS INTEGER) AS rank, gloss_id, round(e / sum(e) OVER (PARTITION BY clip_id), 6) AS score FROM k3")
def top2_topk_softmax(spark, sf_dir):
    flat = c.scored(spark, sf_dir).select("clip_id", F.posexplode(mt.top_k(F.col("logits"), 3)).alias("rank", "p"))
    return flat.select("clip_id", "rank", F.col("p.id").alias("gloss_id"), F.round("p.score", 6).alias("score"))


@query(
    "jn3_str1_messages",
    f"""WITH {_TOP2}, sc AS (SELECT *, e / sum(e) OVER (PARTITION BY clip_id) AS score FROM k3)
SELECT clip_id, string_agg('g' || gloss_id || ' (' || printf('%.2f', score * 100) || '%)', ', ' ORDER BY rn) AS message FROM sc GROUP BY clip_id""",
)
def jn3_str1_messages(spark, sf_dir):
    vocab = spark.range(10).select(F.col("id").cast("int").alias("gloss_id"), F.concat(F.lit("g"), F.col("id").cast("string")).alias("gloss"))
    top = c.scored(spark, sf_dir).select("clip_id", mt.top_k(F.col("logits"), 3).alias("predictions"))
    return mt.with_glosses(top, vocab).select("clip_id", g.percent_message(F.col("predictions")).alias("message"))


@query("mth19_softmax", f"WITH {c.SCORED} SELECT clip_id, CAST(id AS INTEGER) AS id, round(exp(s - max(s) OVER w) / sum(exp(s)) OVER w * exp(max(s) OVER w), 6) AS p FROM flat WINDOW w AS (PARTITION BY clip_id)")
def mth19_softmax(spark, sf_dir):
    return c.scored(spark, sf_dir).select("clip_id", F.posexplode(g.softmax(F.col("logits"))).alias("id", "p")).select("clip_id", "id", F.round("p", 6).alias("p"))


@query("agg4_accuracy", f"WITH {_PRED} SELECT round(avg(CAST(pred = label AS INTEGER)), 6) AS accuracy FROM pred")
def agg4_accuracy(spark, sf_dir):
    return mt.accuracy(_predicted(spark, sf_dir)).select(*r6("accuracy"))


_MACRO = f"""{_PRED}, cls AS (SELECT label AS k FROM pred UNION SELECT pred FROM pred),
n AS (SELECT k, (SELECT count(*) FROM pred WHERE label = k AND pred = k) AS tp, (SELECT count(*) FROM pred WHERE pred = k) AS p, (SELECT count(*) FROM pred WHERE label = k) AS s FROM cls),
each AS (SELECT coalesce(tp / nullif(p, 0), 0) AS pr, coalesce(tp / nullif(s, 0), 0) AS re FROM n)"""


@query("agg5_macro_scores", f"WITH {_MACRO} SELECT round(avg(pr), 6) AS precision, round(avg(re), 6) AS recall, round(avg(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END), 6) AS f1 FROM each")
def agg5_macro_scores(spark, sf_dir):
    return mt.macro_scores(_predicted(spark, sf_dir)).select(*r6("precision", "recall", "f1"))


@query("agg6_topk_accuracy", f"WITH {c.SCORED}, hit AS (SELECT clip_id, rn FROM ranked WHERE id = label), n AS (SELECT count(*) AS n FROM scored) SELECT " + ", ".join(f"round(count(*) FILTER (rn <= {k}) / any_value(n), 6) AS top_{k}" for k in (3, 5, 10)) + " FROM hit, n")
def agg6_topk_accuracy(spark, sf_dir):
    return mt.top_k_accuracy(c.scored(spark, sf_dir), "logits", "label").select(*r6("top_3", "top_5", "top_10"))


_CELLS = f"{_PRED}, cell AS (SELECT CAST(a AS INTEGER) AS label, CAST(b AS INTEGER) AS pred FROM range(10) x(a), range(10) y(b)), cnt AS (SELECT cell.label, cell.pred, count(p.clip_id) AS n FROM cell LEFT JOIN pred p ON p.label = cell.label AND p.pred = cell.pred GROUP BY ALL)"


@query("agg7_confusion", f"WITH {_CELLS} SELECT label, pred, n FROM cnt")
def agg7_confusion(spark, sf_dir):
    return mt.confusion_matrix(_predicted(spark, sf_dir), 10)


@query("agg7_confusion_normalised", f"WITH {_CELLS} SELECT label, pred, round(n / sum(n) OVER (), 6) AS n FROM cnt")
def agg7_confusion_normalised(spark, sf_dir):
    return mt.confusion_matrix(_predicted(spark, sf_dir), 10, normalise=True).select("label", "pred", *r6("n"))


# --------------------------------------------------------------------------- augmentations


def _u(tag: str, key: str = "clip_id", seed: int = 42) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}:{tag}'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def _unit(spark, sf_dir) -> DataFrame:
    o = c.observations(spark, sf_dir)
    return o.select("clip_id", "point", "frame_idx", (F.col("x") / 500.0).alias("x"), (F.col("y") / 100.0).alias("y"))


_UNIT = f"{c.OBSERVATIONS}, unit AS (SELECT clip_id, point, frame_idx, x / CAST(500 AS DOUBLE) AS x, y / CAST(100 AS DOUBLE) AS y FROM obs)"


@query("rnd1_choice", f"WITH {c.CLIPS} SELECT video_id, CASE WHEN {_u('p', 'row_id')} < 0.5 THEN CAST(floor({_u('which', 'row_id')} * 4) AS INTEGER) END AS aug FROM clips")
def rnd1_choice(spark, sf_dir):
    return c.clips(spark, sf_dir).select("video_id", aug.choice(F.col("row_id"), 42, 0.5).alias("aug"))


@query("rnd2_rotate", f"""WITH {_UNIT}, a AS (SELECT *, radians(-13.0 + 26.0 * {_u('rotate')}) AS r FROM unit)
SELECT clip_id, point, frame_idx, round(0.5 + cos(r) * (x - 0.5) - sin(r) * (y - 0.5), 6) AS x, round(0.5 + sin(r) * (x - 0.5) + cos(r) * (y - 0.5), 6) AS y FROM a""")  # fmt: skip
def rnd2_rotate(spark, sf_dir):
    x, y = aug.rotated(F.col("clip_id"), F.col("x"), F.col("y"), 42)
    return _unit(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("rnd3_squeeze", f"""WITH {_UNIT}, a AS (SELECT *, 0.15 * {_u('left')} AS l, 0.15 * {_u('right')} AS r FROM unit)
SELECT clip_id, point, frame_idx, round(CASE WHEN x = 0 AND y = 0 THEN 0 ELSE l + (1 - l - r) * x END, 6) AS x, round(y, 6) AS y FROM a""")  # fmt: skip
def rnd3_squeeze(spark, sf_dir):
    x, y = aug.squeezed(F.col("clip_id"), F.col("x"), F.col("y"), 42)
    return _unit(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("rnd3_perspective", f"""WITH {_UNIT}, a AS (SELECT *, 0.1 * {_u('tilt')} AS m, {_u('side')} < 0.5 AS lf FROM unit),
b AS (SELECT *, CASE WHEN lf THEN 1 - x ELSE x END AS t, (1 - m) / (1 - 2 * m) AS a1, 2 * m / (1 - 2 * m) AS g1, m / (1 - 2 * m) AS d1 FROM a),
d AS (SELECT *, a1 * t / (g1 * t + 1) AS nx, (d1 * t + y) / (g1 * t + 1) AS ny FROM b)
SELECT clip_id, point, frame_idx, round(CASE WHEN x = 0 AND y = 0 THEN 0 WHEN lf THEN 1 - nx ELSE nx END, 6) AS x, round(CASE WHEN x = 0 AND y = 0 THEN 0 ELSE ny END, 6) AS y FROM d""")  # fmt: skip
def rnd3_perspective(spark, sf_dir):
    x, y = aug.tilted(F.col("clip_id"), F.col("x"), F.col("y"), 42)
    return _unit(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


def _arm_sql() -> str:
    steps, last = [], "bodies"
    chain = [("ne",), ("ls",), ("el",), ("wr",)]
    for k, (o,) in enumerate(chain[:-1]):
        later = [p for (p,) in chain[k + 1 :]]
        r = f"radians(-4.0 + 8.0 * {_u(f'left{k}')})"
        cols = [f"CASE WHEN t THEN {o}x + cos(r) * ({p}x - {o}x) - sin(r) * ({p}y - {o}y) ELSE {p}x END AS {p}x, CASE WHEN t THEN {o}y + sin(r) * ({p}x - {o}x) + cos(r) * ({p}y - {o}y) ELSE {p}y END AS {p}y" for p in later]
        names = ", ".join(f"{p}x, {p}y" for p in later)
        steps.append(f"s{k} AS (SELECT * EXCLUDE ({names}, t, r), {', '.join(cols)} FROM (SELECT *, {_u(f'left{k}p')} < 0.3 AS t, {r} AS r FROM {last}))")
        last = f"s{k}"
    return f"""WITH {c.BODIES}, {", ".join(steps)} SELECT clip_id, frame_idx, round(lsx, 6) AS "leftShoulder_x", round(lsy, 6) AS "leftShoulder_y", round(elx, 6) AS "leftElbow_x", round(ely, 6) AS "leftElbow_y", round(wrx, 6) AS "leftWrist_x", round(wry, 6) AS "leftWrist_y" FROM {last}"""


@query("rnd4_arm_rotate", _arm_sql())
def rnd4_arm_rotate(spark, sf_dir):
    return _flat(aug.arms_rotated(c.bodies(spark, sf_dir), F.col("clip_id"), 42), ("leftShoulder", "leftElbow", "leftWrist"))


@query("rnd5_noise", f"""WITH {_UNIT} SELECT clip_id, point, frame_idx, round(x + 0.001 * sqrt(-2.0 * ln(1.0 - {_u('noiseu', "clip_id || '/' || frame_idx")})) * cos(6.283185307179586 * {_u('noisev', "clip_id || '/' || frame_idx")}), 6) AS x FROM unit""")
def rnd5_noise(spark, sf_dir):
    key = F.concat_ws("/", F.col("clip_id").cast("string"), F.col("frame_idx").cast("string"))
    return _unit(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(aug.noisy(F.col("x"), key, 42), 6).alias("x"))


_AFFINE = f"""CASE WHEN {_u('ap')} < 0.5 THEN CAST(floor({_u('ak')} * 3) AS INTEGER) END AS kind, 0.2 * sqrt(-2.0 * ln(1.0 - {_u('anu')})) * cos(6.283185307179586 * {_u('anv')}) AS n"""
_AFFINE_XY = """CASE kind WHEN 0 THEN cos(n) * x - sin(n) * y WHEN 1 THEN x + n * y WHEN 2 THEN x * (1 + n) ELSE x END AS x, CASE kind WHEN 0 THEN sin(n) * x + cos(n) * y WHEN 2 THEN y * (1 + n) ELSE y END AS y"""


@query("rnd6_affine", f"WITH {_UNIT}, a AS (SELECT *, {_AFFINE} FROM unit), z AS (SELECT clip_id, point, frame_idx, {_AFFINE_XY} FROM a) SELECT clip_id, point, frame_idx, round(x, 6) AS x, round(y, 6) AS y FROM z")
def rnd6_affine(spark, sf_dir):
    """Graph-model augmentation; the library's exact draws are not part of its contract, ours are md5 of the clip."""
    x, y = aug.affine(F.col("clip_id"), F.col("x"), F.col("y"), 42, 0.5)
    return _unit(spark, sf_dir).select("clip_id", "point", "frame_idx", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


# --------------------------------------------------------------------------- sinks and the model boundary


def _root(spark: SparkSession) -> str:
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="kinseq-")
    return f"{root.rstrip('/')}/sink-{uuid.uuid4().hex[:12]}"


@query("snk1_segments_csv", f"WITH {_RUNS} SELECT seg_idx AS idx, start_s AS start_time, end_s AS end_time FROM seg")
def snk1_segments_csv(spark, sf_dir):
    """SRC4, SNK1: segments through their CSV form."""
    from kinseq.sources import readers, writers

    path = _root(spark)
    writers.write_segments(_segments(spark, sf_dir), path)
    return readers.read_segments(spark, path)


@query("snk2_packed_by_camera", f"WITH {c.CLIPS} SELECT cam, count(*) AS n FROM clips GROUP BY cam")
def snk2_packed_by_camera(spark, sf_dir):
    """SRC6, SNK2"""
    from kinseq.sources import readers, writers

    path = _root(spark)
    writers.write_packed(c.clips(spark, sf_dir), path)
    return readers.read_packed(spark, path).groupBy("cam").agg(F.count("*").alias("n"))


@query("snk4_vocabulary_csv", f"WITH {c.CLIPS} SELECT gloss_id, gloss FROM vocab")
def snk4_vocabulary_csv(spark, sf_dir):
    """SRC2, SNK4"""
    from kinseq.sources import readers, writers

    path = _root(spark)
    writers.write_vocabulary(md.vocabulary(c.clips(spark, sf_dir)), path)
    return readers.read_vocabulary(spark, path)


@query("snk8_history_csv", "SELECT printf('%.3f', value) AS start_time, printf('%.6f', value / 1000) AS score FROM events")
def snk8_history_csv(spark, sf_dir):
    from kinseq.sources import writers

    path, v = _root(spark), F.col("value")
    e = c.read(spark, sf_dir, "events").select(v.alias("start_time"), v.alias("end_time"), v.alias("inference_time"), F.col("event_type").alias("gloss"), (v / 1000.0).alias("score"))
    writers.write_history(e, path)
    return spark.read.schema("start_time string, end_time string, inference_time string, gloss string, score string").csv(path, header=True).select("start_time", "score")


@query("udf2_score_stub", f"WITH {c.FRAMES}, n AS (SELECT clip_id, list(value ORDER BY frame_idx) AS v FROM frames GROUP BY clip_id) SELECT clip_id, round(list_sum(v) * 3, 3) AS top FROM n")
def udf2_score_stub(spark, sf_dir):
    """UDF2-5: packed clips through an Arrow-batched scoring function."""
    from kinseq.plans.config import linear_scorer, score_batches

    rows = F.array_sort(F.collect_list(F.struct("frame_idx", "value")))
    packed = c.frames(spark, sf_dir).groupBy("clip_id").agg(F.transform(rows, lambda r: r["value"]).alias("v"))
    out = score_batches(packed, linear_scorer([1.0, 2.0, 3.0]), "clip_id long, logits array<double>")
    return out.select("clip_id", F.round(F.array_max("logits"), 3).alias("top"))


# --------------------------------------------------------------------------- chains and small operators


def _chain_sql() -> str:
    inner = _anchor_sql("no").replace("WITH ", "", 1).replace(", 6) AS", ", 12) AS")
    head, _, tail = inner.rpartition("\nSELECT ")
    return f"""WITH {head}, done AS (SELECT {tail}), n AS (SELECT clip_id, list("leftShoulder_x" ORDER BY frame_idx) AS s, list(nose_x ORDER BY frame_idx) AS x FROM done GROUP BY clip_id),
r AS (SELECT *, unnest(range(40)) AS i FROM n)
SELECT clip_id, CAST(i AS INTEGER) AS frame_idx, round(s[CAST(i % len(s) AS INTEGER) + 1] - 0.5, 5) AS sx, round(x[CAST(i % len(x) AS INTEGER) + 1] - 0.5, 5) AS nx FROM r"""


@query("udf1_transformer_chain", _chain_sql())
def udf1_transformer_chain(spark, sf_dir):
    """normalise_body -> normalise_hands -> pad -> shift in one plan."""
    from kinseq.plans.chains import transformer_steps
    from kinseq.plans.config import TransformOptions, run_chain

    options = TransformOptions(anchor="nose", neck_source="column", num_frames=40)
    out = run_chain(c.bodies(spark, sf_dir), transformer_steps(options, _MARKS, after="select_landmarks"))
    return out.select("clip_id", "frame_idx", F.round("leftShoulder.x", 5).alias("sx"), F.round("nose.x", 5).alias("nx"))


def _training_sql() -> str:
    """All four augmentations of each point, the drawn one taken; then the chain as before, and noise."""
    arms = _arm_sql()
    steps = arms[arms.index(f"{c.BODIES}, ") + len(c.BODIES) + 2 : arms.index(" SELECT clip_id, frame_idx, round(lsx")].replace("FROM bodies", "FROM held")
    marks = ("ls", "no", "el", "wr", "rs", "ne")
    r, t = f"radians(-4.0 + 8.0 * {_u('right0')})", f"{_u('right0p')} < 0.3"  # of the right arm only the shoulder is there
    steps += f", turned AS (SELECT * EXCLUDE (rsx, rsy), CASE WHEN {t} THEN nex + cos({r}) * (rsx - nex) - sin({r}) * (rsy - ney) ELSE rsx END AS rsx, CASE WHEN {t} THEN ney + sin({r}) * (rsx - nex) + cos({r}) * (rsy - ney) ELSE rsy END AS rsy FROM s2)"

    def new(p: str) -> str:
        x, y = f"o_{p}x", f"o_{p}y"
        r, left, right, m = f"radians(-13.0 + 26.0 * {_u('rotate')})", f"(0.15 * {_u('left')})", f"(0.15 * {_u('right')})", f"(0.1 * {_u('tilt')})"
        t, lf = f"(CASE WHEN {_u('side')} < 0.5 THEN 1 - {x} ELSE {x} END)", f"{_u('side')} < 0.5"
        a1, g1, d1 = f"((1 - {m}) / (1 - 2 * {m}))", f"(2 * {m} / (1 - 2 * {m}))", f"({m} / (1 - 2 * {m}))"
        nx, gone = f"({a1} * {t} / ({g1} * {t} + 1))", f"{x} = 0 AND {y} = 0"
        return (
            f"CASE pick WHEN 2 THEN {p}x WHEN 0 THEN 0.5 + cos({r}) * ({x} - 0.5) - sin({r}) * ({y} - 0.5) WHEN 1 THEN CASE WHEN {gone} THEN 0 ELSE {left} + (1 - {left} - {right}) * {x} END WHEN 3 THEN CASE WHEN {gone} THEN 0 WHEN {lf} THEN 1 - {nx} ELSE {nx} END ELSE {x} END AS {p}x, "
            f"CASE pick WHEN 2 THEN {p}y WHEN 0 THEN 0.5 + sin({r}) * ({x} - 0.5) + cos({r}) * ({y} - 0.5) WHEN 1 THEN {y} WHEN 3 THEN CASE WHEN {gone} THEN 0 ELSE ({d1} * {t} + {y}) / ({g1} * {t} + 1) END ELSE {y} END AS {p}y"
        )

    olds = ", ".join(f"{p}{a} AS o_{p}{a}" for p in marks for a in "xy")
    made = f"{c.BODIES.replace('bodies AS', 'plain AS')}, held AS (SELECT *, {olds}, CASE WHEN {_u('p')} < 0.5 THEN CAST(floor({_u('which')} * 4) AS INTEGER) END AS pick FROM plain), {steps}, bodies AS (SELECT clip_id, frame_idx, {', '.join(new(p) for p in marks)} FROM turned)"
    g = _anchor_sql("no")
    g = g[g.index(", g AS") : g.index("\nSELECT clip_id, frame_idx")]
    norm = lambda p, a: f"CASE WHEN h <> 0 AND {p}x <> 0 THEN ({p}{a} - a{a}) / h ELSE {p}{a} END"
    noise = lambda m: f"0.001 * sqrt(-2.0 * ln(1.0 - {_u('noiseu', chr(39).join(['clip_id || ', '/', ' || i || ', '/' + m, '']))})) * cos(6.283185307179586 * {_u('noisev', chr(39).join(['clip_id || ', '/', ' || i || ', '/' + m, '']))})"
    return f"""WITH {made}{g},
d AS (SELECT clip_id, frame_idx, {norm('ls', 'x')} AS sx, elx, {norm('wr', 'x')} AS wx FROM b),
n AS (SELECT clip_id, list(sx ORDER BY frame_idx) AS s, list(CASE WHEN wx <> 0 AND elx <> 0 THEN elx - wx ELSE elx END ORDER BY frame_idx) AS e FROM d GROUP BY clip_id),
r AS (SELECT *, unnest(range(40)) AS i FROM n)
SELECT clip_id, CAST(i AS INTEGER) AS frame_idx, round(s[CAST(i % len(s) AS INTEGER) + 1] - 0.5 + {noise('leftShoulderx')}, 5) AS sx, round(e[CAST(i % len(e) AS INTEGER) + 1] - 0.5 + {noise('leftElbowx')}, 5) AS ex FROM r"""


@query("udf1_training_chain", _training_sql())
def udf1_training_chain(spark, sf_dir):
    """The same with the augmentation that each clip draws, hands and noise."""
    from kinseq.plans.chains import transformer_steps
    from kinseq.plans.config import TransformOptions, run_chain

    options = TransformOptions(split="train", aug_prob=0.5, anchor="nose", neck_source="column", num_frames=40, gaussian_noise=True)
    out = run_chain(c.bodies(spark, sf_dir), transformer_steps(options, [*_MARKS, "leftWrist"], {"leftWrist": ["leftElbow"]}, after="select_landmarks"))
    return out.select("clip_id", "frame_idx", F.round("leftShoulder.x", 5).alias("sx"), F.round("leftElbow.x", 5).alias("ex"))


@query(
    "udf1_graph_chain",
    """WITH e AS (SELECT label AS clip_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS frame_idx, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT clip_id, list(v ORDER BY frame_idx) AS vs FROM e GROUP BY clip_id), r AS (SELECT *, unnest(range(30)) AS i FROM n),
p AS (SELECT clip_id, CAST(i AS INTEGER) AS frame_idx, vs[CAST(i % len(vs) AS INTEGER) + 1] AS v FROM r),
b AS (SELECT clip_id, frame_idx, v[1] AS j0, v[2] - v[1] AS j1, v[4] - v[2] AS j3 FROM p),
m AS (SELECT clip_id, frame_idx, coalesce(lead(j0) OVER w - j0, 0) AS j0, coalesce(lead(j1) OVER w - j1, 0) AS j1, coalesce(lead(j3) OVER w - j3, 0) AS j3 FROM b WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx))
SELECT clip_id, frame_idx, round(j0 - avg(j0) OVER c, 5) AS j0, round(j1 - avg(j0) OVER c, 5) AS j1, round(j3 - avg(j0) OVER c, 5) AS j3 FROM m WINDOW c AS (PARTITION BY clip_id)""",
)
def udf1_graph_chain(spark, sf_dir):
    """pad -> bones -> motion -> root_centre over packed joints (27 of each embedding's values, the layout's size)."""
    from kinseq.plans.chains import graph_steps
    from kinseq.plans.config import TransformOptions, run_chain

    at = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    e = c.read(spark, sf_dir, "embeddings").select(F.col("label").alias("clip_id"), at.alias("frame_idx"), F.transform(F.slice("embedding", 1, 27), lambda x: x.cast("double")).alias("v"))
    options = TransformOptions(model="graph", num_frames=30, bone_stream=True, motion_stream=True, bone_mode="true")
    out = run_chain(e, graph_steps(options, ("v",), after="select_joints"))
    return out.select("clip_id", "frame_idx", *[F.round(F.get("v", F.lit(i)), 5).alias(f"j{i}") for i in (0, 1, 3)])


_LONG_MARKS = {"NOSE": "no", "LEFT_SHOULDER": "ls", "RIGHT_SHOULDER": "rs", "LEFT_ELBOW": "el", "LEFT_WRIST": "wr"}
_COLUMN = {"NOSE": "nose", "LEFT_SHOULDER": "leftShoulder", "RIGHT_SHOULDER": "rightShoulder", "LEFT_ELBOW": "leftElbow", "LEFT_WRIST": "leftWrist"}
_FILLED = (
    c.BODIES.replace("bodies AS", "plain AS")
    + ", obs AS ("
    + " UNION ALL ".join(f"SELECT clip_id, frame_idx, '{m}' AS point, {p}x AS x, {p}y AS y, CASE WHEN lsx < CAST(0.02 AS DOUBLE) THEN CAST(0.3 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END AS conf FROM plain" for m, p in _LONG_MARKS.items())
    + """), m AS (SELECT *, (x = 0 AND y = 0) OR conf < CAST(0.5 AS DOUBLE) AS miss FROM obs),
near AS (SELECT *, last_value(CASE WHEN NOT miss THEN frame_idx END IGNORE NULLS) OVER a AS pi, last_value(CASE WHEN NOT miss THEN x END IGNORE NULLS) OVER a AS px, last_value(CASE WHEN NOT miss THEN y END IGNORE NULLS) OVER a AS py,
  first_value(CASE WHEN NOT miss THEN frame_idx END IGNORE NULLS) OVER b AS ni, first_value(CASE WHEN NOT miss THEN x END IGNORE NULLS) OVER b AS nx, first_value(CASE WHEN NOT miss THEN y END IGNORE NULLS) OVER b AS ny FROM m
  WINDOW a AS (PARTITION BY clip_id, point ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (PARTITION BY clip_id, point ORDER BY frame_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT clip_id, frame_idx, point, CASE WHEN miss THEN coalesce(px + (nx - px) * (frame_idx - pi) / CAST(ni - pi AS DOUBLE), px, nx, x) ELSE x END AS x, CASE WHEN miss THEN coalesce(py + (ny - py) * (frame_idx - pi) / CAST(ni - pi AS DOUBLE), py, ny, y) ELSE y END AS y FROM near)"""
)


def _long(spark, sf_dir) -> DataFrame:
    """(clip_id, frame_idx, component, point, x, y, conf): five body points of each frame, some unsure."""
    conf = F.when(F.col("leftShoulder.x") < 0.02, 0.3).otherwise(0.9)
    seen = [F.struct(F.lit(p).alias("point"), F.col(m)["x"].alias("x"), F.col(m)["y"].alias("y")) for p, m in _COLUMN.items()]
    rows = c.bodies(spark, sf_dir).select("clip_id", "frame_idx", conf.alias("conf"), F.explode(F.array(*seen)).alias("o"))
    return rows.select("clip_id", "frame_idx", F.lit("POSE_LANDMARKS").alias("component"), "o.point", "o.x", "o.y", "conf")


def _whole_transformer_sql() -> str:
    wide = ", ".join(f"max(CASE WHEN point = '{m}' THEN {a} END) AS {p}{a}" for m, p in _LONG_MARKS.items() for a in "xy")
    chain = _chain_sql()
    return f"WITH {_FILLED}, bodies AS (SELECT clip_id, frame_idx, CAST(0 AS DOUBLE) AS nex, CAST(0 AS DOUBLE) AS ney, {wide} FROM filled GROUP BY clip_id, frame_idx)" + chain[chain.index(", g AS") :]


@query("udf1_whole_transformer_chain", _whole_transformer_sql())
def udf1_whole_transformer_chain(spark, sf_dir):
    """extract -> interpolate -> select_landmarks -> normalise_body -> normalise_hands -> pad -> shift, all 54 landmarks."""
    from kinseq.plans.chains import transformer_steps
    from kinseq.plans.config import TransformOptions, run_chain

    out = run_chain(_long(spark, sf_dir), transformer_steps(TransformOptions(interpolate=True, anchor="nose", num_frames=40)))
    return out.select("clip_id", "frame_idx", F.round("leftShoulder.x", 5).alias("sx"), F.round("nose.x", 5).alias("nx"))


@query(
    "udf1_whole_graph_chain",
    f"""WITH {_FILLED}, a AS (SELECT *, {_AFFINE} FROM filled), moved AS (SELECT clip_id, frame_idx, point, {_AFFINE_XY} FROM a),
z AS (SELECT clip_id, frame_idx, point, coalesce((x - avg(x) OVER k) / nullif(stddev_pop(x) OVER k, 0), 0) AS x, coalesce((y - avg(y) OVER k) / nullif(stddev_pop(y) OVER k, 0), 0) AS y FROM moved WINDOW k AS (PARTITION BY clip_id, point)),
j AS (SELECT clip_id, frame_idx, max(CASE WHEN point = 'NOSE' THEN x END) AS j0, max(CASE WHEN point = 'LEFT_SHOULDER' THEN x END) AS j1, max(CASE WHEN point = 'LEFT_ELBOW' THEN y END) AS e, max(CASE WHEN point = 'LEFT_SHOULDER' THEN y END) AS s FROM z GROUP BY clip_id, frame_idx),
n AS (SELECT clip_id, list(j0 ORDER BY frame_idx) AS v0, list(j1 - j0 ORDER BY frame_idx) AS v1, list(e - s ORDER BY frame_idx) AS v3, list(0 ORDER BY frame_idx) AS none, any_value(0) AS q FROM j GROUP BY clip_id),
ny AS (SELECT clip_id, list(y ORDER BY frame_idx) AS y0 FROM z WHERE point = 'NOSE' GROUP BY clip_id),
r AS (SELECT *, unnest(range(30)) AS i FROM n JOIN ny USING (clip_id)),
p AS (SELECT clip_id, i, v0[CAST(i % len(v0) AS INTEGER) + 1] AS j0, v1[CAST(i % len(v0) AS INTEGER) + 1] AS j1, v3[CAST(i % len(v0) AS INTEGER) + 1] AS j3, y0[CAST(i % len(v0) AS INTEGER) + 1] AS r3 FROM r),
d AS (SELECT clip_id, i, coalesce(lead(j0) OVER w - j0, 0) AS j0, coalesce(lead(j1) OVER w - j1, 0) AS j1, coalesce(lead(j3) OVER w - j3, 0) AS j3, coalesce(lead(r3) OVER w - r3, 0) AS r3 FROM p WINDOW w AS (PARTITION BY clip_id ORDER BY i)),
f AS (SELECT clip_id, CAST(i AS INTEGER) AS frame_idx, round(j0 - avg(j0) OVER c, 5) AS j0, round(j1 - avg(j0) OVER c, 5) AS j1, round(j3 - avg(r3) OVER c, 5) AS j3 FROM d WINDOW c AS (PARTITION BY clip_id))
SELECT clip_id, frame_idx, CASE WHEN j0 <> 0 THEN j0 ELSE 0 END AS j0, CASE WHEN j1 <> 0 THEN j1 ELSE 0 END AS j1, CASE WHEN j3 <> 0 THEN j3 ELSE 0 END AS j3 FROM f""",
)
def udf1_whole_graph_chain(spark, sf_dir):
    """extract -> interpolate -> affine -> select_joints -> pad -> bones -> motion -> root_centre, all 27 joints."""
    from kinseq.plans.chains import graph_steps
    from kinseq.plans.config import TransformOptions, run_chain

    options = TransformOptions(model="graph", split="train", interpolate=True, aug_prob=0.5, num_frames=30, bone_stream=True, motion_stream=True, bone_mode="true")
    out = run_chain(_long(spark, sf_dir), graph_steps(options))
    plain = lambda c, i: F.when(F.round(F.get(c, F.lit(i)), 5) != 0, F.round(F.get(c, F.lit(i)), 5)).otherwise(0.0)  # noqa: E731  # no -0.0
    return out.select("clip_id", "frame_idx", plain("x", 0).alias("j0"), plain("x", 1).alias("j1"), plain("y", 3).alias("j3"))


@query("flt9_detected", f"WITH {c.FRAMES} SELECT clip_id, frame_idx FROM frames WHERE vis >= CAST(0.4 AS DOUBLE)")
def flt9_detected(spark, sf_dir):
    from kinseq.sources.readers import detected

    f = c.frames(spark, sf_dir).withColumn("pose", F.when(F.col("vis") >= 0.4, F.col("value")))
    return detected(f).select("clip_id", "frame_idx")


def _components(spark, sf_dir) -> DataFrame:
    p = c.read(spark, sf_dir, "part")
    kinds = F.array(*[F.lit(k) for k in ("POSE_LANDMARKS", "FACE_LANDMARKS", "POSE_WORLD_LANDMARKS", "LEFT_HAND_LANDMARKS")])
    return p.select("p_partkey", F.get(kinds, (F.col("p_partkey") % 4).cast("int")).alias("component"), F.col("p_size").cast("string").alias("point"))


_COMPONENTS = "SELECT p_partkey, (['POSE_LANDMARKS', 'FACE_LANDMARKS', 'POSE_WORLD_LANDMARKS', 'LEFT_HAND_LANDMARKS'])[p_partkey % 4 + 1] AS component, CAST(p_size AS VARCHAR) AS point FROM part"


@query("flt10_component_pruning", f"SELECT * FROM ({_COMPONENTS}) WHERE component <> 'POSE_WORLD_LANDMARKS' AND (component <> 'FACE_LANDMARKS' OR point IN ('0', '13', '14', '17', '33', '37'))")
def flt10_component_pruning(spark, sf_dir):
    return sk.drop_components(_components(spark, sf_dir), keep_face=True)


@query("mth12_select_landmarks", "SELECT s_suppkey, CAST(i AS INTEGER) AS joint FROM supplier, range(54) r(i) WHERE i <> 1 AND (s_suppkey % 2 = 0 OR i < 12)")
def mth12_select_landmarks(spark, sf_dir):
    """The 54-landmark layout from long observations (the neck, number 1, is never observed)."""
    points = [(a, b) for a, b in sk.landmark_points() if b != "NECK"]
    seen = spark.createDataFrame([*points, ("FACE_LANDMARKS", "70")], "component string, point string")
    keep = (F.col("s_suppkey") % 2 == 0) | (F.col("component") == "POSE_LANDMARKS")
    obs = c.read(spark, sf_dir, "supplier").select("s_suppkey").join(F.broadcast(seen)).filter(keep)
    return sk.select_points(obs, sk.landmark_points()).select("s_suppkey", "joint")


@query("map1_inverse", f"WITH {c.CLIPS} SELECT gloss_id % 3 AS gloss_id, max(gloss) AS gloss FROM vocab GROUP BY 1")
def map1_inverse(spark, sf_dir):
    v = md.vocabulary(c.clips(spark, sf_dir))
    return md.inverse(v.withColumn("gloss_id", F.col("gloss_id") % 3))


@query("set4_right_wins", "SELECT coalesce(b.c_custkey, a.o_custkey) AS k, coalesce(b.c_name, 'left') AS v FROM (SELECT DISTINCT o_custkey FROM orders) a FULL JOIN customer b ON a.o_custkey = b.c_custkey")
def set4_right_wins(spark, sf_dir):
    """SET4: two keyed maps merged, the right one's value where both have a key."""
    left = c.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("v", F.lit("left"))
    right = c.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return left.join(right.withColumnRenamed("v", "r"), "k", "full").select("k", F.coalesce("r", "v").alias("v"))


@query("srt1_sorted_listing", f"WITH {c.CLIPS} SELECT video, CAST(row_number() OVER (ORDER BY video DESC) AS INTEGER) AS place FROM (SELECT DISTINCT cam || '/' || gloss || '.mp4' AS video FROM clips)")
def srt1_sorted_listing(spark, sf_dir):
    listing = c.clips(spark, sf_dir).select(F.concat_ws("/", "cam", F.format_string("%s.mp4", "gloss")).alias("video")).distinct()
    return listing.withColumn("place", F.row_number().over(Window.orderBy(F.desc("video"))))


@query("str2_log_line", "SELECT event_id, printf('[%.2f] %s: %.6f', value, event_type, value / 1000) AS line FROM events")
def str2_log_line(spark, sf_dir):
    return c.read(spark, sf_dir, "events").select("event_id", F.format_string("[%.2f] %s: %.6f", F.col("value"), F.col("event_type"), F.col("value") / 1000.0).alias("line"))


@query("snk3_metadata_json", f"WITH {c.CLIPS} SELECT cam, video_id, signer_id, gloss FROM clips")
def snk3_metadata_json(spark, sf_dir):
    """SRC1, SNK3: metadata through JSON, a folder a camera."""
    from kinseq.sources import writers

    path = _root(spark)
    writers.write_metadata(c.clips(spark, sf_dir).select("cam", "video_id", "signer_id", "gloss"), path)
    return spark.read.schema("video_id string, signer_id string, gloss string, cam string").json(path)


@query("snk5_evaluation", f"WITH {_MACRO} SELECT round(avg(pr), 6) AS precision, round(avg(re), 6) AS recall, (SELECT count(*) FROM pred) AS n FROM each")
def snk5_evaluation(spark, sf_dir):
    from kinseq.sources import writers

    path, pred = _root(spark), _predicted(spark, sf_dir)
    writers.write_evaluation(mt.macro_scores(pred), pred.select("clip_id", "label", "pred"), path)
    n = spark.read.parquet(f"{path}/predictions").agg(F.count("*").alias("n"))
    return spark.read.schema("precision double, recall double, f1 double").json(f"{path}/metrics").join(F.broadcast(n)).select(*r6("precision", "recall"), "n")


@query("jsn1_state_json", "SELECT event_id, user_id, event_type FROM events")
def jsn1_state_json(spark, sf_dir):
    """JSN1, SNK10: to JSON and back."""
    from kinseq.sources.writers import state_json

    rows = state_json(c.read(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))
    return rows.select(F.from_json("value", "event_id long, user_id long, event_type string").alias("r")).select("r.*")
