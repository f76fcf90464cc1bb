"""Temporal segmentation: the debounced batch automaton as islands and a fold over its few events,
and the live automaton as a fold over runs of equal frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hand_class(angle: Column, visibility: Column, theta: float, visible: float = 0.6) -> Column:
    """U (raised), D (lowered or unseen) or null for the neutral equalities."""
    up = (angle < theta) & (visibility > visible)
    down = ((angle > theta) & (visibility > visible)) | (visibility < visible)
    return F.when(up, "U").when(down, "D")


def confirmations(frames: DataFrame, keys: list[str], order: str, time: str, state: str, min_up: int, min_down: int, delay: float) -> DataFrame:
    """SEG1, WIN8: (keys, order, kind, bound): when a hand is confirmed up or down, and the time that bounds the sign.

    Neutral frames are dropped; of each run of equal classes the (N+1)-th frame is a candidate;
    a candidate counts if its class differs from the one that counted before it (down at first).
    """
    if min_up < 1 or min_down < 1:
        raise ValueError("confirmation needs at least one earlier frame")
    w = Window.partitionBy(*keys).orderBy(order)
    real = frames.filter(F.col(state).isNotNull()).withColumn("_new", (F.col(state) != F.coalesce(F.lag(state).over(w), F.lit(""))).cast("int"))
    runs = real.withColumn("_run", F.sum("_new").over(w))
    in_run = Window.partitionBy(*keys, "_run").orderBy(order)
    placed = runs.withColumn("_n", F.row_number().over(in_run)).withColumn("_t0", F.first(time).over(in_run))
    need = F.when(F.col(state) == "U", F.lit(min_up)).otherwise(F.lit(min_down)) + 1
    kept = placed.filter(F.col("_n") == need)
    kept = kept.withColumn("_before", F.coalesce(F.lag(state).over(w), F.lit("D"))).filter(F.col(state) != F.col("_before"))
    bound = F.when(F.col(state) == "U", F.col("_t0") - delay).otherwise(F.col("_t0") + delay)
    return kept.select(*keys, order, F.col(state).alias("kind"), bound.alias("bound"))


def single_hand_segments(confirmed: DataFrame, keys: list[str], order: str, sentinel: bool = False) -> DataFrame:
    """(keys, seg_idx, start_s, end_s): each up with the down after it; an open one is dropped.

    ``sentinel`` keeps the reading of a bound of exactly 0 as unset: such a start is not emitted.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    paired = confirmed.withColumn("_end", F.lead("bound").over(w)).filter((F.col("kind") == "U") & F.col("_end").isNotNull())
    if sentinel:
        paired = paired.filter((F.col("bound") != 0) & (F.col("_end") != 0))
    return paired.select(*keys, (F.row_number().over(w) - 1).alias("seg_idx"), (F.col("bound") / 1000).alias("start_s"), (F.col("_end") / 1000).alias("end_s"))


def merge_hands(confirmed: DataFrame, keys: list[str], order: str, hand: str = "hand", sentinel: bool = True) -> DataFrame:
    """SEG1 for two hands: a fold over the confirmation events of a clip (few, not its frames).

    After the events of a frame: the left hand's bounds if they are complete and the right has no
    start; else the right's, vice versa; else both, if complete and both hands are down
    (AGG12: least start, greatest end).  Emission clears bounds, not the hands' states.
    """
    event = F.struct(F.col(order).alias("at"), (F.col(hand) == "right").alias("right"), (F.col("kind") == "U").alias("up"), F.col("bound"))
    events = confirmed.groupBy(*keys).agg(F.array_sort(F.collect_list(event)).alias("e"))
    none = F.lit(None).cast("double")
    start = F.struct(
        none.alias("ls"), none.alias("le"), F.lit(False).alias("lu"), none.alias("rs"), none.alias("re"), F.lit(False).alias("ru"),
        F.array().cast("array<struct<s:double,t:double>>").alias("out"),
    )

    def unset(x: Column) -> Column:
        return F.when(x != 0, x) if sentinel else x

    def step(a: Column, i: Column) -> Column:
        e = F.get("e", i)
        hold = lambda mine, new, old: F.when(mine, new).otherwise(old)
        left, right = ~e["right"], e["right"]
        ls, le = hold(left & e["up"], unset(e["bound"]), a["ls"]), hold(left & ~e["up"], unset(e["bound"]), a["le"])
        rs, re_ = hold(right & e["up"], unset(e["bound"]), a["rs"]), hold(right & ~e["up"], unset(e["bound"]), a["re"])
        lu, ru = hold(left, e["up"], a["lu"]), hold(right, e["up"], a["ru"])
        last = F.coalesce(F.get("e", i + 1)["at"] != e["at"], F.lit(True))  # all events of a frame come first
        l_ok, r_ok = ls.isNotNull() & le.isNotNull(), rs.isNotNull() & re_.isNotNull()
        both = l_ok & r_ok & ~lu & ~ru
        s = F.when(l_ok & rs.isNull(), ls).when(r_ok & ls.isNull(), rs).when(both, F.least(ls, rs))
        t = F.when(l_ok & rs.isNull(), le).when(r_ok & ls.isNull(), re_).when(both, F.greatest(le, re_))
        emit = last & s.isNotNull() & ((s != 0) & (t != 0) if sentinel else F.lit(True))
        out = F.when(emit, F.concat(a["out"], F.array(F.struct(s.alias("s"), t.alias("t"))))).otherwise(a["out"])
        clear = lambda x: F.when(~emit, x)
        return F.struct(clear(ls).alias("ls"), clear(le).alias("le"), lu.alias("lu"), clear(rs).alias("rs"), clear(re_).alias("re"), ru.alias("ru"), out.alias("out"))

    folded = events.select(*keys, F.aggregate(F.sequence(F.lit(0), F.size("e") - 1), start, step)["out"].alias("out"))
    return folded.select(*keys, F.posexplode("out").alias("seg_idx", "x")).select(*keys, "seg_idx", (F.col("x.s") / 1000).alias("start_s"), (F.col("x.t") / 1000).alias("end_s"))


def at_least(segments: DataFrame, seconds: float = 0.67) -> DataFrame:
    """SEG4 (documented elsewhere, off by default): segments of a least duration."""
    return segments.filter(F.col("end_s") - F.col("start_s") >= seconds)


def frames_of_segments(frames: DataFrame, segments: DataFrame, key: str, fps: float, bucket: int = 256) -> DataFrame:
    """JN7, MTH16: inclusive frame ranges int(start * fps)..int(end * fps).

    The clip and a bucket of frame numbers are equi keys, so long clips spread over tasks and
    no nested loop arises.
    """
    first, last = (F.col("start_s") * fps).cast("int"), (F.col("end_s") * fps).cast("int")
    spans = segments.withColumns({"_a": first, "_b": last}).filter("_a <= _b")
    spans = spans.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("_a") / bucket), F.floor(F.col("_b") / bucket))))
    keyed = frames.withColumn("_bucket", F.floor(F.col("frame_idx") / bucket))
    return keyed.join(spans, [key, "_bucket"]).filter("frame_idx between _a and _b").drop("_bucket", "_a", "_b")


_ARM = "struct<raised:boolean,n:int,since:double,up:boolean,start:double,end:double>"
_FRESH = {"raised": False, "n": 0, "since": 0.0, "up": False, "start": 0.0, "end": 0.0}
LIVE_SCHEMA = "clip_id long, seg_idx int, start_s double, end_s double, n_frames int, first_frame int, last_frame int"


@dataclass(frozen=True)
class LiveRule:
    """SEG2's parameters: an angle strictly between 0 and ``theta`` is raised; a run of more than
    ``min_up`` (``min_down``) raised (lowered) frames raises (lowers) the arm; ``delay`` in ms widens a sign;
    ``strict_down`` keeps an arm that is still up from closing its sign."""

    theta: float = 140
    min_up: int = 10
    min_down: int = 10
    delay: float = 400
    strict_down: bool = False

    def __post_init__(self) -> None:
        if min(self.min_up, self.min_down) < 1:
            raise ValueError("at least one earlier frame is needed")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fresh(kind: str, values: dict) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()]).cast(kind)


def _arm_next(arm: Column, seen: Column, t: Column, rule: LiveRule) -> Column:
    """An arm after a frame: its run of equal frames, whether it is up, and its bounds so far.

    Bounds hold from a run's first frame on: a run that may raise the arm starts a sign, one that may
    lower it ends it; a lowered frame unsets the start of an arm that is down, a raised one the
    end of an arm that is up.  WIN4: an angle that could not be measured keeps the class before it."""
    raised = F.coalesce(seen, arm["raised"])
    on = (raised == arm["raised"]) & (arm["n"] > 0)
    run = F.struct(raised.alias("raised"), F.when(on, arm["n"] + 1).otherwise(1).alias("n"), F.when(on, arm["since"]).otherwise(t).alias("since"))

    def settled(r: Column) -> Column:
        turns = (r["raised"] != arm["up"]) & (r["n"] == F.when(r["raised"], rule.min_up).otherwise(rule.min_down) + 1)
        start = F.when(arm["up"], arm["start"]).when(r["raised"], r["since"] - rule.delay).otherwise(0.0)
        end = F.when(~arm["up"], arm["end"]).when(r["raised"], 0.0).otherwise(r["since"] + rule.delay)
        return F.struct(r["raised"], r["n"], r["since"], (arm["up"] != turns).alias("up"), start.alias("start"), end.alias("end")).cast(_ARM)

    return _bind(run, settled)


def _closing(a: Column, b: Column, rule: LiveRule) -> Column:
    """(s, t) of the sign that closes: one arm's bounds where the other has no start, else the hull of
    both once both are down; null fields if none does."""
    whole = [(x["start"] > 0) & (x["end"] > 0) & ~(x["up"] & F.lit(rule.strict_down)) for x in (a, b)]
    cases = [(whole[0] & (b["start"] == 0), a["start"], a["end"]), (whole[1] & (a["start"] == 0), b["start"], b["end"]),
             (whole[0] & whole[1] & ~a["up"] & ~b["up"], F.least(a["start"], b["start"]), F.greatest(a["end"], b["end"]))]
    s, t = F.lit(None).cast("double"), F.lit(None).cast("double")
    for holds, lo, hi in cases:  # no two hold at once
        s, t = F.when(holds, lo).otherwise(s), F.when(holds, hi).otherwise(t)
    return F.struct(s.alias("s"), t.alias("t"))


_SPANS = "array<struct<a:int,b:int>>"
_SIGNS = f"array<struct<s:double,t:double,n:int,spans:{_SPANS}>>"


def live_signs(frames: DataFrame, **options) -> DataFrame:
    """SEG2, SEG3: (clip_id, seg_idx, start_s, end_s, n_frames, spans) over (clip_id, frame_idx, t_ms, left_angle, right_angle).

    A fold over a clip's frames in order, in expressions alone.  The buffer of frames at which an arm
    is up is kept as spans of neighbouring frames, so it does not grow with a sign's length.  A sign
    needs a buffered frame; when it closes, arms and buffer start anew.  Nothing is flushed at the end."""
    rule = LiveRule(**options)
    seen = lambda c: ((F.col(c) > 0) & (F.col(c) < rule.theta)).alias(c)
    frame = F.struct(F.col("frame_idx").cast("int").alias("frame_idx"), F.col("t_ms").cast("double").alias("t"), seen("left_angle"), seen("right_angle"))
    clips = frames.groupBy("clip_id").agg(F.array_sort(F.collect_list(frame)).alias("f"))
    arm, spans = _fresh(_ARM, _FRESH), F.array().cast(_SPANS)
    nothing = [arm.alias("l"), arm.alias("r"), F.lit(False).alias("on"), F.lit(0).alias("n"), spans.alias("spans")]

    def step(state: Column, f: Column) -> Column:
        def placed(x: Column) -> Column:
            on = x["l"]["up"] | x["r"]["up"]
            last, size = F.get(state["spans"], F.size(state["spans"]) - 1), F.size(state["spans"])
            longer = F.concat(F.slice(state["spans"], F.lit(1), size - 1), F.array(F.struct(last["a"].alias("a"), f["frame_idx"].alias("b"))))
            another = F.concat(state["spans"], F.array(F.struct(f["frame_idx"].alias("a"), f["frame_idx"].alias("b"))))
            kept = F.when(on & state["on"], longer).when(on, another).otherwise(state["spans"])
            buffer = F.struct(on.alias("on"), (state["n"] + on.cast("int")).alias("n"), kept.alias("spans"), _closing(x["l"], x["r"], rule).alias("sign"))
            return _bind(buffer, lambda y: after(x, y))

        def after(x: Column, y: Column) -> Column:
            done = y["sign"]["s"].isNotNull() & (y["n"] > 0)
            sign = F.struct(y["sign"]["s"].alias("s"), y["sign"]["t"].alias("t"), y["n"].alias("n"), y["spans"].alias("spans"))
            anew = F.struct(*nothing, F.concat(state["out"], F.array(sign)).alias("out"))
            return F.when(done, anew).otherwise(F.struct(x["l"].alias("l"), x["r"].alias("r"), y["on"].alias("on"), y["n"].alias("n"), y["spans"].alias("spans"), state["out"].alias("out")))

        arms = F.struct(_arm_next(state["l"], f["left_angle"], f["t"], rule).alias("l"), _arm_next(state["r"], f["right_angle"], f["t"], rule).alias("r"))
        return _bind(arms, placed)

    folded = clips.select("clip_id", F.aggregate("f", F.struct(*nothing, F.array().cast(_SIGNS).alias("out")), step)["out"].alias("out"))
    one = folded.select("clip_id", F.posexplode("out").alias("seg_idx", "x"))
    return one.select("clip_id", "seg_idx", (F.col("x.s") / 1000).alias("start_s"), (F.col("x.t") / 1000).alias("end_s"), F.col("x.n").alias("n_frames"), F.col("x.spans").alias("spans"))


def live_segments(frames: DataFrame, **options) -> DataFrame:
    """SEG2: the signs, in ``LIVE_SCHEMA``."""
    s = live_signs(frames, **options)
    ends = [F.get("spans", F.lit(0))["a"].alias("first_frame"), F.get("spans", F.size("spans") - 1)["b"].alias("last_frame")]
    return s.select("clip_id", "seg_idx", "start_s", "end_s", "n_frames", *ends)


def live_clip_frames(frames: DataFrame, bucket: int = 256, **options) -> DataFrame:
    """SEG3: the frames of each sign's buffer, with their ``seg_idx``; a join on clip and bucket of frames."""
    s = live_signs(frames, **options).select("clip_id", "seg_idx", F.explode("spans").alias("x")).select("clip_id", "seg_idx", "x.a", "x.b")
    s = s.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("a") / bucket), F.floor(F.col("b") / bucket))))
    keyed = frames.withColumn("_bucket", F.floor(F.col("frame_idx") / bucket))
    return keyed.join(s, ["clip_id", "_bucket"]).filter("frame_idx between a and b").drop("_bucket", "a", "b")
