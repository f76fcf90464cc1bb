"""Hand-computed cases and properties of the core operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kinseq.functions import geometry as g
from kinseq.functions import names
from kinseq.operators import metadata as md
from kinseq.operators import metrics as mt
from kinseq.operators import normalise as nm
from kinseq.operators import segment as sg
from kinseq.operators import sequence as sq
from kinseq.operators import skeleton as sk


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("p, want", [((0, 1, 0, 0, 1, 0), 90.0), ((-1, -0.1, 0, 0, -1, 0.1), 11.421186)])
def test_angle(spark, p, want):
    got = spark.range(1).select(g.joint_angle(*[F.lit(float(v)) for v in p])).first()[0]
    assert got == pytest.approx(want, abs=1e-5)


def test_interpolation(spark):
    data = [(1, i, x, x, c) for i, (x, c) in enumerate([(0.0, 1.0), (10.0, 0.9), (0.0, 1.0), (20.0, 0.5), (7.0, 0.4)])] + [(2, 0, 0.0, 0.0, 0.1), (2, 1, 5.0, 5.0, 0.2)]
    out = sq.interpolate(frame(spark, data, "k int, i int, x double, y double, conf double"), ["k"], "i", ["x", "y"], "conf").orderBy("k", "i")
    assert rows(out.filter("k = 1"), "x") == [(10,), (10,), (15,), (20,), (20,)]
    assert rows(out.filter("k = 1"), "conf") == [(0.5,), (0.9,), (0.5,), (0.5,), (0.5,)]
    assert rows(out.filter("k = 2"), "x", "conf") == [(0.0, 0.1), (5.0, 0.2)]


@pytest.mark.parametrize("given, n, want", [("abc", 7, "abcabca"), ("abcde", 3, "abc"), ("", 3, None)])
def test_pad(spark, given, n, want):
    df = frame(spark, [(list(given),)], "v array<string>")
    got = df.select(sq.pad_array(F.col("v"), n)).first()[0]
    assert (None if got is None else "".join(got)) == want
    if given:
        long = frame(spark, [(1, i, c) for i, c in enumerate(given)], "k int, i int, c string")
        assert "".join(r.c for r in sq.pad_frames(long, ["k"], "i", n).orderBy("i").collect()) == want


def test_motion_and_sampling(spark):
    df = frame(spark, [(1, i, float(x)) for i, x in enumerate([1, 4, 9])], "k int, i int, x double")
    assert rows(sq.motion(df, ["k"], "i", ["x"]).orderBy("i"), "x") == [(3,), (5,), (0,)]
    got = frame(spark, [(5,), (0,), (1,)], "l int").select(sq.even_sample(F.col("l"), 3).alias("s"))
    assert rows(got, "s") == [([0, 2, 4],), ([],), ([0],)]


def states(spark, pattern, first=0):
    data, i = [], 0
    for n, s in pattern:
        for _ in range(n):
            data.append((1, i, 40.0 * i, s))
            i += 1
    return frame(spark, data, "clip int, frame_idx int, t double, st string")


def cut(spark, pattern, n=2, sentinel=False):
    c = sg.confirmations(states(spark, pattern), ["clip"], "frame_idx", "t", "st", n, n, 400.0)
    return [(round(a, 3), round(b, 3)) for a, b in rows(sg.single_hand_segments(c, ["clip"], "frame_idx", sentinel).orderBy("seg_idx"), "start_s", "end_s")]


def test_batch_segments(spark):
    assert cut(spark, [(11, "D"), (6, "U"), (8, "D"), (6, "U"), (29, "D")]) == [(0.04, 1.08), (0.6, 1.64)]
    assert cut(spark, [(10, "D"), (2, "U"), (20, "D")]) == []
    assert cut(spark, [(10, "D"), (9, "U")]) == []
    assert cut(spark, [(11, "D"), (2, "U"), (1, None), (4, "U"), (8, "D")]) == cut(spark, [(11, "D"), (2, "U"), (1, None), (4, "U"), (9, "D")]) == [(0.04, 1.12)]
    with pytest.raises(ValueError):
        sg.confirmations(states(spark, [(1, "D")]), ["clip"], "frame_idx", "t", "st", 0, 1, 0.0)


class Hand:
    """A frame-by-frame automaton, the definition the islands are held against."""

    def __init__(self):
        self.up, self.n, self.first, self.start, self.end = False, 0, 0.0, 0.0, 0.0

    def see(self, s, t, need, delay):
        if s is None:
            return
        if (s == "U") == self.up:
            self.n = 0
            return
        if self.n == 0:
            self.first = t - delay if s == "U" else t + delay
        if self.n == need[s]:
            self.up, self.n = s == "U", 0
            if self.up:
                self.start = self.first
            else:
                self.end = self.first
        else:
            self.n += 1


def brute(trace, need, delay):
    left, right, out = Hand(), Hand(), []
    for i, (a, b) in enumerate(trace):
        left.see(a, 40.0 * i, need, delay)
        right.see(b, 40.0 * i, need, delay)
        s = t = 0
        if left.start and left.end and not right.start:
            s, t = left.start, left.end
        elif right.start and right.end and not left.start:
            s, t = right.start, right.end
        elif left.start and left.end and right.start and right.end and not left.up and not right.up:
            s, t = min(left.start, right.start), max(left.end, right.end)
        if s and t:
            out.append((round(s / 1000, 4), round(t / 1000, 4)))
            left.start = left.end = right.start = right.end = 0.0
    return out


def test_two_hands_equal_the_automaton(spark):
    rng = random.Random(3)
    traces = {}
    for k in range(120):
        hold = [rng.choice("UD"), rng.choice("UD")]
        trace = []
        for _ in range(rng.randint(5, 60)):
            for h in (0, 1):
                hold[h] = rng.choice(["U", "D", None]) if rng.random() < 0.3 else hold[h]
            trace.append(tuple(hold))
        traces[k] = trace
    data = [(k, h, i, 40.0 * i, t[j]) for k, trace in traces.items() for i, t in enumerate(trace) for j, h in enumerate(("left", "right"))]
    f = frame(spark, data, "clip int, hand string, frame_idx int, t double, st string")
    c = sg.confirmations(f, ["clip", "hand"], "frame_idx", "t", "st", 2, 1, 400.0)
    got = {}
    for k, s, t in rows(sg.merge_hands(c, ["clip"], "frame_idx").orderBy("clip", "seg_idx"), "clip", "start_s", "end_s"):
        got.setdefault(k, []).append((round(s, 4), round(t, 4)))
    for k, trace in traces.items():
        assert got.get(k, []) == brute(trace, {"U": 2, "D": 1}, 400.0), (k, trace)


def test_sentinel(spark):
    """A start of exactly 0 reads as unset: its end pairs with the next start."""
    c = sg.confirmations(states(spark, [(10, "D"), (6, "U"), (8, "D"), (6, "U"), (30, "D")]).withColumn("hand", F.lit("left")), ["clip", "hand"], "frame_idx", "t", "st", 2, 2, 400.0)
    merged = rows(sg.merge_hands(c, ["clip"], "frame_idx"), "start_s", "end_s")
    assert [(round(a, 3), round(b, 3)) for a, b in merged] == [(0.56, 1.04)]
    assert len(rows(sg.merge_hands(c, ["clip"], "frame_idx", sentinel=False), "start_s")) == 2


@pytest.mark.parametrize(
    "left, right, at, bounds, buffered",
    [(range(10), (), 10, (0.9, 1.5), 8), (range(10), range(10), 13, (0.9, 1.5), 10), (range(10), range(2, 11), 14, (0.98, 1.54), None)],
)
def test_live_traces(spark, left, right, at, bounds, buffered):
    data = [(1, i, 1000 + 40.0 * i, 90.0 if i in left else 170.0, 90.0 if i in right else 170.0) for i in range(40)]
    f = frame(spark, data, "clip_id long, frame_idx int, t_ms double, left_angle double, right_angle double")
    options = {"theta": 140, "min_up": 3, "min_down": 3, "delay": 100}
    assert sg.live_segments(f.filter(F.col("frame_idx") < at), **options).count() == 0
    (got,) = sg.live_segments(f.filter(F.col("frame_idx") <= at), **options).collect()
    assert (got.start_s, got.end_s) == pytest.approx(bounds) and (buffered is None or got.n_frames == buffered)
    kept = sg.live_clip_frames(f.filter(F.col("frame_idx") <= at), **options)
    assert sorted(r.frame_idx for r in kept.collect())[:: got.n_frames - 1] == [got.first_frame, got.last_frame] and kept.count() == got.n_frames


def test_stream_equals_batch_under_any_cut(spark, tmp_path):
    from kinseq.streaming.live import live_stream, run_available

    rng, data = random.Random(5), []
    for clip in range(4):
        angle = 170.0
        for i in range(80):
            angle = rng.choice([60.0, 170.0]) if rng.random() < 0.15 else angle
            data.append((clip, i, 1000 + 40.0 * i, angle if rng.random() < 0.9 else None, 170.0))
    schema = "clip_id long, frame_idx int, t_ms double, left_angle double, right_angle double"
    options = {"theta": 140, "min_up": 2, "min_down": 2, "delay": 100}
    want = sorted(map(tuple, sg.live_segments(frame(spark, data, schema), **options).collect()))
    assert want
    cuts = [0, 13, 14, 50, 80]
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        frame(spark, [d for d in data if a <= d[1] < b], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k:02d}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    got = run_available(live_stream(stream, **options), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, got.collect())) == want


def test_range_join(spark):
    f = frame(spark, [(1, i) for i in range(600)], "clip_id int, frame_idx int")
    s = frame(spark, [(1, 0, 0.04, 0.2), (1, 1, -0.05, 0.0), (1, 2, 10.0, 21.0)], "clip_id int, seg_idx int, start_s double, end_s double")
    out = sg.frames_of_segments(f, s, "clip_id", 25.0)
    assert sorted(r.frame_idx for r in out.filter("seg_idx = 0").collect()) == [1, 2, 3, 4, 5]
    assert [r.frame_idx for r in out.filter("seg_idx = 1").collect()] == [0]
    assert out.filter("seg_idx = 2").count() == 526 - 250


def body(spark, data):
    cols = ["leftShoulder", "rightShoulder", "neck", "nose", "leftEye", "leftElbow"]
    df = frame(spark, [(1, i, *[v for p in d for v in p]) for i, d in enumerate(data)], "k int, i int, " + ", ".join(f"{c}_{a} double" for c in cols for a in "xy"))
    return df.select("k", "i", *[nm.point(F.col(c + "_x"), F.col(c + "_y")).alias(c) for c in cols])


def test_body_normaliser(spark):
    one = ((0.0001, 1.0), (2.0001, 1.0), (1.0, 1.0), (0.0, 0.0), (0.5, 0.3), (3.0, 2.0))
    blind = ((0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.5, 0.3), (3.0, 2.0))
    df = body(spark, [blind, one, blind])
    get = lambda **o: rows(nm.body_normalise(df, ["k"], "i", ["leftElbow"], **o).orderBy("i"), "leftElbow")
    got = [tuple(x[0]) for x in get(anchor="neck", neck_source="column")]
    assert got[0] == (3.0, 2.0) and got[1] == pytest.approx((1.0, 0.5)) and got[2] == pytest.approx((1.0, 0.5))
    assert [tuple(x[0]) for x in get(anchor="neck")] == [(3.0, 2.0)] * 3
    clamped = ((1.0, 0.0), (1.2, 0.0), (0.0, 0.0), (0.0, 0.0), (0.5, 0.3), (0.3, 0.25))
    x, y = rows(nm.body_normalise(body(spark, [clamped]), ["k"], "i", ["leftElbow"], "box", "column"), "leftElbow")[0][0]
    assert (x, y) == pytest.approx((0.3 / 0.6, 0.25 / 0.5))


def test_hand_normaliser(spark):
    df = body(spark, [((2.0, 3.0), (5.0, 7.0), (0.0, 4.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0))])
    out = nm.hand_normalise(df, "leftShoulder", ["rightShoulder", "neck"]).first()
    assert tuple(out.rightShoulder) == (3.0, 4.0) and tuple(out.neck) == (0.0, 4.0)


def test_top_k_and_metrics(spark):
    df = frame(spark, [([1.0, 3.0, 2.0],)], "l array<double>")
    best = df.select(mt.top_k(F.col("l"), 2).alias("t")).first().t
    assert [b.id for b in best] == [1, 2] and [b.score for b in best] == pytest.approx([0.731059, 0.268941], abs=1e-6)
    pred = frame(spark, [(0, 0), (0, 1), (1, 1), (2, 1)], "label int, pred int")
    assert mt.accuracy(pred).first()[0] == 0.5
    assert tuple(mt.macro_scores(pred).first()) == pytest.approx((0.444444, 0.5, 0.388889), abs=1e-6)
    assert {tuple(r) for r in mt.confusion_matrix(pred, 3).collect()} >= {(0, 0, 1), (2, 2, 0), (2, 1, 1)}


def test_sampling_sizes_and_split(spark):
    df = frame(spark, [(n * 100 + i, n, "1") for n in range(1, 10) for i in range(n)], "id int, gloss_id int, cam_id string")
    got = md.sample_rank(df, ["gloss_id", "cam_id"], F.col("id")).filter("sampled").groupBy("gloss_id").count()
    sizes = {r.gloss_id: r["count"] for r in got.collect()}
    assert [sizes.get(n, 0) for n in range(1, 10)] == [0, 1, 2, 2, 2, 3, 4, 4, 4]
    clips = frame(spark, [(i, s, "1", 0) for i, s in enumerate(["007", "024", "020", "014", "015", "001"])], "id int, signer_id string, cam_id string, gloss_id int")
    assert [r.split for r in md.signer_split(clips, F.col("id")).orderBy("id").collect()] == ["val", "test", "train", "test", "val", "train"]


def test_vocabulary_order(spark):
    got = md.vocabulary(frame(spark, [("b",), ("a",), ("b",), ("ă",), (None,)], "gloss string")).orderBy("gloss_id")
    assert rows(got, "gloss_id", "gloss") == [(0, "a"), (1, "b"), (2, "ă")]


def test_perspective(spark):
    x, y = g.perspective(F.lit(0.31), F.lit(0.77), F.lit(0.07), F.lit(False))
    assert tuple(spark.range(1).select(x, y).first()) == pytest.approx((0.319128, 0.757029), abs=1e-6)


def test_bones_in_place_differ_where_parents_are_children():
    true, chained = sk.bone_terms("true"), sk.bone_terms("in_place")
    differ = sorted(j for j in true if sorted(true[j]) != sorted(chained[j]))
    assert differ == [3, 4, 5, 6, 7, 10, 12, 14, 16, 17, 20, 22, 24, 26]


def test_partitions_and_names(spark):
    parts = {(r.i, r.j): r.part for r in sk.partitions(sk.hop_distances(spark)).collect()}
    assert parts[1, 0] == 1 and parts[0, 1] == 2 and parts[3, 3] == 0
    assert len(names.landmarks()) == 54 and len(names.landmarks(True)) == 74
    labels = names.hand_labels()
    assert labels[1] == "wrist_1" and labels[21] == "ringDIP_1"
    assert names.whole_body_point(95) == ("LEFT_HAND_LANDMARKS", "THUMB_TIP") and names.whole_body_point(132) == ("RIGHT_HAND_LANDMARKS", "PINKY_TIP")
    assert names.observation_points()[2] == ("POSE_LANDMARKS", "RIGHT_EYE")


def test_sources_and_sinks(spark, tmp_path):
    import json

    from kinseq.sources import readers, writers

    meta = [{"video_id": "0001", "signer_id": "007", "fps": 25, "resolution": 1080, "gloss": "b", "num_frames": 40, "length_seconds": 1.6}]
    for cam in ("cam_1", "cam_2"):
        (tmp_path / f"{cam}.json").write_text(json.dumps(meta, indent=1))
    df = readers.read_metadata(spark, str(tmp_path), ["cam_1", "cam_2"])
    assert sorted(rows(df, "video_id", "cam")) == [("0001", "cam_1"), ("0001", "cam_2")]
    (tmp_path / "split.csv").write_text("video_id,split\n0001,train\n")
    assert rows(readers.read_splits(spark, str(tmp_path / "split.csv")), "video_id", "split") == [("0001", "train")]
    for n in ("b.mp4", "a.mov", "c.txt"):
        (tmp_path / "v").mkdir(exist_ok=True)
        (tmp_path / "v" / n).write_bytes(b"x")
    assert [p.rpartition("/")[2] for (p,) in rows(readers.list_files(spark, str(tmp_path / "v")), "path")] == ["a.mov", "b.mp4"]
    writers.write_metadata(df, str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).count() == 2
    req = frame(spark, [('{"image": "data:image/jpeg;base64,aGk="}',)], "value string")
    assert bytes(readers.frame_requests(req).first().image) == b"hi"
    assert writers.metadata_name("set_1") == "cam_1" and writers.metadata_name("set_1_2") == "set_1_2"


def test_options():
    from kinseq.plans.config import SegmentOptions, TransformOptions, chain, expected_shape

    assert chain(TransformOptions()) == ["extract", "select_landmarks", "normalise_body", "normalise_hands", "pad", "shift"]
    assert chain(TransformOptions(model="graph", split="train", bone_stream=True, motion_stream=True))[-3:] == ["bones", "motion", "root_centre"]
    assert "augment" in chain(TransformOptions(split="train", aug_prob=0.5)) and "augment" not in chain(TransformOptions(split="test", aug_prob=0.5))
    for bad in ({"anchor": "hip"}, {"aug_prob": 2}, {"model": "x"}, {"num_frames": 0}):
        with pytest.raises(ValueError):
            TransformOptions(**bad)
    live = SegmentOptions(live=True, theta=160, min_up=20)
    assert (live.theta, live.min_up, live.min_down, live.visibility) == (160, 20, 10, 0.5) and SegmentOptions().theta == 160 and SegmentOptions(live=True).theta == 140
    assert expected_shape("graph", 120, 27) == (1, 3, 120, 27, 1)


def test_chains_have_every_step_or_fail(spark):
    from kinseq.plans.chains import graph_steps, transformer_steps
    from kinseq.plans.config import REGISTRY, TransformOptions, chain, register, run_chain

    for model, make in (("transformer", transformer_steps), ("graph", graph_steps)):
        options = TransformOptions(model=model, split="train", interpolate=True, aug_prob=0.5, gaussian_noise=True, bone_stream=True, motion_stream=True)
        assert [name for name, _ in make(options)] == chain(options)
        with pytest.raises(ValueError):
            make(TransformOptions(model=model, extra=("no_such_step",)))

    @register("doubled")
    def doubled(df):
        return df.withColumn("v", F.transform("v", lambda x: x * 2))

    try:
        steps = graph_steps(TransformOptions(model="graph", num_frames=2, extra=("doubled",)), ("v",), after="select_joints")
        out = run_chain(frame(spark, [(1, 0, [1.0, 3.0])], "clip_id int, frame_idx int, v array<double>"), steps)
        assert sorted(rows(out, "frame_idx", "v")) == [(0, [0.0, 4.0]), (1, [0.0, 4.0])]
    finally:
        REGISTRY.pop("doubled")


def test_component_pruning(spark):
    df = frame(spark, [("POSE_LANDMARKS", "NOSE"), ("FACE_LANDMARKS", "70"), ("FACE_LANDMARKS", "71"), ("POSE_WORLD_LANDMARKS", "NOSE")], "component string, point string")
    assert sk.drop_components(df).count() == 1 and sk.drop_components(df, keep_face=True).count() == 2
    assert rows(sk.select_points(df, sk.landmark_points()), "joint") == [(0,)]


def test_geometry_misc(spark):
    one = spark.range(1)
    assert one.select(g.frame_truncated(F.lit(-0.05), 25)).first()[0] == -1
    x, y = g.rotate(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0), F.lit(math.pi / 2))
    assert tuple(one.select(x, y).first()) == pytest.approx((0.0, 1.0))
    assert one.select(g.uniform(F.lit(5), 1, "a")).first()[0] != one.select(g.uniform(F.lit(5), 1, "b")).first()[0]
