"""The live automaton as a stateful stream, and its sinks."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kinseq.operators.segment import LIVE_SCHEMA, LiveRule
from kinseq.sources.code import ship_code

#: Of each arm: class, length and time of its run; whether it is up; its bounds.  Then the buffer's
#: size, first and last frame, and how many signs have closed.
_ARM = "struct<raised:boolean,n:int,since:double,up:boolean,start:double,end:double>"
_STATE = f"arms array<{_ARM}>, n int, first int, last int, closed int"
_DOWN = (False, 0, 0.0, False, 0.0, 0.0)


def _runs(angles, times, theta: float, before: tuple):
    """(raised, frames, first time) of each run of equal frames; the first may go on the run before."""
    raised, n, since = before[:3]
    for angle, t in zip(angles, times, strict=True):
        now = raised if math.isnan(angle) else 0 < angle < theta
        n, since = (n + 1, since) if n and now == raised else (1, t)
        raised = now
        yield raised, n, since


def live_stream(frames: DataFrame, **options) -> DataFrame:
    """SEG2, SEG3 over a stream of (clip_id, frame_idx, t_ms, left_angle, right_angle).

    Keyed by clip, so sessions are independent and spread over tasks; a clip's frames are sorted
    inside each micro-batch, and batches are taken to come in order.  Append mode: a row when a
    sign closes; nothing is flushed at the end of input.  The state is of a fixed size.
    """
    ship_code(frames.sparkSession)
    rule = LiveRule(**options)
    need = {True: rule.min_up + 1, False: rule.min_down + 1}

    def bounded(run: tuple, up: bool, start: float, end: float) -> tuple:
        raised, n, since = run
        start = start if up else (since - rule.delay) * raised
        end = (since + rule.delay) * (not raised) if up else end
        return *run, up != (raised != up and n == need[raised]), start, end

    def closing(arms: list[tuple]):
        whole = [a[4] > 0 and a[5] > 0 and not (rule.strict_down and a[3]) for a in arms]
        alone = [k for k in (0, 1) if whole[k] and arms[1 - k][4] == 0]
        if alone:
            return arms[alone[0]][4:]
        if all(whole) and not any(a[3] for a in arms):
            return min(a[4] for a in arms), max(a[5] for a in arms)
        return None

    def signs(rows: pd.DataFrame, arms: list[tuple], buffer: tuple):
        """Each sign that closes, as (bounds, buffer); then what is left, as (None, (arms, buffer))."""
        numbers, times = rows.frame_idx.tolist(), rows.t_ms.tolist()
        columns = [rows[c].astype(float).tolist() for c in ("left_angle", "right_angle")]
        at = 0
        while at < len(numbers):  # until a sign closes, both arms' runs are known ahead
            for left, right in zip(*[_runs(c[at:], times[at:], rule.theta, a) for c, a in zip(columns, arms, strict=True)], strict=True):
                arms = [bounded(run, *a[3:]) for run, a in zip((left, right), arms, strict=True)]
                if arms[0][3] or arms[1][3]:
                    buffer = (buffer[0] + 1, buffer[1] if buffer[0] else numbers[at], numbers[at])
                at += 1
                bounds = closing(arms) if buffer[0] else None
                if bounds:
                    yield bounds, buffer
                    arms, buffer = [_DOWN, _DOWN], (0, 0, 0)
                    break
        yield None, (arms, buffer)

    def step(key, batches, state: GroupState):
        arms, *buffer, closed = state.get if state.exists else ([_DOWN, _DOWN], 0, 0, 0, 0)
        out = []
        for bounds, rest in signs(pd.concat(list(batches)).sort_values("frame_idx"), [tuple(a) for a in arms], tuple(buffer)):
            if bounds:
                out.append((key[0], closed, bounds[0] / 1000, bounds[1] / 1000, *rest))
                closed += 1
        state.update((rest[0], *rest[1], closed))
        if out:
            yield pd.DataFrame(out, columns=[part.split()[0] for part in LIVE_SCHEMA.split(", ")])

    return frames.groupBy("clip_id").applyInPandasWithState(step, LIVE_SCHEMA, _STATE, "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """SNK7: append what is available to a Parquet table; the written table."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
