"""Stop alerts and counts over streams, with watermarks, late rows set aside and counted."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues, ValueState

from boxloom.operators.tracks import EVENT_NAMES, EVENTS, StopRules, StopState, on_ground


def frame_stride(points: DataFrame, n: int) -> DataFrame:
    """Every ``n``-th frame."""
    return points.where(F.pmod(F.col("frame_id"), F.lit(n)) == 0)


def stream_dedup(points: DataFrame, delay: str) -> DataFrame:
    """Points once for each (sequence, track, frame), also if they are sent again within the delay."""
    return points.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["sequence_id", "track_id", "frame_id"])


def alerts_tumbling(rows: DataFrame, delay: str, length: str) -> DataFrame:
    return _windowed(rows, delay, F.window("ts", length))


def alerts_sliding(rows: DataFrame, delay: str, length: str, step: str) -> DataFrame:
    return _windowed(rows, delay, F.window("ts", length, step))


def _windowed(rows: DataFrame, delay: str, window: Column) -> DataFrame:
    """Rows and distinct tracks of each camera and window: two aggregations in a chain, first by track, then by window."""
    of_track = rows.withWatermark("ts", delay).groupBy("sequence_id", "track_id", window.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    counts = of_track.groupBy("sequence_id", "w").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_tracks"))
    return counts.select("sequence_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows", "n_tracks")


def alerts_session(rows: DataFrame, delay: str, gap: str) -> DataFrame:
    """Rows and distinct tracks of each camera's sessions, which end where it is silent for the gap.

    Sessions merge as rows come in, so their tracks are held as a set until they end.
    """
    sessions = rows.withWatermark("ts", delay).groupBy("sequence_id", F.session_window("ts", gap).alias("w"))
    counts = sessions.agg(F.count(F.lit(1)).alias("n_rows"), F.size(F.collect_set("track_id")).cast("bigint").alias("n_tracks"))
    return counts.select("sequence_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n_rows", "n_tracks")


def _millis(ts: pd.Series) -> pd.Series:
    return ts.astype("datetime64[us]").astype("int64") // 1000


#: Keys that tracks share.
KEYS = 256


class LatePoints(StatefulProcessor):
    """Gives the rows at or behind the watermark; it holds nothing."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        behind = timerValues.getCurrentWatermarkInMs()
        for part in rows:
            late = part[_millis(part["at"]) <= behind]
            yield late.drop(columns="key").assign(behind_ms=behind - _millis(late["at"])).rename(columns={"at": "ts"})

    def close(self) -> None:
        pass


def late_points(points: DataFrame, delay: str) -> DataFrame:
    """The points that come at or behind the watermark, with ``behind_ms``: those ``stop_alert_stream`` leaves out.

    The watermark of a micro-batch is the latest time of the batches before it, less the delay. Spark
    would drop such rows before any operator sees them, so the time goes in as a column that is not known
    as the event time. Nothing is held of a track, so many tracks share a key: a call a key is what costs.
    """
    rows = points.withWatermark("ts", delay).select("sequence_id", "track_id", "frame_id", F.timestamp_micros(F.unix_micros("ts")).alias("at"))
    schema = "sequence_id string, track_id long, frame_id long, ts timestamp, behind_ms long"
    shared = F.pmod(F.hash("sequence_id", "track_id"), F.lit(KEYS)).alias("key")
    return rows.select(shared, "*").groupBy("key").transformWithStateInPandas(LatePoints(), schema, "append", "EventTime")


#: State of the tracks and points that share a key: a row as arrays, one a column, which are read and written at once.
_TRACKS = (
    "sequence array<string>, track array<long>, stopped array<double>, moving array<double>, seen array<double>, "
    "seen_ms array<long>, event array<array<double>>, history array<array<double>>"
)
_WAITING = "ms array<long>, frame array<long>, sequence array<string>, track array<long>, x array<double>, y array<double>, inside array<boolean>"
_POINT = ["ms", "frame_id", "sequence_id", "track_id", "x", "y", "inside"]


class StopAlerts(StatefulProcessor):
    """The stop-alert rules of the tracks that share a key.

    State: what is known of each track with its recent positions, and the points that wait for the watermark. Points
    are taken in time order once the watermark has reached them, so the events do not depend on how
    the stream is cut into batches, nor on the order within the delay. One timer stands at what comes next: the
    earliest point that waits, or the earliest time at which a track is lost. It has to be ahead of the watermark: one that
    stands at it expires in the same batch, and Spark deletes it after the call, also if the call sets it anew.
    """

    def __init__(self, rules: StopRules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getValueState("tracks", _TRACKS)
        self.waiting = handle.getValueState("waiting", _WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        reached, fresh = timerValues.getCurrentWatermarkInMs(), []
        for part in rows:
            on_time = part[(part.ms > reached) & part.sequence_id.notna()]
            fresh += zip(*(on_time[c].tolist() for c in _POINT), strict=True)
        yield from self._advance(fresh, reached)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance([], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, fresh: list[tuple], reached: int) -> Iterator[pd.DataFrame]:
        tracks, found = {}, []
        for sequence, track, stopped, moving, seen, seen_ms, event, history in zip(*self._held(self.tracks), strict=True):
            flat = iter(history)
            tracks[sequence, track] = [StopState([*zip(flat, flat, flat)], stopped, moving, seen, event or None), seen_ms]
        waiting = [*zip(*self._held(self.waiting), strict=True), *fresh]
        for ms, frame, sequence, track, x, y, inside in sorted(p for p in waiting if p[0] <= reached):
            now, held = (frame - 1) / self.rules.fps, tracks.setdefault((sequence, track), [StopState(), 0])
            if held[0].last_seen is None or now > held[0].last_seen:
                found += [(sequence, track, *e) for e in held[0].step(now, x, y, inside, self.rules)]
                held[1] = ms
        gap = int((self.rules.max_gap + 1 / self.rules.fps) * 1000)
        for track in [t for t, (_, seen_ms) in tracks.items() if seen_ms + gap < reached]:
            found += [(*track, *e) for e in tracks.pop(track)[0].lost()]
        rest = [p for p in waiting if p[0] > reached]
        flat = ((*t, s.stopped_since, s.moving_since, s.last_seen, ms, s.event or [], [*chain(*s.history)]) for t, (s, ms) in tracks.items())
        self._keep(self.tracks, flat)
        self._keep(self.waiting, rest)
        self._wake([p[0] for p in rest] + [ms + gap + 1 for _, ms in tracks.values()])
        if found:
            yield pd.DataFrame(found, columns=EVENT_NAMES)

    @staticmethod
    def _held(state: ValueState) -> tuple:
        return state.get() if state.exists() else ()

    @staticmethod
    def _keep(state: ValueState, rows: Iterable[tuple]) -> None:
        columns = tuple(map(list, zip(*rows)))
        if columns:
            state.update(columns)
        else:
            state.clear()

    def _wake(self, times: list[int]) -> None:
        held = list(self.handle.listTimers())
        for t in held:
            self.handle.deleteTimer(t)
        if times:
            self.handle.registerTimer(min(times))


def stop_alert_stream(points: DataFrame, rules: StopRules, delay: str, n_keys: int = KEYS) -> DataFrame:
    """The stop-alert rules over a stream of points (``EVENTS``), with one bounded state a track.

    The rows are those of ``stop_alert_batch`` over the same points, but for events still open when the
    stream ends, which ends nothing. Rows at or behind the watermark are left out; ``late_points`` gives
    them. A track that stays away longer than the gap is closed as TRACK_LOST by a timer, and its state goes. The
    state store has to be RocksDB. A call and its state are dear, not what they hold, so tracks share ``n_keys`` keys; a
    task holds those of a key at once, so more tracks ask for more keys. Points without a track or camera count for the watermark only.
    """
    rows = on_ground(points).withWatermark("ts", delay).select(
        F.when(F.col("track_id").isNotNull(), F.col("sequence_id")).alias("sequence_id"), F.coalesce("track_id", F.lit(0)).alias("track_id"), "frame_id",
        F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.coalesce("inside", F.lit(False)).alias("inside"), F.unix_millis("ts").alias("ms"),
    )
    shared = F.pmod(F.hash("sequence_id", "track_id"), F.lit(n_keys)).alias("key")
    return rows.select(shared, "*").groupBy("key").transformWithStateInPandas(StopAlerts(rules), EVENTS, "append", "EventTime")
