"""Camera tracks: segments, speeds, the stop-alert state machine, and alert metrics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK = ("sequence_id", "track_id")


def on_ground(points: DataFrame) -> DataFrame:
    """Points with ``y`` (0 if there is none, for motion along a line) and ``inside`` (true if nothing says otherwise)."""
    if "y" not in points.columns:
        points = points.withColumn("y", F.lit(0.0))
    return points if "inside" in points.columns else points.withColumn("inside", F.lit(True))


def track_segments(tracks: DataFrame, max_gap: float, fps: float = 1.0) -> DataFrame:
    """``segment`` of each point: a track is cut where it was missing for longer than ``max_gap`` seconds.

    A track seen at frame l and next at r is missing on the frames between, so it is cut if
    ``(r - 1 - l) / fps > max_gap``.
    """
    w = Window.partitionBy(*TRACK).orderBy("frame_id")
    gap = (F.col("frame_id") - F.lag("frame_id").over(w) - 1) / F.lit(fps) > max_gap
    out = tracks.withColumn("cut", F.coalesce(gap, F.lit(False)).cast("int"))
    return out.withColumn("segment", F.sum("cut").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("cut")


def track_speed(segmented: DataFrame, window: float, fps: float = 1.0) -> DataFrame:
    """``speed``: median of 3.6 * distance / time to all points at least max(0.25, window / 2) and at most ``window`` s old.

    Distances are on the ground plane (``x``, ``y``, in metres). Null where no point qualifies. The frame of the
    window is the time, so a long track is never held whole.
    """
    segmented = on_ground(segmented)
    frames = int(window * fps)
    w = Window.partitionBy(*TRACK, "segment").orderBy("frame_id").rangeBetween(-frames, Window.currentRow)
    out = segmented.withColumn("_past", F.collect_list(F.struct("frame_id", "x", "y")).over(w))
    least = max(0.25, window / 2)
    out = out.withColumn("_v", F.expr(
        f"array_sort(transform(filter(_past, p -> (frame_id - p.frame_id) / {fps}D >= {least}D), p -> "
        f"3.6D * sqrt((x - p.x) * (x - p.x) + (y - p.y) * (y - p.y)) / ((frame_id - p.frame_id) / {fps}D)))"
    ))
    n = "size(_v)"
    median = F.expr(f"CASE WHEN {n} = 0 THEN NULL WHEN {n} % 2 = 1 THEN _v[CAST({n} / 2 AS INT)] ELSE (_v[CAST({n} / 2 AS INT) - 1] + _v[CAST({n} / 2 AS INT)]) / 2 END")
    return out.withColumn("speed", median).drop("_past", "_v", "inside")


@dataclass
class StopRules:
    """Parameters of a stop alert, in seconds, km/h and metres on the ground."""

    stop_speed: float = 2.0
    resume_speed: float = 3.0
    stop_seconds: float = 3.0
    resume_seconds: float = 1.0
    window: float = 2.0
    max_gap: float = 1.0
    fps: float = 1.0
    camera: tuple[float, float] = (0.0, 0.0)

    def __post_init__(self):
        if not 0 < self.stop_speed < self.resume_speed:
            raise ValueError("the resume speed has to be over the stop speed, and that over 0")
        if min(self.stop_seconds, self.resume_seconds, self.window, self.fps) <= 0 or self.max_gap < 0:
            raise ValueError("times and the frame rate have to be positive")


@dataclass
class StopState:
    """State of one track: recent positions, how long it stands or moves, and the open event."""

    history: list = field(default_factory=list)  # (time, x, y)
    stopped_since: float | None = None
    moving_since: float | None = None
    last_seen: float | None = None
    event: list | None = None  # started, alerted, speed and range at the alert, last confirmed

    def speed(self, now: float, x: float, y: float, rules: StopRules) -> float | None:
        self.history = [p for p in self.history if p[0] >= now - rules.window]
        least = max(0.25, rules.window / 2)
        found = sorted(3.6 * math.sqrt((x - a) * (x - a) + (y - b) * (y - b)) / (now - t) for t, a, b in self.history if now - t >= least)
        self.history.append((now, x, y))
        if not found:
            return None
        k = len(found) // 2
        return found[k] if len(found) % 2 else (found[k - 1] + found[k]) / 2

    def close(self, at: float, reason: str) -> list:
        out = [(*self.event, at, reason)] if self.event else []
        self.event = self.stopped_since = self.moving_since = None
        return out

    def step(self, now: float, x: float, y: float, inside: bool, rules: StopRules) -> list:
        """Take one point in time order; returns the events that end with it."""
        out = []
        if self.last_seen is not None and now - 1 / rules.fps - self.last_seen > rules.max_gap:
            out += self.lost()
        self.last_seen = now
        if not inside:
            return out + self.close(now, "LEFT_ROI")
        v = self.speed(now, x, y, rules)
        if v is None:
            return out
        if self.event is None:
            if v <= rules.stop_speed:
                self.stopped_since = now if self.stopped_since is None else self.stopped_since
                if now - self.stopped_since >= rules.stop_seconds:
                    away = math.sqrt((x - rules.camera[0]) * (x - rules.camera[0]) + (y - rules.camera[1]) * (y - rules.camera[1]))
                    self.event, self.moving_since = [self.stopped_since, now, v, away, now], None
            elif v >= rules.resume_speed:
                self.stopped_since = None
        else:
            if v <= rules.stop_speed:
                self.moving_since = None
            elif v >= rules.resume_speed:
                self.moving_since = now if self.moving_since is None else self.moving_since
                if now - self.moving_since >= rules.resume_seconds:
                    return out + self.close(now, "MOTION_RESUMED")
            self.event[4] = now
        return out

    def lost(self) -> list:
        """The track is gone: an open event ends where it was last seen, positions are dropped."""
        self.history = []
        return self.close(self.last_seen, "TRACK_LOST")

    def end(self, last: float, rules: StopRules) -> list:
        """The sequence is over at time ``last``."""
        if self.last_seen is not None and last - self.last_seen > rules.max_gap:
            return self.lost()
        return self.close(last, "END_OF_REPLAY")


EVENTS = (
    "sequence_id string, track_id long, started_at_s double, alerted_at_s double, speed_kmh_at_alert double, "
    "range_m_at_alert double, last_seen_at_s double, ended_at_s double, end_reason string"
)
EVENT_NAMES = [c.split()[0] for c in EVENTS.split(", ")]


def stop_alert_batch(tracks: DataFrame, rules: StopRules) -> DataFrame:
    """Stop events of stored tracks (``EVENTS``). An optional boolean ``inside``: the point is in the region of interest.

    Rows are dealt by track and sorted; a partition is read as a stream that holds the state of one track.
    """
    tracks = on_ground(tracks)
    ends = tracks.groupBy("sequence_id").agg(F.max("frame_id").alias("last_frame"))
    rows = tracks.join(ends, "sequence_id").select(*TRACK, "frame_id", "x", "y", "inside", "last_frame")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, state, last = None, StopState(), 0.0
        for part in parts:
            out = []
            for sequence, track, frame, x, y, inside, last_frame in zip(*(part[c].tolist() for c in part.columns), strict=True):
                if own != (sequence, track):
                    if own:
                        out += [(*own, *e) for e in state.end(last, rules)]
                    own, state = (sequence, track), StopState()
                last = (last_frame - 1) / rules.fps
                out += [(*own, *e) for e in state.step((frame - 1) / rules.fps, x, y, inside, rules)]
            yield pd.DataFrame(out, columns=EVENT_NAMES)
        if own:
            yield pd.DataFrame([(*own, *e) for e in state.end(last, rules)], columns=EVENT_NAMES)

    return rows.repartition(*TRACK).sortWithinPartitions(*TRACK, "frame_id").mapInPandas(run, EVENTS)


def number_events(events: DataFrame) -> DataFrame:
    """Event ids by alert time within each sequence."""
    n = F.row_number().over(Window.partitionBy("sequence_id").orderBy("alerted_at_s", "track_id"))
    return events.withColumn("event_no", n.cast("bigint")).withColumn("event_id", F.format_string("%s_EV%05d", "sequence_id", n))


def match_expected_events(expected: DataFrame, alerts: DataFrame) -> DataFrame:
    """Approved expected intervals, each with the earliest unused alert of its track that starts in it."""
    approved = expected.where("approval_status = 'APPROVED'").select(*TRACK, F.col("event_id").alias("expected_id"), "expected_start_s", "expected_end_s")
    pairs = approved.join(alerts.select(*TRACK, "event_id", "alerted_at_s"), list(TRACK), "left")
    inside = F.expr("alerted_at_s BETWEEN expected_start_s AND expected_end_s")
    pairs = pairs.withColumn("event_id", F.when(inside, F.col("event_id"))).withColumn("alerted_at_s", F.when(inside, F.col("alerted_at_s")))

    names = ["sequence_id", "track_id", "expected_id", "expected_start_s", "event_id", "alerted_at_s"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the state is one expected interval's answer and the alerts of one track used so far
        own, used, held = None, set(), None
        for part in parts:
            out = []
            for row in zip(*(part[c].tolist() for c in names), strict=True):
                if held and row[:3] != held[:3]:
                    out.append(held)
                    held = None
                if row[:2] != own:
                    own, used = row[:2], set()
                held = held or (*row[:4], None, None)
                if held[4] is None and row[4] is not None and row[4] not in used:
                    used.add(row[4])
                    held = row
            yield pd.DataFrame(out, columns=names).astype({"alerted_at_s": float})
        if held:
            yield pd.DataFrame([held], columns=names).astype({"alerted_at_s": float})

    schema = "sequence_id string, track_id long, expected_id string, expected_start_s double, event_id string, alerted_at_s double"
    order = [*TRACK, "expected_start_s", "expected_id", F.asc_nulls_last("alerted_at_s"), "event_id"]
    return pairs.select(*names).repartition(*TRACK).sortWithinPartitions(*order).mapInPandas(run, schema)


def alert_metrics(matched: DataFrame, alerts: DataFrame, hours: float) -> DataFrame:
    """Missed events, false alerts an hour and mean latency; without approved events nothing is measured."""
    m = matched.agg(F.count(F.lit(1)).alias("n_expected"), F.count("event_id").alias("n_matched"), F.avg(F.col("alerted_at_s") - F.col("expected_start_s")).alias("mean_latency_s"))
    a = alerts.agg(F.count(F.lit(1)).alias("n_alerts"))
    out = m.withColumn("one", F.lit(1)).join(a.withColumn("one", F.lit(1)), "one")
    known = F.col("n_expected") > 0
    return out.select(
        "n_expected", "n_alerts", F.when(known, F.col("n_expected") - F.col("n_matched")).alias("n_missed"),
        F.when(known, (F.col("n_alerts") - F.col("n_matched")) / hours).alias("false_alerts_per_hour"), "mean_latency_s",
        F.when(known, "MEASURED").otherwise("NOT_MEASURED_NO_APPROVED_GROUND_TRUTH").alias("status"),
    )


def replay_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("sequence_id", "end_reason").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("ended_at_s") - F.col("started_at_s")).alias("stopped_s"), F.countDistinct("track_id").alias("n_tracks")
    )
