"""Stops from a stream of presence rows.

A vessel's open episode is its state; a row that comes after a gap or a step above its limit closes it, and so does the
watermark once it has passed the gap. Rows must come in order of time within a vessel up to the watermark's delay.
"""

from __future__ import annotations

import math
from statistics import median

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from moorage.functions.exprs import EARTH_KM
from moorage.operators.stops import StopRules

STATE = "times array<double>, lats array<double>, lons array<double>"
STOP = "vessel_id string, start timestamp, end timestamp, duration_hours double, n_hourly_points long, lat double, lon double, radius_km double"


def km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


def as_stop(vessel: str, points: list[tuple[float, float, float]], rules: StopRules) -> dict | None:
    """The stop that an episode of (seconds, lat, lon) is, if it is one."""
    if len(points) < 2:
        return None
    hours = (points[-1][0] - points[0][0]) / 3600 + 1.0
    lat, lon = median(p[1] for p in points), median(p[2] for p in points)
    radius = max(km(p[1], p[2], lat, lon) for p in points)
    if hours < rules.min_duration_hours or radius > rules.max_radius_km:
        return None
    at = lambda s: pd.Timestamp(s, unit="s")
    return {"vessel_id": vessel, "start": at(points[0][0]), "end": at(points[-1][0]), "duration_hours": hours, "n_hourly_points": len(points), "lat": lat, "lon": lon, "radius_km": radius}


def stream_stops(presence: DataFrame, rules: StopRules = StopRules(), delay: str = "1 hour") -> DataFrame:
    """Closed stops of a streaming table (vessel_id string, timestamp, lat, lon)."""
    columns = list(pd.DataFrame(columns=[c.split()[0] for c in STOP.split(", ")]))
    gap_ms = int(rules.max_gap_hours * 3_600_000) + 1

    def step(key, parts, state: GroupState):
        points = list(zip(*state.get, strict=True)) if state.exists else []
        out = []
        if state.hasTimedOut:
            out.append(as_stop(key[0], points, rules))
            state.remove()
        else:
            rows = pd.concat(list(parts)).sort_values(["timestamp", "lat", "lon"])
            for t, lat, lon in zip(rows["timestamp"].map(lambda x: x.timestamp()), rows["lat"], rows["lon"], strict=True):
                if points and ((t - points[-1][0]) / 3600 > rules.max_gap_hours or km(*points[-1][1:], lat, lon) > rules.max_step_km):
                    out.append(as_stop(key[0], points, rules))
                    points = []
                points.append((float(t), float(lat), float(lon)))
            state.update(tuple(map(list, zip(*points, strict=True))))
            due = int(points[-1][0] * 1000) + gap_ms
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([s for s in out if s], columns=columns)

    sound = presence.dropna(subset=["vessel_id", "timestamp", "lat", "lon"]).withWatermark("timestamp", delay)
    return sound.groupBy("vessel_id").applyInPandasWithState(step, STOP, STATE, "append", GroupStateTimeout.EventTimeTimeout)
