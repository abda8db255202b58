"""A small made-up region: a tender that lies at an offshore bank, vessels that call on it, and one that anchors by itself."""

from __future__ import annotations

import datetime as dt
import math
import random

from pyspark.sql import DataFrame, SparkSession

START = dt.datetime(2025, 3, 1)
BANK, ANCHORAGE, PORTS = (6.4, -12.1), (9.2, -14.6), ((8.5, -13.25), (6.3, -10.8))
PRESENCE = "vessel_id string, ship_name string, vessel_type string, flag string, date timestamp, lat double, lon double, hours double"
EVENT = "event_kind string, event_id string, start timestamp, end timestamp, lat double, lon double, vessel_id string"


def visits(callers: int, days: int) -> list[tuple[int, int, int]]:
    """(caller, first hour, hours): the callers take turns, a day and a half apart, and stay longer each time."""
    return [(i % callers, 30 + 36 * i, 6 + i % 5) for i in range((24 * days - 60) // 36)]


def presence(spark: SparkSession, days: int = 7, callers: int = 3, seed: int = 1) -> DataFrame:
    """Hourly positions that swing around an anchor."""
    rng = random.Random(seed)

    def swing(place: tuple[float, float], h: int) -> tuple[float, float]:
        angle = h / 12 * math.pi + rng.uniform(-0.2, 0.2)
        return place[0] + 0.004 * math.sin(angle), place[1] + 0.004 * math.cos(angle)

    stays = [("tender-1", "carrier", BANK, 0, 24 * days), ("loner-1", "fishing", ANCHORAGE, 11, 9)]
    stays += [(f"caller-{i + 1}", "fishing", (BANK[0] + 0.01 * (i + 1), BANK[1] - 0.01), first, n) for i, first, n in visits(callers, days)]
    rows = [(v, v.upper(), kind, None, START + dt.timedelta(hours=first + h), *swing(place, h), 1.0) for v, kind, place, first, n in stays for h in range(n)]
    return spark.createDataFrame(rows, PRESENCE)


def events(spark: SparkSession, days: int = 7, callers: int = 3) -> dict[str, DataFrame]:
    """A gap before and an encounter in each visit, loitering of the tender, and a call at each port."""
    at = lambda h: START + dt.timedelta(hours=h)
    calls = visits(callers, days)
    rows = {
        "gaps": [(at(first - 3), at(first), *BANK, f"caller-{i + 1}") for i, first, _ in calls],
        "encounters": [(at(first + 1), at(first + 3), *BANK, f"caller-{i + 1}") for i, first, _ in calls],
        "loitering": [(at(2), at(20), *BANK, "tender-1")],
        "port_visits": [(at(4 * k), at(4 * k + 6), *p, None) for k, p in enumerate(PORTS)],
    }
    return {kind: spark.createDataFrame([(kind, f"{kind}-{n}", *r) for n, r in enumerate(found)], EVENT) for kind, found in rows.items()}
