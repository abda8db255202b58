"""Ports near stops, and events near stops in space and time."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.exprs import EARTH_KM, col, haversine_km, hours
from moorage.functions.storage import cut, drop
from moorage.operators.grid import cell_of, cells_around, with_cells_within


#: Radii in km within which ports are looked for, one after the other; the last is beyond half the Earth's girth.
RADII_KM = (25.0, 100.0, 400.0, 1600.0, 6400.0, 20100.0)


def add_nearest_port(stops: DataFrame, ports: DataFrame, radii: tuple[float, ...] = RADII_KM, near: DataFrame | None = None) -> DataFrame:
    """``nearest_port_km`` and ``nearest_port_id``; equal distances go to the smaller id, no ports or no place give nulls.
    ``near``: what ``nearest_ports`` has found, if it was asked before."""
    found = nearest_ports(stops, ports, radii) if near is None else near
    out = stops.drop("nearest_port_km", "nearest_port_id")
    joined = out.join(found, (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon")), "left")
    return joined.select(*out.columns, F.col("best.km").alias("nearest_port_km"), F.col("best.port_id").alias("nearest_port_id"))


def nearest_ports(stops: DataFrame, ports: DataFrame, radii: tuple[float, ...] = RADII_KM) -> DataFrame:
    """(_lat, _lon, best) of the stops' distinct positions, for ``add_nearest_port``.

    Positions meet the ports of neighbouring grid cells. Those without a port within the cells' radius are taken
    up again with wider cells, so what is far from all ports alone meets many.
    """
    sound = cut(ports.where("lat is not null and lon is not null").select("port_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon")))
    open_ = cut(stops.where("lat is not null and lon is not null").select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon")).distinct())
    found = None
    for km in () if sound.isEmpty() else radii:
        around = sound.withColumn("cell", F.explode(cells_around("p_lat", "p_lon", km)))
        pairs = open_.withColumn("cell", cell_of("_lat", "_lon", km)).join(around, "cell")
        best = F.min(F.struct(haversine_km("_lat", "_lon", "p_lat", "p_lon").alias("km"), "port_id")).alias("best")
        near = cut(pairs.groupBy("_lat", "_lon").agg(best).where(F.col("best.km") <= km))
        found = near if found is None else found.union(near)
        left = cut(open_.join(near, ["_lat", "_lon"], "left_anti"))
        drop(open_)
        open_ = left
        if open_.isEmpty():
            break
    if found is None:
        kind = ports.schema["port_id"].dataType.simpleString()
        return stops.sparkSession.createDataFrame([], f"_lat double, _lon double, best struct<km: double, port_id: {kind}>")
    drop(sound, open_)
    return found


#: Of a cell and week with more pairs of a stop and an event than this, matches are counted and not made.
MOST_PAIRS = 50_000
#: A cell and week with more rows than this is cut into cells as narrow as the limit, and its kinds of events are parted.
MOST_ROWS = 1_000_000
#: Kinds of events that are counted near stops.
KINDS = ("gaps", "encounters", "loitering")
#: Side of the cells, in multiples of the limit: an event is sent to few of them.
WIDE = 4


def event_matches(stops: DataFrame, events: DataFrame, name: str, space_km: float = 20.0, time_hours: float = 24.0, most: int = MOST_PAIRS, rows: int = MOST_ROWS) -> DataFrame:
    """``stops`` with the number of events within ``space_km`` that overlap the stop widened by ``time_hours``; both
    limits are inclusive, any vessel's events count, and an event without an end ends where it starts.

    Stops and events meet by grid cell and week, so that a berth's stops don't meet its events of other years. Crowded
    cells are counted by ``near_counts``, one cell and week in one task."""
    return _with_counts(stops, _found(stops, {name: events}, space_km, time_hours, most, rows), [name])


def match_counts(stops: DataFrame, events: dict[str, DataFrame], space_km: float = 20.0, time_hours: float = 24.0) -> DataFrame | None:
    """(stop_id, _n0, _n1, ...) of stops with matches, written, for ``add_event_matches``: of ``stops`` it needs the id, times
    and place only. None without events."""
    given = {k: events[k] for k in KINDS if events.get(k) is not None}
    return cut(_found(stops, given, space_km, time_hours, MOST_PAIRS, MOST_ROWS)) if given else None


def add_event_matches(stops: DataFrame, events: dict[str, DataFrame], space_km: float = 20.0, time_hours: float = 24.0, counts: DataFrame | None = None) -> DataFrame:
    """``nearby_gaps``, ``nearby_encounters`` and ``nearby_loitering``; a kind without events counts 0. ``counts``: what
    ``match_counts`` has found, if it was asked before."""
    given = [k for k in KINDS if events.get(k) is not None]
    out = stops.withColumns({f"nearby_{k}": F.lit(0).cast("long") for k in KINDS if k not in given})
    if not given:
        return out
    found = match_counts(stops, events, space_km, time_hours) if counts is None else counts
    return _with_counts(out, found, [f"nearby_{k}" for k in given])


def _micros(t, kind: str):
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), col(t).cast(kind))


def _bucket(micros, time_hours: float):
    return F.floor(col(micros) / (max(7 * 24.0, time_hours) * 3.6e9))


def _with_counts(stops: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    out = stops.drop(*names).join(counts, "stop_id", "left")
    return out.withColumns({name: F.coalesce(f"_n{i}", F.lit(0)) for i, name in enumerate(names)}).drop(*counts.columns[1:])


def _found(stops: DataFrame, events: dict[str, DataFrame], space_km: float, time_hours: float, most: int, rows: int) -> DataFrame:
    """(stop_id, _n0, _n1, ...): the matches of each kind, of stops that have some."""
    kind = stops.schema["start"].dataType.simpleString()
    spans = None
    for i, some in enumerate(events.values()):
        some = _spanned(some, kind, time_hours).withColumn("kind", F.lit(i))
        spans = some if spans is None else spans.union(some)
    counts = _counts(_widened(stops, time_hours), spans, len(events), space_km, WIDE * space_km, most, rows)
    return counts.groupBy("stop_id").agg(*(F.sum(c).alias(c) for c in counts.columns[1:]))


def _widened(stops: DataFrame, time_hours: float) -> DataFrame:
    """Placed stops once for each week that they touch."""
    kind = stops.schema["start"].dataType.simpleString()
    low, high = _micros(F.col("start") - hours(time_hours), kind), _micros(F.col("end") + hours(time_hours), kind)
    at = stops.where("lat is not null and lon is not null").select("stop_id", low.alias("s_low"), high.alias("s_high"), "lat", "lon")
    first, last = (_bucket(c, time_hours) for c in ("s_low", "s_high"))
    return at.withColumn("bucket", F.explode(F.sequence(first, last))).withColumn("first", F.col("bucket") == first)


def _spanned(events: DataFrame, kind: str, time_hours: float) -> DataFrame:
    """Placed events once for each week that they touch."""
    placed = events.where("lat is not null and lon is not null and start is not null")
    placed = placed.select(_micros("start", kind).alias("e_start"), _micros(F.coalesce("end", "start"), kind).alias("e_end"), F.col("lat").alias("e_lat"), F.col("lon").alias("e_lon"))
    weeks = F.sequence(_bucket(F.least("e_start", "e_end"), time_hours), _bucket(F.greatest("e_start", "e_end"), time_hours))
    return placed.withColumn("bucket", F.explode(weeks)).withColumn("begins", F.col("bucket") == _bucket("e_start", time_hours))


def _counts(at: DataFrame, spans: DataFrame, kinds: int, space_km: float, side: float, most: int, rows: int) -> DataFrame:
    """(stop_id, _n0, ...), in one or several rows, for stops with matches, kinds of events being numbered. A pair meets in
    every week that both touch, and counts in the one of the later of ``e_start`` and ``s_low``."""
    place, last = ["b", "c", "bucket"], side <= space_km
    # kinds are parted where cells can't be cut any more
    keys = [*place, "kind"] if last else place
    at = cut(at.withColumn("_cell", cell_of("lat", "lon", side)).select("*", "_cell.b", "_cell.c").drop("_cell"))
    spread = with_cells_within(spans, "e_lat", "e_lon", space_km, side)
    # written, as finding the cells takes longer than reading them
    spread = cut(spread.join(at.select(*place).distinct(), place, "left_semi"))
    sizes = at.groupBy(*place).agg(F.count("*").alias("_s")).join(spread.groupBy(*keys).agg(F.count("*").alias("_e")), place)
    crowded = cut(sizes.where(F.col("_s").cast("double") * F.col("_e") > most).select(*keys, (F.col("_s") + F.col("_e")).alias("_rows")))
    counted = (F.col("e_start") <= F.col("s_high")) & (F.col("e_end") >= F.col("s_low")) & (F.col("begins") | (F.col("first") & (F.col("e_end") >= F.col("e_start"))))
    near = counted & (haversine_km("e_lat", "e_lon", "lat", "lon") <= space_km)
    largest = crowded.agg(F.max("_rows")).first()[0]
    few = spread if largest is None else spread.join(crowded.select(*keys), keys, "left_anti")
    each = [F.count_if(F.col("kind") == i).alias(f"_n{i}") for i in range(kinds)]
    out = at.join(few, place).where(near).groupBy("stop_id").agg(*each)
    if largest is None:
        return out
    schema = T.StructType([at.schema["stop_id"], *(T.StructField(f"_n{i}", T.LongType()) for i in range(kinds))])

    def run(stops: pa.Table, events: pa.Table) -> pa.Table:
        mine = [stops.column(c).to_numpy() for c in ("s_low", "s_high", "lat", "lon", "first")]
        theirs = [events.column(c).to_numpy() for c in ("e_start", "e_end", "e_lat", "e_lon", "begins")]
        kind = events.column("kind").to_numpy()
        found = {f"_n{i}": near_counts(*mine, *(x[kind == i] for x in theirs), space_km) for i in range(kinds)}
        return pa.table({"stop_id": stops.column("stop_id"), **found})

    many = crowded if last else crowded.where(F.col("_rows") <= rows)
    dealt = at.join(many.select(*keys), place), spread.join(many.select(*keys), keys, "left_semi")
    out = out.union(dealt[0].groupBy(*keys).cogroup(dealt[1].groupBy(*keys)).applyInArrow(run, schema).where(" or ".join(f"_n{i} > 0" for i in range(kinds))))
    if last or largest <= rows:
        return out
    heavy = at.join(crowded.where(F.col("_rows") > rows).select(*place), place, "left_semi").drop("b", "c")
    return out.union(_counts(heavy, spans, kinds, space_km, space_km, most, rows))


def near_counts(s_low, s_high, s_lat, s_lon, first, e_start, e_end, e_lat, e_lon, begins, km: float, block: int = 1 << 15) -> np.ndarray:
    """For each stop the matching events of one week.

    Stops and events lie in small cubes. For the stops of a cube, events in cubes that are within reach as a whole are
    counted by two searches, those that start in time less those that end before; only events of cubes that the
    limit runs through are compared one by one. Cubes of stops are taken up by parts as wide as the limit, each with the
    events around it.
    """
    out = np.zeros(len(s_low), np.int64)
    if not len(s_low) or not len(e_start):
        return out
    chord = 2 * math.sin(min(km / EARTH_KM, math.pi) / 2)
    order = np.argsort(e_start, kind="stable")
    e_start, e_end, e_lat, e_lon, begins = (x[order] for x in (e_start, e_end, e_lat, e_lon, begins.astype(bool)))
    first, forward = first.astype(bool), e_end >= e_start
    s, e = _on_sphere(s_lat, s_lon), _on_sphere(e_lat, e_lon)
    side = max(chord / 8, 1e-9)
    s_cube, s_mid, s_reach = _cubes(s, side)
    e_cube, e_mid, e_reach = _cubes(e, side)
    by_end = np.argsort(e_end, kind="stable")
    members = np.split(np.argsort(s_cube, kind="stable"), np.cumsum(np.bincount(s_cube))[:-1])
    slack = chord * 1e-6 + 1e-12
    # squares of chords nearer to the limit's than that are rounded too much to tell
    band = chord**2 * 1e-6 + 1e-13
    part, p_mid, p_reach = _cubes(s_mid, max(chord, 1e-9))
    for p in range(len(p_mid)):
        ks = np.flatnonzero(part == p)
        around = np.flatnonzero(np.sqrt(((e_mid - p_mid[p]) ** 2).sum(1)) - e_reach <= chord + p_reach[p] + s_reach[ks].max() + slack)
        if not len(around):
            continue
        # numbers of the cubes around, and of their events in order of start and of end
        place = np.full(len(e_mid), -1)
        place[around] = np.arange(len(around))
        ours = np.flatnonzero(place[e_cube] >= 0)
        cube, fwd, beg = place[e_cube[ours]], forward[ours], begins[ours]
        ends = by_end[place[e_cube[by_end]] >= 0]
        last = np.searchsorted(ours, ends)
        mid, reach, starts, ended = e_mid[around], e_reach[around], e_start[ours], e_end[ends]
        for k in ks:
            here = members[k]
            far = np.sqrt(((mid - s_mid[k]) ** 2).sum(1))
            inside = far + reach + s_reach[k] < chord - slack
            touched = (far - reach - s_reach[k] <= chord + slack) & ~inside
            whole, some = inside[cube] & fwd, touched[cube] | (inside[cube] & ~fwd)
            for firsts in (True, False):
                mine = here[first[here] == firsts]
                if not len(mine):
                    continue
                ok = whole if firsts else whole & beg
                before = lambda mask: np.concatenate([[0], np.cumsum(mask)])
                out[mine] += before(ok)[np.searchsorted(starts, s_high[mine], "right")] - before(ok[last])[np.searchsorted(ended, s_low[mine], "left")]
                at = ours[some & ((beg | fwd) if firsts else beg)]
                if not len(at):
                    continue
                step = max(1, block // len(at))
                for i in range(0, len(mine), step):
                    m = mine[i : i + step]
                    timely = (e_start[at] <= s_high[m, None]) & (e_end[at] >= s_low[m, None])
                    over = 2 - 2 * (s[m] @ e[at].T) - chord**2
                    out[m] += np.count_nonzero(timely & (over < -band), axis=1)
                    tight = np.abs(over) <= band
                    if not tight.any():
                        continue
                    x, y = np.nonzero(timely & tight)
                    near = _km(e_lat[at[y]], e_lon[at[y]], s_lat[m[x]], s_lon[m[x]]) <= km
                    out[m] += np.bincount(x[near], minlength=len(m))
    return out


def _on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    p, q = np.radians(lat), np.radians(lon)
    return np.column_stack([np.cos(p) * np.cos(q), np.cos(p) * np.sin(q), np.sin(p)])


def _cubes(x: np.ndarray, side: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each point's cube; middle and radius of each cube's points."""
    at = np.floor(x / side).astype(np.int64)
    at -= at.min(axis=0)
    sizes = [int(n) + 1 for n in at.max(axis=0)]
    # one number for each cube where that fits: rows take longer to sort
    keys = {"ar": (at[:, 0] * sizes[1] + at[:, 1]) * sizes[2] + at[:, 2]} if math.prod(sizes) < 1 << 62 else {"ar": at, "axis": 0}
    cube = np.unique(**keys, return_inverse=True)[1].reshape(-1)
    n = np.bincount(cube)
    mid = np.column_stack([np.bincount(cube, x[:, d]) / n for d in range(3)])
    reach = np.zeros(len(n))
    np.maximum.at(reach, cube, np.sqrt(((x - mid[cube]) ** 2).sum(1)))
    return cube, mid, reach


def _km(lat1, lon1, lat2, lon2) -> np.ndarray:
    """``haversine_km`` of arrays."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_KM * np.arctan2(np.sqrt(a), np.sqrt(np.maximum(1 - a, 0)))
