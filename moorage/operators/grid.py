"""Equi-joins on grid cells in place of distance joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions.exprs import EARTH_KM, KM_LAT, KM_LON, col


def mean_lat(points: DataFrame, lat: str = "lat") -> float:
    return points.agg(F.avg(lat)).first()[0] or 0.0


def local_plane(points: DataFrame, lat0: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``x_km``, ``y_km`` on a plane at the latitude ``lat0``."""
    return points.withColumns({"x_km": F.col(lon) * KM_LON * math.cos(math.radians(lat0)), "y_km": F.col(lat) * KM_LAT})


def plane_cells(eps: float, level: int = 0) -> dict[str, Column]:
    """``i``, ``j``: a cell of the plane so small that positions within it are never more than ``eps`` apart, whatever the
    rounding; at ``level`` each cell is cut in half so many times both ways."""
    scale = 2.0**level
    return {"i": F.floor(F.col("x_km") / (eps / 1.4143) * scale), "j": F.floor(F.col("y_km") / (eps / 1.4143) * scale)}


def apart(ax, ay, bx, by) -> Column:
    """Distance on the plane."""
    return F.sqrt(F.pow(col(ax) - col(bx), 2) + F.pow(col(ay) - col(by), 2))


def spread(points: DataFrame, half: bool = False) -> DataFrame:
    """``points`` once for each cell that can hold a position within ``eps`` of theirs; ``half``: for one of each two
    opposite cells, and not for their own."""
    steps = [(di, dj) for di in range(-2, 3) for dj in range(-2, 3) if not half or (di, dj) > (0, 0)]
    out = points.withColumn("_s", F.explode(F.array(*(F.struct(F.lit(di).alias("i"), F.lit(dj).alias("j")) for di, dj in steps))))
    return out.withColumns({"i": F.col("i") + F.col("_s.i"), "j": F.col("j") + F.col("_s.j")}).drop("_s")


def band(lat, km: float) -> Column:
    """Index of the latitude band; bands are ``km`` high."""
    return F.floor(col(lat) / math.degrees(km / EARTH_KM)).cast("int")


def columns_in(band_: Column, km: float) -> Column:
    """Cells around the globe in a band, each wide enough that two points ``km`` apart with one of them in the band or
    next to it lie in the same or in neighbouring cells."""
    if km >= EARTH_KM * math.pi / 2:
        return F.lit(1)
    high = math.degrees(km / EARTH_KM)
    widest = F.least(F.greatest(F.abs(band_ - 1), F.abs(band_ + 2)) * high, F.lit(90.0))
    ratio = F.lit(math.sin(km / EARTH_KM)) / F.greatest(F.cos(F.radians(widest)), F.lit(1e-12))
    width = F.when(ratio >= 1, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))
    return F.greatest(F.floor(F.lit(360.0) / width), F.lit(1)).cast("int")


def cell_of(lat, lon, km: float) -> Column:
    b = band(lat, km)
    n = columns_in(b, km)
    return F.struct(b.alias("b"), F.pmod(F.floor((col(lon) + 180.0) / (F.lit(360.0) / n)), n).cast("int").alias("c"))


def cells_around(lat, lon, km: float) -> Column:
    """All cells that can hold a point within ``km``."""
    # by lambdas, as nine times the whole expression makes a method that the JVM doesn't compile
    bands = F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda db: (band(lat, km) + db).cast("int"))
    wide = F.transform(bands, lambda b: F.struct(b.alias("b"), columns_in(b, km).alias("n")))
    placed = F.transform(wide, lambda t: F.struct(t["b"].alias("b"), t["n"].alias("n"), F.floor((col(lon) + 180.0) / (F.lit(360.0) / t["n"])).alias("c")))
    beside = lambda t: F.array_distinct(F.array(*(F.pmod(t["c"] + dc, t["n"]).cast("int") for dc in (-1, 0, 1))))
    return F.flatten(F.transform(placed, lambda t: F.transform(beside(t), lambda c: F.struct(t["b"].alias("b"), c.alias("c")))))


def with_cells_within(points: DataFrame, lat: str, lon: str, km: float, side: float) -> DataFrame:
    """``points`` once for each cell (``b``, ``c``) of ``side``, at least ``km``, that can hold a point within ``km`` of theirs:
    as few as the place in its cell allows."""
    reach = math.degrees(km / EARTH_KM) + 1e-7
    ratio = F.lit(math.sin(min(km / EARTH_KM, math.pi / 2))) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-12))
    # a cap that holds a pole touches all meridians
    turn = F.when(F.abs(lat) + reach >= 90, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) + 1e-7)
    banded = points.withColumn("_turn", turn).withColumn("b", F.explode(F.sequence(band(F.col(lat) - reach, side), band(F.col(lat) + reach, side))))
    sized = banded.withColumn("_in", columns_in(F.col("b"), side))
    at = lambda sign: F.floor((F.col(lon) + sign * F.col("_turn") + 180.0) / (F.lit(360.0) / F.col("_in")))
    ends = sized.withColumns({"_lo": at(-1), "_hi": at(1)})
    out = ends.withColumn("c", F.explode(F.sequence("_lo", F.least("_hi", F.col("_lo") + F.col("_in") - 1))))
    return out.withColumn("c", F.pmod("c", "_in").cast("int")).drop("_turn", "_in", "_lo", "_hi")
