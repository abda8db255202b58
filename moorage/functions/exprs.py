"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
#: km per degree of the local plane
KM_LON, KM_LAT = 111.320, 110.574


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance; null if any coordinate is."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dp, dl = p2 - p1, F.radians(col(lon2) - col(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(F.when(1 - a < 0, 0.0).otherwise(1 - a)))


def rounded(x, places: int) -> Column:
    """Half-to-even rounding of the scaled double."""
    k = float(10**places)
    return F.rint(col(x) * k) / k


def hours_between(start, end) -> Column:
    """Hours from start to end, to the microsecond; works on timestamps with and without zone."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end)) / 3.6e9


def hours(n: float) -> Column:
    return F.make_dt_interval(secs=F.lit(n * 3600).cast("decimal(18,6)"))


def sat_log(x, scale: float, most: float = 1.5) -> Column:
    """log1p(max(x, 0)) / log1p(scale), clipped to [0, most]; null counts as 0."""
    value = F.greatest(F.coalesce(col(x).cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.least(F.greatest(F.log1p(value) / F.log1p(F.lit(float(scale))), F.lit(0.0)), F.lit(most))


def clip(x, low: float, high: float) -> Column:
    return F.least(F.greatest(col(x), F.lit(low)), F.lit(high))


def number(x) -> Column:
    """A double, or null where the value isn't a number."""
    return F.nullif(col(x).try_cast("double"), F.lit(float("nan")))


def location_key(cluster="cluster_id", lat="lat", lon="lon") -> Column:
    """``C<id>`` for clustered stops, else ``noise:`` and the cell of a tenth of a degree; -0.0 and 0.0 differ."""
    cell = F.concat(F.lit("noise:"), rounded(lat, 1).cast("string"), F.lit(","), rounded(lon, 1).cast("string"))
    return F.when(col(cluster) >= 0, F.concat(F.lit("C"), col(cluster).cast("string"))).otherwise(cell)
