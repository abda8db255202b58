"""The analysis from presence and events to scored stops, hosts and hours."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.functions.storage import cut
from moorage.operators.cluster import cluster_summary, dbscan, infer_ports
from moorage.operators.hours import identity_table, vessel_hours, window_of
from moorage.operators.match import add_event_matches, add_nearest_port
from moorage.operators.score import candidate_hosts, score_stops
from moorage.operators.stops import StopRules, dedup_events, detect_stops


@dataclass(frozen=True)
class Settings:
    """Defaults are the production ones."""

    stops: StopRules = StopRules()
    cluster_eps_km: float = 8.0
    cluster_min_samples: int = 2
    port_radius_km: float = 3.0
    event_space_km: float = 20.0
    event_time_hours: float = 24.0
    port_cap_km: float = 100.0
    min_host_hours: float = 8.0
    offshore_km: float = 20.0


    @classmethod
    def of(cls, values: dict) -> Settings:
        """The defaults with ``values`` in place of some, those of the stop rules under ``stops``; unknown names are errors."""
        rules = replace(cls().stops, **values.get("stops", {}))
        return replace(cls(), **{**values, "stops": rules})


@dataclass
class Analysis:
    stops: DataFrame
    ports: DataFrame
    clusters: DataFrame
    hosts: DataFrame
    hours: DataFrame
    events: dict[str, DataFrame]


def enrich(stops: DataFrame, events: dict[str, DataFrame], settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Clustered stops with nearest port and event matches, written once as several results read them; and the ports."""
    clustered = dbscan(stops, settings.cluster_eps_km, settings.cluster_min_samples, "stop_id")
    ports = cut(infer_ports(events["port_visits"], settings.port_radius_km))
    near = add_nearest_port(clustered, ports)
    return cut(add_event_matches(near, events, settings.event_space_km, settings.event_time_hours)), ports


def analyze(presence: DataFrame, events: dict[str, DataFrame], settings: Settings = Settings(), tie: tuple[str, ...] = ("event_id",), time: str = "date") -> Analysis:
    single = {k: dedup_events(v, ["start", "end"]) for k, v in events.items()}
    stops = cut(detect_stops(presence, settings.stops, tie))
    enriched, ports = enrich(stops, single, settings)
    clusters = cluster_summary(enriched)
    scored = cut(score_stops(enriched, clusters, settings.port_cap_km))
    hosts = candidate_hosts(scored, settings.min_host_hours)
    span = window_of(presence, time)
    kind = presence.schema[time].dataType.simpleString()
    a, b = (F.lit(v).cast(kind) for v in span)
    identity = identity_table(presence, [time, *tie])
    hours = vessel_hours(scored, identity, single.get("loitering"), a, b, settings.offshore_km)
    return Analysis(scored, ports, clusters, hosts, hours, single)
