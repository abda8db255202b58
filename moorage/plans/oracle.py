"""DuckDB SQL of the catalogue's queries, put together from common table expressions."""

from __future__ import annotations

GAP, STEP, RADIUS, LONG = 12.0, 5.0, 3.0, 4.0


def hav(a: str, b: str, c: str, d: str) -> str:
    h = f"(pow(sin(radians(({c}) - ({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians(({d}) - ({b})) / 2), 2))"
    return f"(2 * 6371.0088::DOUBLE * atan2(sqrt({h}), sqrt(greatest(1 - {h}, 0))))"


def sat(x: str, scale: int) -> str:
    return f"least(greatest(ln(1 + greatest(coalesce(({x})::DOUBLE, 0), 0)) / ln(1 + {scale}::DOUBLE), 0), 1.5::DOUBLE)"


def r(x: str, n: int) -> str:
    return f"round_even(({x})::DOUBLE, {n})"


def components(nodes: str, eps: float, name: str) -> str:
    """``name``(node, component, size) over ``nodes``(node, lat, lon)."""
    return f"""
    {name}_xy AS (SELECT node, lon * 111.320::DOUBLE * cos(radians((SELECT avg(lat) FROM {nodes}))) AS x, lat * 110.574::DOUBLE AS y FROM {nodes}),
    {name}_e AS (SELECT a.node AS a, b.node AS b FROM {name}_xy a JOIN {name}_xy b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= {eps}),
    {name}_r AS (SELECT a, b FROM {name}_e UNION SELECT {name}_r.a, e.b FROM {name}_r JOIN {name}_e e ON {name}_r.b = e.a),
    {name} AS (SELECT a AS node, min(b) AS component, count(*) AS size FROM {name}_r GROUP BY a)"""


PRESENCE = """
    presence_v AS (SELECT event_id, user_id AS vessel_id, ts, event_type, value,
        4 + (user_id % 10) * 1.0 + value * 1e-4 AS lat, -18 + (user_id % 7) * 1.0 + cast(json_extract(props, '$.k') AS INT) * 5e-4 AS lon FROM events),
    identity_v AS (SELECT c_custkey AS vessel_id, c_name AS ship_name, n_name AS flag, c_mktsegment AS vessel_type FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
    evt AS (SELECT *, ts AS start, ts + to_microseconds(cast(floor(value * 60e6) AS BIGINT)) AS fin FROM presence_v)"""

STEPS = PRESENCE + f""",
    steps AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3.6e9 AS dt_h, {hav('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS step_km
        FROM presence_v WINDOW w AS (PARTITION BY vessel_id ORDER BY ts, event_id))"""


def stops_cte(gap: float, step: float, radius: float) -> str:
    return STEPS + f""",
    numbered AS (SELECT *, cast(sum(CASE WHEN coalesce(dt_h > {gap} OR step_km > {step}, false) THEN 1 ELSE 0 END) OVER (PARTITION BY vessel_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS episode FROM steps),
    grouped AS (SELECT vessel_id, episode, min(ts) AS start, max(ts) AS fin, count(*) AS n, median(lat) AS clat, median(lon) AS clon FROM numbered GROUP BY ALL HAVING count(*) >= 2),
    reach AS (SELECT g.*, (epoch_us(fin) - epoch_us(start)) / 3.6e9 + 1.0 AS duration_hours, (SELECT max({hav('p.lat', 'p.lon', 'g.clat', 'g.clon')}) FROM numbered p WHERE p.vessel_id = g.vessel_id AND p.episode = g.episode) AS radius_km FROM grouped g),
    stops_v AS (SELECT printf('S%08d', row_number() OVER (ORDER BY vessel_id, start)) AS stop_id, vessel_id, ship_name, flag, vessel_type, start, fin, duration_hours, n AS n_hourly_points, clat AS lat, clon AS lon, radius_km
        FROM reach LEFT JOIN identity_v USING (vessel_id) WHERE duration_hours >= {LONG} AND radius_km <= {radius})"""


STOPS = stops_cte(GAP, STEP, RADIUS)
PORTS = """,
    visits AS (SELECT event_id AS node, lat, lon, event_id FROM evt WHERE event_type = 'signup'),""" + components("visits", 3.0, "port_c") + """,
    ports_v AS (SELECT dense_rank() OVER (ORDER BY component) - 1 AS port_id, lat, lon, n_visits FROM
        (SELECT component, median(lat) AS lat, median(lon) AS lon, count(event_id) AS n_visits FROM port_c JOIN visits USING (node) GROUP BY component))"""
CLUSTERS = """,
    stop_nodes AS (SELECT stop_id AS node, lat, lon FROM stops_v),""" + components("stop_nodes", 0.4, "stop_c") + """,
    labels AS (SELECT node AS stop_id, cast(CASE WHEN size < 2 THEN -1 ELSE dense_rank() OVER (PARTITION BY size < 2 ORDER BY component) - 1 END AS INT) AS cluster_id FROM stop_c),
    clustered AS (SELECT s.*, cluster_id FROM stops_v s JOIN labels USING (stop_id)),
    summary AS (SELECT cluster_id, median(lat) AS cluster_lat, median(lon) AS cluster_lon, sum(duration_hours) AS cluster_total_stop_hours, count(DISTINCT vessel_id) AS cluster_unique_vessels,
        count(stop_id) AS cluster_stop_episodes, min(start) AS cluster_first_seen, max(fin) AS cluster_last_seen FROM clustered WHERE cluster_id >= 0 GROUP BY cluster_id)"""
NEAREST = f""",
    nearest AS (SELECT stop_id, min(km) AS nearest_port_km, arg_min(port_id, (km, port_id)) AS nearest_port_id FROM
        (SELECT stop_id, port_id, {hav('p.lat', 'p.lon', 's.lat', 's.lon')} AS km FROM stops_v s CROSS JOIN ports_v p) GROUP BY stop_id)"""
MATCHES = "".join(f""",
    m_{kind} AS (SELECT stop_id, count(e.event_id) AS n FROM stops_v s LEFT JOIN evt e ON e.event_type = '{source}' AND e.start <= s.fin + INTERVAL 24 HOUR AND e.fin >= s.start - INTERVAL 24 HOUR
        AND {hav('e.lat', 'e.lon', 's.lat', 's.lon')} <= 3.0 GROUP BY stop_id)""" for kind, source in (("gaps", "error"), ("encounters", "purchase"), ("loitering", "view")))
MATCHED = MATCHES + """,
    matches AS (SELECT stop_id, g.n AS nearby_gaps, e.n AS nearby_encounters, l.n AS nearby_loitering FROM m_gaps g JOIN m_encounters e USING (stop_id) JOIN m_loitering l USING (stop_id))"""
SCORED = STOPS + PORTS + CLUSTERS + NEAREST + MATCHED + f""",
    scored AS (SELECT c.*, nearest_port_km, nearest_port_id, nearby_gaps, nearby_encounters, nearby_loitering, cluster_total_stop_hours, cluster_unique_vessels,
        {r(f"100 * (0.28::DOUBLE * {sat('duration_hours', 72)} + 0.22::DOUBLE * least(greatest(coalesce(nearest_port_km, 0) / 100, 0), 1) + 0.18::DOUBLE * {sat('nearby_gaps', 3)} + 0.14::DOUBLE * {sat('nearby_encounters', 3)} + 0.10::DOUBLE * {sat('cluster_unique_vessels', 10)} + 0.08::DOUBLE * {sat('cluster_total_stop_hours', 500)})", 2)} AS suspicion_score
        FROM clustered c JOIN nearest USING (stop_id) JOIN matches USING (stop_id) LEFT JOIN summary USING (cluster_id))"""
HOSTS = SCORED + f""",
    host_base AS (SELECT cluster_id, vessel_id, arg_min(ship_name, (-suspicion_score, stop_id)) AS ship_name, arg_min(flag, (-suspicion_score, stop_id)) AS flag, arg_min(vessel_type, (-suspicion_score, stop_id)) AS vessel_type,
        sum(duration_hours) AS host_stop_hours, count(stop_id) AS host_episodes, median(lat) AS lat, median(lon) AS lon, median(nearest_port_km) AS nearest_port_km, cast(sum(nearby_gaps) AS BIGINT) AS nearby_gaps,
        cast(sum(nearby_encounters) AS BIGINT) AS nearby_encounters, min(cluster_total_stop_hours) AS cluster_total_stop_hours, min(cluster_unique_vessels) AS cluster_unique_vessels
        FROM scored WHERE cluster_id >= 0 GROUP BY cluster_id, vessel_id HAVING sum(duration_hours) >= 8),
    hosts AS (SELECT *, greatest(cluster_unique_vessels - 1, 0) AS other_vessels, host_stop_hours / nullif(cluster_total_stop_hours, 0) AS host_share,
        {r(f"100 * (0.38::DOUBLE * {sat('host_stop_hours', 1000)} + 0.28::DOUBLE * {sat('greatest(cluster_unique_vessels - 1, 0)', 10)} + 0.14::DOUBLE * {sat('nearby_encounters', 5)} + 0.10::DOUBLE * {sat('nearby_gaps', 5)} + 0.10::DOUBLE * least(greatest(coalesce(nearest_port_km, 0) / 100, 0), 1))", 2)} AS host_score FROM host_base)"""
AREAS = """
    areas AS (SELECT -18.5 + (n_nationkey % 5) * 1.5 AS x0, -18.5 + (n_nationkey % 5) * 1.5 + 1.2 + CASE WHEN n_nationkey % 3 = 0 THEN 0.8 ELSE 0 END AS x1, 3.5 + (n_nationkey // 5) * 2 AS y0, 5.5 + (n_nationkey // 5) * 2 AS y1,
        unnest(string_split(CASE WHEN n_nationkey % 6 = 0 THEN n_name || ' / NATION_' || ((n_nationkey + 1) % 25) ELSE n_name END, ' / ')) AS name FROM nation WHERE n_nationkey % 5 < 4)"""


def located(rows: str, key: str) -> str:
    return f"SELECT {key}, coalesce(string_agg(DISTINCT name, ' / ' ORDER BY name), 'Unassigned') AS country FROM {rows} LEFT JOIN areas ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY {key}"


def summed(rows: str, keys: str) -> str:
    off = "CASE WHEN coalesce(nearest_port_km, 'inf'::DOUBLE) >= 20 THEN duration_hours ELSE 0 END"
    place = "CASE WHEN cluster_id >= 0 THEN 'C' || cluster_id ELSE 'noise:' || round_even(lat, 1) || ',' || round_even(lon, 1) END"
    top = "(SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY duration_hours DESC, start, stop_id DESC) AS top_n FROM {t})".format(k=keys, t=rows)
    first = lambda c, n: f"max(CASE WHEN top_n = 1 THEN {c} END) AS longest_stop_{n}"
    return f"""SELECT {keys}, count(stop_id) AS stop_episodes, sum(duration_hours) AS total_stop_hours, sum({off}) AS offshore_stop_hours, max(duration_hours) AS longest_stop_hours, count(DISTINCT {place}) AS distinct_locations,
        median(nearest_port_km) AS median_port_km, max(nearest_port_km) AS max_port_km, min(start) AS first_seen, max(fin) AS last_seen, cast(sum(nearby_encounters) AS BIGINT) AS nearby_encounters, cast(sum(nearby_gaps) AS BIGINT) AS nearby_gaps,
        max(cluster_unique_vessels) AS shared_location_max_vessels, {first('lat', 'lat')}, {first('lon', 'lon')}, {first('start', 'start')}, {first('fin', 'end')}, {first('nearest_port_km', 'port_km')} FROM {top} GROUP BY {keys}"""


ROUNDED = ("total_stop_hours", "offshore_stop_hours", "longest_stop_hours", "median_port_km", "max_port_km", "longest_stop_port_km", "gfw_loitering_hours")


def finished(rows: str, window_hours: str) -> str:
    """Shares before rounding, then the rounded columns."""
    share = r(f"total_stop_hours / ({window_hours})", 3)
    cells = ", ".join(f"{r(c, 1)} AS {c}" for c in ROUNDED)
    return f"""SELECT * REPLACE ({cells}), {share} AS share_of_window, {r('offshore_stop_hours / nullif(total_stop_hours, 0)', 3)} AS offshore_share, {share} >= 0.95 AND distinct_locations = 1 AS likely_fixed_installation FROM {rows}"""


YEARLY = AREAS + """,
    ys AS (SELECT * FROM (SELECT printf('S%08d', o_orderkey) AS stop_id, o_custkey AS vessel_id, o_orderdate AS start, o_orderdate + to_hours(cast(floor(o_totalprice / 5000) AS BIGINT)) AS fin, cast(floor(o_totalprice / 5000) + 1 AS DOUBLE) AS duration_hours,
        4 + (o_custkey % 10) * 1.0 + (o_orderkey % 7) * 0.05::DOUBLE AS lat, -18 + (o_custkey % 7) * 1.0 + (o_orderkey % 5) * 0.05::DOUBLE AS lon, CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_orderkey % 40 AS DOUBLE) END AS nearest_port_km,
        cast(o_custkey % 5 - 1 AS INT) AS cluster_id, o_orderkey % 3 AS nearby_encounters, o_orderkey % 4 AS nearby_gaps, CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 13 + 1 END AS cluster_unique_vessels FROM orders) WHERE duration_hours >= 4),
    ye AS (SELECT o_orderkey AS event_id, o_custkey AS vessel_id, o_orderdate AS start, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 9 HOUR END AS fin,
        4 + (o_custkey % 10) * 1.0 + (o_orderkey % 7) * 0.05::DOUBLE AS lat, -18 + (o_custkey % 7) * 1.0 + (o_orderkey % 5) * 0.05::DOUBLE AS lon FROM orders WHERE o_orderkey % 4 = 0),
    observed AS (SELECT DISTINCT vessel_id, year FROM (SELECT vessel_id, unnest([year(start), year(fin + INTERVAL 1 HOUR), year(start) + 1]) AS year FROM ys) WHERE year BETWEEN 1995 AND 2001)"""
ANNUAL = PRESENCE + "," + YEARLY + f""",
    years AS (SELECT year, make_timestamp(year, 1, 1, 0, 0, 0) AS a, least(make_timestamp(year + 1, 1, 1, 0, 0, 0), TIMESTAMP '2001-09-01') AS b FROM (SELECT unnest(range(1995, 2002)) AS year)),
    stop_country AS ({located('ys', 'stop_id')}),
    event_country AS ({located('ye', 'event_id')}),
    parts AS (SELECT stop_id, vessel_id, country, year, a, b, lat, lon, nearest_port_km, cluster_id, nearby_encounters, nearby_gaps, cluster_unique_vessels, greatest(start, a) AS start,
        least(fin + INTERVAL 1 HOUR, b) - INTERVAL 1 HOUR AS fin, (epoch_us(least(fin + INTERVAL 1 HOUR, b)) - epoch_us(greatest(start, a))) / 3.6e9 AS duration_hours
        FROM ys JOIN stop_country USING (stop_id) JOIN years ON start < b AND fin + INTERVAL 1 HOUR > a),
    ev AS (SELECT country, year, vessel_id, count(*) AS gfw_loitering_events, sum(h) AS gfw_loitering_hours FROM
        (SELECT *, (epoch_us(least(coalesce(fin, b), b)) - epoch_us(greatest(start, a))) / 3.6e9 AS h FROM ye JOIN event_country USING (event_id) JOIN years ON start < b AND coalesce(fin, b) > a) WHERE h > 0 GROUP BY ALL),
    annual_sums AS ({summed('parts', 'country, year, vessel_id, a, b')}),
    annual_base AS (SELECT s.*, coalesce(gfw_loitering_events, 0) AS gfw_loitering_events, coalesce(gfw_loitering_hours, 0) AS gfw_loitering_hours FROM annual_sums s LEFT JOIN ev USING (country, year, vessel_id)),
    annual_done AS ({finished('annual_base', '(epoch_us(b) - epoch_us(a)) / 3.6e9')}),
    annual AS (SELECT * EXCLUDE (a, b), a AS window_start, b AS window_end, b = make_timestamp(year + 1, 1, 1, 0, 0, 0) AS complete_calendar_year, 'stop centroid / event representative position' AS country_assignment FROM annual_done LEFT JOIN identity_v USING (vessel_id)),
    windows AS (SELECT DISTINCT year, window_start, window_end, (epoch_us(window_end) - epoch_us(window_start)) / 8.64e10 AS days FROM annual),
    exposure AS (SELECT vessel_id, count(DISTINCT year) AS observed_calendar_years, sum(days) AS observed_period_days, min(year) AS first_observed_year, max(year) AS last_observed_year FROM observed JOIN windows USING (year) GROUP BY vessel_id)"""
COLLAPSED = ANNUAL + f""",
    top_year AS (SELECT country, vessel_id, longest_stop_hours, longest_stop_lat, longest_stop_lon, longest_stop_start, longest_stop_end, longest_stop_port_km FROM annual QUALIFY row_number() OVER (PARTITION BY country, vessel_id ORDER BY longest_stop_hours DESC, year) = 1),
    sums AS (SELECT country, vessel_id, sum(total_stop_hours) AS total_stop_hours, sum(offshore_stop_hours) AS offshore_stop_hours, cast(sum(stop_episodes) AS BIGINT) AS stop_episodes, sum(gfw_loitering_hours) AS gfw_loitering_hours,
        cast(sum(nearby_encounters) AS BIGINT) AS nearby_encounters, cast(sum(nearby_gaps) AS BIGINT) AS nearby_gaps, count(DISTINCT year) AS years_with_stops_in_country, min(first_seen) AS first_stop, max(last_seen) AS last_stop,
        max(distinct_locations) AS max_annual_distinct_locations, max(max_port_km) AS max_port_km, max(shared_location_max_vessels) AS shared_location_max_vessels, bool_or(likely_fixed_installation) AS likely_fixed_installation_in_any_year,
        cast(coalesce(sum(gfw_loitering_events), 0) AS BIGINT) AS gfw_loitering_event_years, arg_max(ship_name, year) AS ship_name, arg_max(flag, year) AS flag, arg_max(vessel_type, year) AS vessel_type,
        coalesce(string_agg(DISTINCT ship_name, ' | ' ORDER BY ship_name), '') AS ship_names_seen, coalesce(string_agg(DISTINCT flag, ' | ' ORDER BY flag), '') AS flags_seen FROM annual GROUP BY country, vessel_id),
    rates AS (SELECT *, {r('total_stop_hours / (observed_period_days / 365.25::DOUBLE)', 2)} AS stop_hours_per_observed_year, {r('offshore_stop_hours / (observed_period_days / 365.25::DOUBLE)', 2)} AS offshore_stop_hours_per_observed_year,
        {r('gfw_loitering_hours / (observed_period_days / 365.25::DOUBLE)', 2)} AS gfw_loitering_hours_per_observed_year, {r('offshore_stop_hours / nullif(total_stop_hours, 0)', 4)} AS offshore_share, observed_period_days < 365 AS short_observation_history,
        'regional low-speed-presence years; 365.25-day equivalent' AS normalization_basis, {r('observed_period_days / 365.25::DOUBLE', 6)} AS observed_year_equivalents, (SELECT min(window_start) FROM windows) AS window_start, (SELECT max(window_end) FROM windows) AS window_end
        FROM sums JOIN exposure USING (vessel_id) JOIN top_year USING (country, vessel_id)),
    collapsed AS (SELECT row_number() OVER (ORDER BY stop_hours_per_observed_year DESC, offshore_stop_hours_per_observed_year DESC, total_stop_hours DESC, country, vessel_id) AS normalized_rank, * FROM rates)"""


def run(ctes: str, final: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{final}"


def oracle_sql() -> dict[str, str]:
    stop_columns = f'stop_id, vessel_id, ship_name, flag, vessel_type, start, fin AS "end", duration_hours, n_hourly_points, lat, lon, {r("radius_km", 6)} AS radius_km, 1.0::DOUBLE AS mean_presence_hours'
    kind = lambda source, name: f"(SELECT '{name}' AS event_kind, event_id, start, fin AS \"end\", lat, lon, vessel_id FROM evt WHERE event_type = '{source}')"
    checks = [
        ("totals_agree", "SELECT count(*) FROM collapsed c FULL JOIN (SELECT country, vessel_id, sum(total_stop_hours) AS t FROM annual GROUP BY ALL) a USING (country, vessel_id) WHERE c.total_stop_hours IS NULL OR a.t IS NULL OR abs(c.total_stop_hours - a.t) > 1e-6"),
        ("annual_keys_unique", "SELECT count(*) FROM (SELECT 1 FROM annual GROUP BY country, vessel_id, year HAVING count(*) > 1)"),
        ("collapsed_keys_unique", "SELECT count(*) FROM (SELECT 1 FROM collapsed GROUP BY country, vessel_id HAVING count(*) > 1)"),
        ("rank_descends", "SELECT count(*) FROM (SELECT stop_hours_per_observed_year AS v, lag(stop_hours_per_observed_year) OVER (ORDER BY normalized_rank) AS p FROM collapsed) WHERE v > p"),
        ("window_starts_in_january", "SELECT count(*) FROM annual WHERE date_trunc('year', window_start) <> window_start"),
        ("one_window_a_year", "SELECT count(*) FROM (SELECT 1 FROM windows GROUP BY year HAVING count(*) > 1)"),
        ("complete_year_label", "SELECT count(*) FROM annual WHERE complete_calendar_year <> (window_end = window_start + INTERVAL 1 YEAR)"),
        ("denominator_positive", "SELECT count(*) FROM collapsed WHERE observed_year_equivalents <= 0"),
        ("rate_formula", "SELECT count(*) FROM collapsed WHERE abs(total_stop_hours / observed_year_equivalents - stop_hours_per_observed_year) > 0.011"),
    ]
    best = lambda score, rows, name: f"(SELECT max({score}) FROM {rows} WHERE vessel_id IN (7, 11)) AS best_{name}_score, (SELECT count(*) FILTER ({score} > (SELECT max({score}) FROM {rows} WHERE vessel_id IN (7, 11))) + 1 FROM {rows}) AS best_{name}_rank, (SELECT {r(f'100.0 * count(*) FILTER ({score} <= (SELECT max({score}) FROM {rows} WHERE vessel_id IN (7, 11))) / count(*)', 2)} FROM {rows}) AS best_{name}_percentile"
    vessel = SCORED + f""",
        v_sums AS ({summed('scored', 'vessel_id')}),
        w AS (SELECT min(ts) AS a, max(ts) + INTERVAL 1 HOUR AS b FROM presence_v),
        v_ev AS (SELECT vessel_id, count(*) AS gfw_loitering_events, sum(h) AS gfw_loitering_hours FROM (SELECT vessel_id, (epoch_us(least(fin, b)) - epoch_us(greatest(start, a))) / 3.6e9 AS h FROM evt, w WHERE event_type = 'view') WHERE h > 0 GROUP BY vessel_id),
        v_base AS (SELECT s.*, coalesce(gfw_loitering_events, 0) AS gfw_loitering_events, coalesce(gfw_loitering_hours, 0) AS gfw_loitering_hours, a AS window_start, b AS window_end FROM v_sums s LEFT JOIN v_ev USING (vessel_id), w)"""
    return {
        "presence_standardize": run(PRESENCE, "SELECT event_id, vessel_id, ts AS timestamp, lat, lon FROM presence_v"),
        "haversine_steps": run(STEPS, f"SELECT event_id, {r('dt_h', 6)} AS dt_h, {r('step_km', 6)} AS step_km FROM steps"),
        "stop_episodes": run(STOPS, f"SELECT {stop_columns} FROM stops_v"),
        "stop_episodes_reference_params": run(stops_cte(2.25, 5.0, 5.0), f"SELECT {stop_columns} FROM stops_v"),
        "event_dedup": run(PRESENCE, """SELECT event_id, start, vessel_id FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY start, vessel_id) AS n FROM (SELECT event_id, start, vessel_id FROM evt WHERE event_type = 'view'
            UNION ALL SELECT event_id, start + INTERVAL 1 HOUR, vessel_id FROM evt WHERE event_type = 'view' AND event_id % 3 = 0 UNION ALL SELECT NULL, start, vessel_id FROM evt WHERE event_type = 'view' AND event_id % 5 = 0)) WHERE n = 1"""),
        "inferred_ports": run(PRESENCE + PORTS, "SELECT * FROM ports_v"),
        "nearest_port": run(STOPS + PORTS + NEAREST, f"SELECT stop_id, {r('nearest_port_km', 6)} AS nearest_port_km, nearest_port_id FROM nearest"),
        "event_match_counts": run(STOPS + MATCHED, "SELECT * FROM matches"),
        "dbscan_clusters": run(STOPS + CLUSTERS, "SELECT stop_id, cluster_id FROM labels"),
        "cluster_summary": run(STOPS + CLUSTERS, f"SELECT * REPLACE ({r('cluster_total_stop_hours', 6)} AS cluster_total_stop_hours) FROM summary"),
        "stop_scores": run(SCORED, f"SELECT stop_id, cluster_id, cluster_unique_vessels, {r('nearest_port_km', 6)} AS nearest_port_km, nearby_gaps, nearby_encounters, suspicion_score FROM scored"),
        "candidate_hosts": run(HOSTS, f"SELECT * REPLACE ({', '.join(f'{r(c, 6)} AS {c}' for c in ('host_stop_hours', 'nearest_port_km', 'cluster_total_stop_hours', 'host_share'))}) FROM hosts"),
        "vessel_identity": run(PRESENCE, "SELECT DISTINCT vessel_id, ship_name, flag, vessel_type FROM presence_v LEFT JOIN identity_v USING (vessel_id)"),
        "vessel_hours": run(vessel, f"SELECT * FROM ({finished('v_base', '(epoch_us(window_end) - epoch_us(window_start)) / 3.6e9')}) LEFT JOIN identity_v USING (vessel_id)"),
        "longest_stop": run(YEARLY, "SELECT vessel_id, duration_hours AS longest_stop_hours, lat AS longest_stop_lat, lon AS longest_stop_lon, start AS longest_stop_start, fin AS longest_stop_end, nearest_port_km AS longest_stop_port_km FROM ys QUALIFY row_number() OVER (PARTITION BY vessel_id ORDER BY duration_hours DESC, start, stop_id DESC) = 1"),
        "event_hours_clipped": run(YEARLY, f"""SELECT vessel_id, count(*) AS gfw_loitering_events, {r('sum(h)', 6)} AS gfw_loitering_hours FROM (SELECT vessel_id, (epoch_us(least(greatest(coalesce(fin, TIMESTAMP '1997-01-01'), TIMESTAMP '1996-01-01'), TIMESTAMP '1997-01-01'))
            - epoch_us(least(greatest(start, TIMESTAMP '1996-01-01'), TIMESTAMP '1997-01-01'))) / 3.6e9 AS h FROM ye) WHERE h > 0 GROUP BY vessel_id"""),
        "country_assignment": run(STOPS + "," + AREAS, located("stops_v", "stop_id")),
        "country_year_hours": run(ANNUAL, "SELECT * FROM annual"),
        "rows_by_year": run(ANNUAL, "SELECT year, count(*) AS n_rows FROM annual GROUP BY year"),
        "observed_exposure": run(ANNUAL, f"SELECT * REPLACE ({r('observed_period_days', 6)} AS observed_period_days) FROM exposure"),
        "membership_violations": run(ANNUAL, "SELECT DISTINCT vessel_id, year FROM annual WHERE (vessel_id, year) NOT IN (SELECT (vessel_id, year) FROM observed WHERE vessel_id % 7 <> 0)"),
        "duplicate_keys": run(ANNUAL, "SELECT country, vessel_id, year, count(*) AS n_rows FROM (SELECT country, vessel_id, year FROM annual UNION ALL SELECT country, vessel_id, year FROM annual WHERE vessel_id % 9 = 0) GROUP BY ALL HAVING count(*) > 1"),
        "window_conflicts": run(ANNUAL, "SELECT year, count(*) AS n_windows, min(days) AS min_days FROM (SELECT year, days FROM windows UNION ALL SELECT year, 0 FROM windows WHERE year = 1997) GROUP BY year HAVING count(*) > 1 OR min(days) <= 0"),
        "all_years_collapse": run(COLLAPSED, "SELECT * FROM collapsed"),
        "names_seen": run(COLLAPSED, "SELECT country, vessel_id, ship_names_seen, flags_seen FROM collapsed"),
        "reconciliation": run(COLLAPSED, " UNION ALL ".join(f"SELECT '{name}' AS invariant, ({sql}) AS violations" for name, sql in checks)),
        "rank_monotonic": run(COLLAPSED, "SELECT normalized_rank, country, vessel_id, stop_hours_per_observed_year FROM collapsed"),
        "validation_summary": run(HOSTS, f"""SELECT 'known' AS label, cast(NULL AS VARCHAR) AS imo, '11;404404;7' AS gfw_vessel_ids, (SELECT count(*) FROM presence_v WHERE vessel_id IN (7, 11)) AS presence_rows,
            (SELECT count(*) FROM scored WHERE vessel_id IN (7, 11)) AS stop_episodes, (SELECT {r('coalesce(sum(duration_hours), 0)', 2)} FROM scored WHERE vessel_id IN (7, 11)) AS total_stop_hours, {best('suspicion_score', 'scored', 'stop')},
            (SELECT count(*) FROM hosts WHERE vessel_id IN (7, 11)) AS host_rows, {best('host_score', 'hosts', 'host')}, (SELECT count(*) FROM scored WHERE vessel_id IN (7, 11)) > 0 AS detected_as_stop, (SELECT count(*) FROM hosts WHERE vessel_id IN (7, 11)) > 0 AS detected_as_host"""),
        "sql_top_offshore_stops": run(SCORED, 'SELECT stop_id, vessel_id, start, fin AS "end", duration_hours, nearby_gaps, nearby_encounters, suspicion_score FROM scored WHERE nearest_port_km >= 0.2 ORDER BY suspicion_score DESC, stop_id LIMIT 50'),
        "sql_hosts": run(HOSTS, "SELECT cluster_id, vessel_id, other_vessels, host_score FROM hosts WHERE other_vessels >= 1 ORDER BY host_score DESC, cluster_id, vessel_id LIMIT 50"),
        "sql_shared_clusters": run(SCORED, f"SELECT cluster_id, count(*) AS stop_episodes, count(DISTINCT vessel_id) AS vessels, {r('sum(duration_hours)', 6)} AS stop_hours, {r('median(nearest_port_km)', 6)} AS median_port_km FROM scored WHERE cluster_id >= 0 GROUP BY cluster_id HAVING count(DISTINCT vessel_id) >= 2"),
        "top_stops_map": run(SCORED, f"SELECT stop_id, lat, lon, suspicion_score, {r('4 + least(coalesce(suspicion_score, 0) / 25, 5)', 6)} AS marker_radius FROM scored ORDER BY suspicion_score DESC, stop_id LIMIT 100"),
        "top_hosts_map": run(HOSTS, "SELECT cluster_id, vessel_id, lat, lon, host_score FROM hosts ORDER BY host_score DESC, cluster_id, vessel_id LIMIT 50"),
        "union_missing_columns": run(PRESENCE, f"SELECT event_kind, event_id, start, NULL::TIMESTAMP AS \"end\", lat, lon, NULL::BIGINT AS vessel_id FROM {kind('error', 'gaps')} UNION ALL SELECT event_kind, event_id, start, \"end\", NULL, lon, vessel_id FROM {kind('signup', 'port_visits')}"),
        "replace_year_slice": "SELECT o_orderkey AS id, year(o_orderdate) AS year, 'old' AS run FROM orders WHERE year(o_orderdate) <> 1998 UNION ALL SELECT o_orderkey, year(o_orderdate), 'new' FROM orders WHERE year(o_orderdate) = 1998 AND o_orderkey % 2 = 0",
        "presence_json_flatten": run(PRESENCE, "SELECT cast(vessel_id AS VARCHAR) AS vessel_id, cast(ts AS VARCHAR) AS date, cast(trunc(value) AS DOUBLE) AS lat FROM presence_v"),
        "events_json_flatten": run(PRESENCE, "SELECT 'gaps' AS event_kind, cast(event_id AS VARCHAR) AS event_id, 'gap' AS type, ts AS start, cast(trunc(value) AS DOUBLE) AS lat, NULL::DOUBLE AS lon, cast(vessel_id AS VARCHAR) AS vessel_id FROM presence_v WHERE event_type = 'error'"),
        "identity_json_flatten": run(PRESENCE, "SELECT 'v' || vessel_id AS vessel_id, 'n' || max(event_id) AS ship_name, cast(vessel_id * 3 AS VARCHAR) AS imo FROM presence_v GROUP BY vessel_id"),
        "date_chunks": "SELECT cast(d AS DATE) AS chunk_start, least(cast(d + INTERVAL 31 DAY AS DATE), DATE '2020-02-03') AS chunk_end FROM (SELECT unnest(range(TIMESTAMP '2019-01-01', TIMESTAMP '2020-02-03', INTERVAL 31 DAY)) AS d)",
    }
