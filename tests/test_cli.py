import datetime as dt
import json

import pytest

from moorage import cli
from moorage.plans import annual
from moorage.plans.pipeline import Settings
from moorage.sources import demo, sinks

BOX = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"country": "A / B"}, "geometry": {"type": "Polygon", "coordinates": [[[-25, 0], [5, 0], [5, 20], [-25, 20], [-25, 0]]]}}]}


def transport(asked):
    """A service that has one vessel at one place, whatever the dates."""

    def send(method, url, params, body, timeout):
        asked.append((url, dict(params), body and body.get("startDate")))
        if url == "report":
            first = dt.datetime.fromisoformat(params["date-range"].split(",")[0])
            hours = [{"vesselId": "v1", "shipName": "ONE", "date": str(first + dt.timedelta(hours=h)), "lat": 6.0, "lon": -12.0 + h * 1e-4, "hours": 1} for h in range(30)]
            return 200, {"entries": [{"d": hours}]}
        if url == "vessels":
            return 200, {"entries": [{"selfReportedInfo": [{"id": "v1" if params["query"] == "ONE" else "nobody"}]}]}
        return 200, {"entries": [{"id": f"{body['datasets'][0]}-{body['startDate']}", "start": f"{body['startDate']}T01:00:00Z", "end": f"{body['startDate']}T03:00:00Z", "position": {"lat": 6.0, "lon": -12.0}, "vessel": {"id": "v1"}}]}

    return send


@pytest.fixture
def files(tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(cli, "http", lambda token: transport(asked))
    config = {"paths": {k: k for k in ("report", "last_report", "events", "vessels")}, "report": {"r": 1}, "datasets": {k: k for k in cli.KINDS}}
    for name, what in (("config", config), ("region", BOX), ("settings", {"min_host_hours": 1.0, "stops": {"max_radius_km": 4.0}})):
        (tmp_path / f"{name}.json").write_text(json.dumps(what))
    return tmp_path, asked


def options(path, *names):
    return [x for n in names for x in (f"--{n}", {"token": "t", "boundaries": str(path / "region.json")}.get(n, str(path / f"{n}.json")))]


def test_demo_hours_breakdown(spark, tmp_path):
    root = str(tmp_path / "run")
    (tmp_path / "region.json").write_text(json.dumps(BOX))
    assert cli.main(["demo", "--root", root]) == 0
    scores = [r.suspicion_score for r in spark.read.option("header", True).option("inferSchema", True).csv(f"{root}/stops_scored_csv").collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) > 3
    page = spark.read.text(f"{root}/map_html", wholetext=True).first().value
    assert "tender-1" in page and "@POINTS@" not in page
    sinks.write_parquet(demo.presence(spark), f"{root}/presence")
    assert cli.main(["hours", "--root", root, "--top", "3"]) == 0
    assert cli.main(["breakdown", "--root", root, *options(tmp_path, "boundaries")]) == 0
    rows = spark.read.option("header", True).csv(f"{root}/country_year_csv").collect()
    assert {r.country for r in rows} == {"A", "B"} or {r.country for r in rows} == {"A / B"}
    assert cli.main(["validate", "--root", root, "--label", "known", "--ids", "tender-1"]) == 0


def test_all_and_validate(spark, files, capsys):
    path, asked = files
    root = str(path / "run")
    assert cli.main(["all", "--root", root, "--start", "2025-01-01", "--end", "2025-02-15", *options(path, "config", "region", "token", "settings")]) == 0
    n = len(asked)
    assert n == 2 + 2 * len(cli.KINDS)
    assert spark.read.parquet(f"{root}/stops_scored").where("duration_hours >= 30").count() == 2
    assert cli.main(["fetch", "--root", root, "--start", "2025-01-01", "--end", "2025-02-15", *options(path, "config", "region", "token")]) == 0 and len(asked) == n
    both = ["validate", "--root", root, "--label", "one", "two", "--query", "ONE", "TWO", *options(path, "config", "region", "token")]
    assert cli.main(both) == 0
    assert spark.read.option("header", True).csv(f"{root}/validation_csv").count() == 2
    with pytest.raises(SystemExit):
        cli.main(["validate", "--root", root, "--label", "x", "--query", "ONE"])


def test_annual_run_is_taken_up_again(spark, files, capsys):
    path, asked = files
    root = str(path / "years")
    more = options(path, "config", "region", "token", "boundaries")
    assert cli.main(["annual", "--root", root, "--start-year", "2019", "--end-year", "2019", *more]) == 0
    facts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert facts["completed_years"] == [2019] and facts["partial_year"] is None and facts["start_year"] == 2019
    assert cli.main(["annual", "--root", root, "--start-year", "2020", "--end-date", "2020-03-01", *more]) == 0
    facts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert facts["completed_years"] == [2019] and facts["partial_year"] == 2020 and facts["start_year"] == 2019
    where, n = facts["folder"], len(asked)
    assert cli.main(["annual", "--root", root, "--start-year", "2020", "--end-date", "2020-03-01", *more, *options(path, "settings")]) == 0
    # other thresholds are another run, with answers of its own
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["folder"] != where and len(asked) > n
    assert {(r.vessel_id, r.year) for r in annual.observed_years(spark, where).collect()} == {("v1", 2019), ("v1", 2020)}
    with pytest.raises(FileNotFoundError):
        annual.observed_years(spark, where, [2018])
    assert cli.main(["collapse", "--run", where]) == 0
    assert spark.read.parquet(f"{where}/all_years").count() == spark.read.parquet(f"{where}/country_year").select("country").distinct().count()
    assert cli.main(["export", "--run", where, "--to", str(path / "release")]) == 0
    facts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(facts["tables"]) == {"country_year", "all_years"} and all(len(f["sha256"]) == 64 for t in facts["tables"].values() for f in t["files"])
    assert sinks.read_manifest(spark, str(path / "release/manifest")) == facts


def test_settings_from_values():
    s = Settings.of({"offshore_km": 5.0, "stops": {"max_gap_hours": 9.0}})
    assert s.offshore_km == 5 and s.stops.max_gap_hours == 9 and s.stops.max_step_km == Settings().stops.max_step_km and s.port_cap_km == 100
    with pytest.raises(TypeError):
        Settings.of({"merge": 1})


def test_saved_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    sinks.save_tables({"kept_rows": df})
    sinks.save_tables({"kept_rows": df.union(df)})
    assert spark.sql("SELECT count(*) AS n FROM kept_rows").first().n == 2
    spark.sql("DROP TABLE kept_rows")
