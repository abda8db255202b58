"""Results as files, tables and views."""

from __future__ import annotations

import hashlib
import html
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; a missing one is empty with ``schema``."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    if schema is None:
        raise FileNotFoundError(path)
    return spark.createDataFrame([], schema)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """CSV with a header; one folder for each value of ``by``."""
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with given types, so that identifiers stay text."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)


def replace_years(df: DataFrame, path: str) -> None:
    """Writes the years that ``df`` has and leaves the others as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def replace_slice(old: DataFrame, new: DataFrame, key: str = "year") -> DataFrame:
    """``old`` without the keys that ``new`` has, and ``new``; columns that one side lacks are null."""
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Views for SQL, by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_key(*inputs: dict) -> str:
    """Sixteen hex digits that name a run's folder by its inputs."""
    return hashlib.sha256(json.dumps(inputs, sort_keys=True).encode()).hexdigest()[:16]


def save_tables(tables: dict[str, DataFrame], database: str | None = None) -> None:
    """Tables that outlast the session, replaced if they are there; in ``database`` if given."""
    for name, df in tables.items():
        spark = df.sparkSession
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`" if database else f"`{name}`")


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """A stored manifest, None if there is none; one that was being replaced when a run broke off is still read."""
    for at in (path, f"{path}.before"):
        if exists(spark, f"{at}/_SUCCESS"):
            return json.loads(spark.read.text(at, wholetext=True).first().value)
    return None


def write_manifest(spark: SparkSession, facts: dict, path: str) -> None:
    """Replaces a stored manifest; the one before stays beside it."""
    before = read_manifest(spark, path)
    put = lambda what, at: spark.createDataFrame([(json.dumps(what, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(at)
    if before is not None:
        put(before, f"{path}.before")
    put(facts, path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def export_release(tables: dict[str, DataFrame], path: str, compression: str = "zstd", files: int = 1) -> dict:
    """Writes tables for publication, reads them back, and gives their manifest, which is stored with them: rows, columns
    with types, a checksum of every file. A table that doesn't come back as it was is an error.

    ``compression``: ``brotli`` only where a codec for it is installed; ``files``: of each table.
    """
    facts: dict = {"compression": compression, "tables": {}}
    spark = None
    for name, df in tables.items():
        spark = df.sparkSession
        at = f"{path}/{name}"
        df.repartition(files).write.mode("overwrite").option("compression", compression).parquet(at)
        back = spark.read.parquet(at)
        digest = lambda t: t.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*sorted(t.columns)).cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if back.schema.simpleString() != df.schema.simpleString() or digest(back) != digest(df):
            raise ValueError(f"{name} was not read back as it was written")
        sums = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(at).select("path", "length", F.sha2("content", 256).alias("sha"))
        found = sorted((r.path.rpartition("/")[2], r.length, r.sha) for r in sums.collect())
        facts["tables"][name] = {"rows": back.count(), "columns": [[f.name, f.dataType.simpleString()] for f in back.schema.fields], "files": [{"name": f"{name}/{n}", "bytes": size, "sha256": sha} for n, size, sha in found]}
    if spark is not None:
        write_manifest(spark, facts, f"{path}/manifest")
        lines = "\n".join(f"{f['sha256']}  {f['name']}" for t in facts["tables"].values() for f in t["files"])
        spark.createDataFrame([(lines,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/SHA256SUMS")
    return facts


def top_stops(scored: DataFrame, n: int = 500) -> DataFrame:
    """The stops that a map shows, with marker radius."""
    return scored.orderBy(F.desc_nulls_last("suspicion_score"), "stop_id").limit(n).withColumn("marker_radius", 4 + F.least(F.coalesce("suspicion_score", F.lit(0.0)) / 25, F.lit(5.0)))


def top_hosts(hosts: DataFrame, n: int = 100) -> DataFrame:
    return hosts.orderBy(F.desc_nulls_last("host_score"), "cluster_id", "vessel_id").limit(n)


def geojson_map(scored: DataFrame, hosts: DataFrame, n_stops: int = 500, n_hosts: int = 100) -> dict:
    """A FeatureCollection of the top stops and hosts, with escaped popups and a centre: their median, else (8, -10)."""
    stops, leaders = top_stops(scored, n_stops).collect(), top_hosts(hosts, n_hosts).collect()
    centre = scored.agg(F.median("lat"), F.median("lon")).first()

    def feature(r, kind: str) -> dict:
        popup = "<br>".join(f"<b>{html.escape(k)}</b>: {html.escape(str(v))}" for k, v in r.asDict().items() if v is not None)
        return {"type": "Feature", "geometry": {"type": "Point", "coordinates": [r.lon, r.lat]}, "properties": {"kind": kind, "popup": popup, "radius": getattr(r, "marker_radius", 6.0)}}

    features = [feature(r, "stop") for r in stops] + [feature(r, "host") for r in leaders]
    return {"type": "FeatureCollection", "features": features, "centre": [8.0, -10.0] if centre[0] is None else list(centre)}


def html_map(points: dict) -> str:
    """A page that draws a map's points on a plain longitude-latitude grid, without any outside file; a click shows what a
    point is. Popups are escaped already."""
    return PAGE.replace("@POINTS@", json.dumps(points).replace("</", "<\\/"))


PAGE = """<!doctype html>
<meta charset="utf-8"><title>Stops and hosts</title>
<style>body{margin:0;font:13px sans-serif}svg{width:100vw;height:100vh;background:#eef3f7}#about{position:fixed;top:8px;right:8px;background:#fff;padding:8px;max-width:320px}</style>
<svg id="map"></svg><div id="about">Click a point.</div>
<script>
const points = @POINTS@, [lat, lon] = points.centre, svg = document.getElementById("map");
const span = Math.max(1, ...points.features.map(f => Math.max(Math.abs(f.geometry.coordinates[0] - lon), Math.abs(f.geometry.coordinates[1] - lat))));
svg.setAttribute("viewBox", [-span, -span, 2 * span, 2 * span].join(" "));
for (const f of points.features) {
  const dot = document.createElementNS("http://www.w3.org/2000/svg", "circle"), [x, y] = f.geometry.coordinates;
  dot.setAttribute("cx", x - lon); dot.setAttribute("cy", lat - y);
  dot.setAttribute("r", span / 400 * (f.properties.radius || 6));
  dot.setAttribute("fill", f.properties.kind === "host" ? "#b3261e" : "#1b6ca8"); dot.setAttribute("fill-opacity", 0.6);
  dot.addEventListener("click", () => { document.getElementById("about").innerHTML = f.properties.popup; });
  svg.append(dot);
}
</script>
"""
