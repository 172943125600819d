"""Parsers of stored inputs: samples from files and documents, route answers, traces. All are projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waymark import schemas
from waymark.functions import geo, kernels as k
from waymark.values import METRIC_DEFAULT

_POINT = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"


def _lon_lat(text: Column) -> tuple[Column, Column]:
    return F.regexp_extract(text, _POINT, 1).try_cast("double"), F.regexp_extract(text, _POINT, 2).try_cast("double")


def lines_from_table(rows: DataFrame, origin: str = "origin", destination: str = "destination") -> DataFrame:
    """Two-point lines from origin and destination text; rows that do not parse are dropped, the rest is JSON."""
    (x0, y0), (x1, y1) = _lon_lat(F.col(origin)), _lon_lat(F.col(destination))
    others = [c for c in rows.columns if c not in (origin, destination)]
    out = rows.select(
        F.array(geo.point(x0, y0), geo.point(x1, y1)).alias("line"), F.to_json(F.struct(*others)).alias("properties"),
        (x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()).alias("_ok"),
    )
    return out.filter("_ok").drop("_ok")


def lines_from_csv(spark: SparkSession, path: str) -> DataFrame:
    return lines_from_table(spark.read.option("header", True).csv(path))


def bad_rows(rows: DataFrame, origin: str = "origin", destination: str = "destination") -> DataFrame:
    """How many rows do not parse: what the dropping is reported with."""
    ok = F.col(origin).rlike(_POINT) & F.col(destination).rlike(_POINT)
    return rows.agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("dropped"))


_PROPERTIES = "sample_id string, tile_id string, route_id string, quality string, country string, date_generated string, org string"
FEATURES_SCHEMA = (
    "features array<struct<geometry: struct<coordinates: array<array<double>>>, properties: struct<"
    + ", ".join(p.replace(" ", ": ") for p in _PROPERTIES.split(", ")) + ">>>"
)


def feature_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature of GeoJSON collections; one task per file, so large inputs come as many files."""
    return spark.read.schema(FEATURES_SCHEMA).option("multiLine", True).json(path).select(F.explode("features").alias("f")).select("f.*")


def samples_from_features(features: DataFrame) -> DataFrame:
    """Sampling rows: origin is the first, destination the last coordinate."""
    c = F.col("geometry.coordinates")

    def text(point):
        return F.concat(F.lit("POINT("), F.get(point, F.lit(0)), F.lit(" "), F.get(point, F.lit(1)), F.lit(")"))

    rows = features.select(
        "properties.*", text(F.try_element_at(c, F.lit(1))).alias("origin"), text(F.try_element_at(c, F.lit(-1))).alias("destination")
    )
    return schemas.conform(rows, "sampling_samples")


def metadata_from_samples(samples: DataFrame, parameters: str = "{}") -> DataFrame:
    """One row per sample, country and date, with the constants of an imported sample."""
    keys = samples.select("sample_id", "country", "date_generated").distinct()
    rows = keys.withColumns(
        {"metric": F.lit(METRIC_DEFAULT), "final_routes": F.lit(0), "parameters": F.lit(parameters)}
    )
    return schemas.conform(rows, "sampling_metadata")


def samples_from_documents(documents: DataFrame, column: str, sample_id: str) -> DataFrame:
    """Sampling rows out of JSON route documents; the wanted sample id replaces the stored one.

    ``origin`` counts as (0, 0) unless it is POINT text; ``to_coord`` is "lat, lon".
    """
    d = F.from_json(F.col(column), _PROPERTIES + ", origin string, to_coord string")
    rows = documents.select(d.alias("d")).select("d.*")
    ox, oy = _lon_lat(F.when(F.col("origin").startswith("POINT("), F.col("origin")))
    to = F.split(F.coalesce("to_coord", F.lit("0.0, 0.0")), ",")
    lat, lon = F.trim(F.get(to, F.lit(0))).try_cast("double"), F.trim(F.get(to, F.lit(1))).try_cast("double")

    def text(x, y):
        return F.concat(F.lit("POINT("), x, F.lit(" "), y, F.lit(")"))

    rows = rows.withColumns(
        {
            "sample_id": F.lit(sample_id), "origin": text(F.coalesce(ox, F.lit(0.0)), F.coalesce(oy, F.lit(0.0))),
            "destination": text(lon, lat),
        }
    )
    return schemas.conform(rows, "sampling_samples")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows found: {what}")
    return df


# ---- stored route answers --------------------------------------------------------------------

_LEGS = """struct<routes: array<struct<
    legs: array<struct<points: array<struct<latitude: double, longitude: double>>,
                       summary: struct<lengthInMeters: double, travelTimeInSeconds: double>>>,
    sections: array<struct<startPointIndex: int, endPointIndex: int, sectionType: string, travelMode: string>>>>>"""

# Section types of an answer and what they are called here.
SECTION_TYPES = {"TOLL_ROAD": "TOLL", "MOTORWAY": "MOTORWAY", "UNPAVED": "UNPAVED"}


def _mode(section: Column) -> Column:
    return F.when(section["travelMode"] == "car", F.lit("CAR")).when(section["travelMode"] == "truck", F.lit("TRUCK")).otherwise(F.lit("OTHER"))


def answers_with_legs(df: DataFrame, body: str, ids: list[str]) -> DataFrame:
    """Answers made of legs: one row per route with its line, metres, seconds, typed sections and violation flag.

    The flag is set when a truck part follows another part that comes after a truck part.
    """
    rows = df.select(*ids, F.posexplode(F.from_json(F.col(body), _LEGS)["routes"]).alias("route_no", "r"))
    line = F.transform(F.flatten(F.transform("r.legs", lambda leg: leg["points"])), lambda p: geo.point(p["longitude"], p["latitude"]))

    def total(field):
        return F.aggregate("r.legs", F.lit(0.0), lambda acc, leg: acc + leg["summary"][field])

    rows = rows.withColumns({"line": line, "metres": total("lengthInMeters"), "seconds": total("travelTimeInSeconds")})
    kinds = F.create_map(*[F.lit(x) for pair in SECTION_TYPES.items() for x in pair])

    def section(s):
        n = s["endPointIndex"] - s["startPointIndex"]
        part = F.slice(F.col("line"), s["startPointIndex"] + 1, F.greatest(n, F.lit(1)))
        return F.struct(
            F.when(s["sectionType"] == "TRAVEL_MODE", _mode(s)).otherwise(
                F.coalesce(F.try_element_at(kinds, s["sectionType"]), F.lit("OTHER"))
            ).alias("kind"),
            F.when(F.size(part) == 1, F.concat(part, part)).otherwise(part).alias("line"),
        )

    modes = F.transform(F.filter("r.sections", lambda s: s["sectionType"] == "TRAVEL_MODE"), _mode)
    # T marks truck parts, O other parts: the flag is a T ... O ... T in the sequence.
    marks = F.array_join(F.transform(modes, lambda m: F.substring(m, 1, 1)), "")
    return rows.select(
        *ids, "route_no", "line", "metres", "seconds", F.transform("r.sections", section).alias("sections"),
        marks.rlike("T.*O.*T").alias("violation"),
    )


_VERTEXES = "struct<routes: array<struct<sections: array<struct<roads: array<struct<vertexes: array<double>>>>>, summary: struct<distance: double, duration: double>>>>"


def answers_with_flat_vertices(df: DataFrame, body: str, ids: list[str]) -> DataFrame:
    """Answers whose roads list x, y, x, y ...: the first section of the first route."""
    rows = df.select(*ids, F.get(F.from_json(F.col(body), _VERTEXES)["routes"], F.lit(0)).alias("r"))
    roads = F.get(F.col("r.sections"), F.lit(0))["roads"]

    def points(road):
        xy = road["vertexes"]
        evens = F.filter(F.sequence(F.lit(0), F.greatest(F.size(xy) - 2, F.lit(0))), lambda i: (i % 2 == 0) & (i + 1 < F.size(xy)))
        return F.transform(evens, lambda i: geo.point(F.get(xy, i), F.get(xy, i + 1)))

    line = F.flatten(F.transform(roads, points))
    return rows.select(*ids, line.alias("line"), F.col("r.summary.distance").alias("metres"), F.col("r.summary.duration").alias("seconds"))


_TRIP = "struct<legs: array<struct<shape: string>>, summary: struct<length: double, time: double>>"


def answers_with_polylines(df: DataFrame, body: str, ids: list[str]) -> DataFrame:
    """Answers with encoded lines: the trip and its alternates, lengths in kilometres."""
    parsed = F.from_json(F.col(body), f"struct<trip: {_TRIP}, alternates: array<struct<trip: {_TRIP}>>>")
    rows = df.select(*ids, parsed.alias("j"))
    trips = F.concat(
        F.array("j.trip"), F.coalesce(F.transform("j.alternates", lambda a: a["trip"]), F.slice(F.array("j.trip"), 1, 0))
    )
    rows = rows.select(*ids, F.posexplode(trips).alias("route_no", "t"))
    return rows.select(
        *ids, "route_no", k.decode_polyline(F.get(F.col("t.legs"), F.lit(0))["shape"]).alias("line"),
        (F.col("t.summary.length") * 1000).alias("metres"), F.col("t.summary.time").alias("seconds"),
    )


def calls_per_service(answers: DataFrame, service: str = "service") -> DataFrame:
    """Answers per service: counted from the stored rows, so task retries change nothing."""
    return answers.groupBy(service).agg(F.count("*").alias("calls"))


def traces_from_reports(df: DataFrame, reports: str = "reports", organisation: str = "organisation") -> DataFrame:
    """Traces with more than one report as lines; no row for shorter ones."""
    usable = df.filter(F.size(reports) > 1)
    line = F.transform(reports, lambda p: geo.point(p["lon"], p["lat"]))
    return usable.select(*[c for c in df.columns if c != reports], line.alias("line"), geo.wkt_of_points(line).alias("trace"))
