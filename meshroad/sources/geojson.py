"""ZIP polygons from GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.session import materialize
from meshroad.sources.json_split import array_objects

_POLYGON = "array<array<array<double>>>"
# Geometry types that enclose no area.
_NO_AREA = ("Point", "MultiPoint", "LineString", "MultiLineString")


def parse_coordinates(geometry_type: Column, coordinates: Column) -> Column:
    """Coordinate text of a Polygon or MultiPolygon -> polygon -> ring -> vertex -> [x, y].

    Null for other types, text that cannot be read and vertices that are not on the globe.
    """
    off_globe = lambda v: ~F.coalesce((F.abs(v[0]) <= 180) & (F.abs(v[1]) <= 90), F.lit(False))
    one, many = F.from_json(coordinates, _POLYGON), F.from_json(coordinates, f"array<{_POLYGON}>")
    found = F.when((geometry_type == "Polygon") & one.isNotNull(), F.array(one)).when(geometry_type == "MultiPolygon", many)
    bad = F.exists(found, lambda p: p.isNull() | F.exists(p, lambda r: r.isNull() | F.exists(r, off_globe)))
    return F.when(~bad, found)


def polygons_from_features(features: DataFrame) -> DataFrame:
    """Features with `polygon_id`, `zip`, `geometry_type`, `coordinates` -> the polygon table.

    Features that are no polygon, or cannot be read, have none; `unreadable_features` lists them.
    """
    mp = parse_coordinates(F.col("geometry_type"), F.col("coordinates"))
    return features.select("polygon_id", "zip", mp.alias("mp")).filter(F.col("mp").isNotNull())


def unreadable_features(features: DataFrame) -> DataFrame:
    """How many features of each geometry type give no polygon, and the ZIP codes concerned (their least and greatest)."""
    mp = parse_coordinates(F.col("geometry_type"), F.col("coordinates"))
    return features.filter(mp.isNull()).groupBy("geometry_type").agg(
        F.count(F.lit(1)).alias("features"), F.min("zip").alias("first_zip"), F.max("zip").alias("last_zip"))


def read_features(spark: SparkSession, path: str, zip_attribute: str = "ZCTA5CE10", line_delimited: bool = False) -> DataFrame:
    """Features of FeatureCollection documents, or one feature per line. Large documents are read by many tasks, too.

    Each feature gets an id of its own, also if another one is equal: equal features are kept as they are, and
    a point in both gets both codes. The parts of a GeometryCollection become features that share the id. The
    result is written once, since ids that depend on the reading order must not change between uses.
    """
    geometry = "struct<type: string, coordinates: string, geometries: array<struct<type: string, coordinates: string>>>"
    properties = f"struct<`{zip_attribute}`: string>"
    if line_delimited:
        rows = spark.read.schema(f"properties {properties}, geometry {geometry}").json(path).filter("properties is not null or geometry is not null")
    else:
        found = array_objects(spark, path).select("text", F.from_json("text", f"type string, properties {properties}, geometry {geometry}").alias("f"))
        # Other arrays of a document may hold objects that are no features; what cannot be read is kept, to be found unreadable.
        other = F.coalesce(F.col("f.type") != "Feature", F.col("f.properties").isNull() & F.col("f.geometry").isNull() & F.col("f.type").isNull())
        rows = found.filter(~(other & F.get_json_object("text", "$").isNotNull())).select("f.properties", "f.geometry")
    rows = rows.withColumn("polygon_id", F.monotonically_increasing_id())
    parts = F.when(F.col("geometry.type") == "GeometryCollection", F.col("geometry.geometries")).otherwise(
        F.array(F.struct(F.col("geometry.type").alias("type"), F.col("geometry.coordinates").alias("coordinates"))))
    rows = rows.withColumn("part", F.explode_outer(parts))
    return materialize(rows.select(
        "polygon_id", F.col(f"properties.`{zip_attribute}`").alias("zip"),
        F.col("part.type").alias("geometry_type"), F.col("part.coordinates").alias("coordinates")), "features")


def read_zip_polygons(
    spark: SparkSession, path: str, zip_attribute: str = "ZCTA5CE10", line_delimited: bool = False, unreadable: str = "fail"
) -> DataFrame:
    """Polygons with ZIP codes; coordinates are longitude, latitude in WGS 84, as the format prescribes.

    Points and lines hold no crash and are left out. Any other feature without a readable polygon would lose the
    crashes in it, so it fails the job (`unreadable="fail"`) unless it is to be left out (`"drop"`).
    """
    features = read_features(spark, path, zip_attribute, line_delimited)
    if unreadable == "fail":
        bad = unreadable_features(features.filter(~F.coalesce(F.col("geometry_type").isin(*_NO_AREA), F.lit(False)))).collect()
        if bad:
            raise ValueError(f"features without a readable polygon: {[r.asDict() for r in bad]}")
    # The parts of a collection are one multipolygon.
    polygons = polygons_from_features(features)
    return polygons.groupBy("polygon_id", "zip").agg(F.flatten(F.collect_list("mp")).alias("mp"))
