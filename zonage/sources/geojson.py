"""GeoJSON layers (SRC12, SRC13) → feature, zone and edge tables.

A FeatureCollection is one JSON document, often one line.  It is read as text
whose records end at ``"Feature"``, the type of every feature, so a layer of any
size is split into blocks, read by many tasks, and no value holds more than one
feature.  A record is then a feature from behind its type to the type of the
next.  Documents that don't name the type first in each feature are parsed as
a whole, by one task a file.

The zone and edge tables are written once as Parquet (:func:`write_zone_tables`)
and every job reads those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.spatial import polygon_edges
from .readers import position

# Properties and geometry stay JSON text.
_FEATURE = T.StructType([T.StructField("properties", T.StringType()), T.StructField("geometry", T.StringType())])
_FEATURES = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
_POLY = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"
_TYPE = '"Feature"'
_HEAD = r'"features"\s*:\s*\[\s*\{\s*"type"\s*:\s*$'          # what stands before the first feature's type
_WHOLE = r'(\}\s*,\s*\{\s*"type"\s*:|\})\s*$'               # how a record ends that holds a whole feature


def _splittable(spark: SparkSession, path: str) -> bool:
    """Whether a file's first record shows that features begin with their type."""
    first = spark.read.option("lineSep", _TYPE).text(path).limit(1).collect()
    return bool(first) and spark.createDataFrame(first, "value string").filter(F.col("value").rlike(_HEAD)).count() == 1


def read_features(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(properties map<string,string>, geom_type, coords multipolygon,
    properties_json, geometry, file, at)`` per feature; numeric properties
    arrive as text in the map; Polygons are wrapped into one-part MultiPolygons
    so every row has the same coordinate type; ``at`` tells the features of a
    file apart, in order."""
    paths = [path] if isinstance(path, str) else list(path)
    split = [p for p in paths if _splittable(spark, p)]
    frames = []
    if split:
        pieces = spark.read.option("lineSep", _TYPE).text(split).select("value", position().alias("at"))
        whole = F.when(F.col("value").rlike(_HEAD), F.lit(None)) \
                 .when(F.col("value").rlike(_WHOLE), F.concat(F.lit('{"type":"Feature"'), "value")) \
                 .otherwise(F.raise_error(F.concat(F.lit("a value of a feature is \"Feature\", in "), F.col("at.file"))))
        frames.append(pieces.select("at", F.from_json(whole, _FEATURE).alias("f")).filter(F.col("f").isNotNull()))
    if rest := [p for p in paths if p not in split]:
        docs = spark.read.text(rest, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
        found = docs.select("file", F.posexplode(F.from_json("value", _FEATURES)["features"]).alias("row", "f"))
        frames.append(found.select(F.struct("file", F.lit(0).cast("long").alias("block"),
                                            F.col("row").cast("long").alias("row")).alias("at"), "f"))
    feats = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    return feats.select(F.from_json("f.properties", "map<string,string>").alias("properties"),
                        F.get_json_object("f.geometry", "$.type").alias("geom_type"),
                        geometry_coords("f.geometry").alias("coords"),
                        F.col("f.properties").alias("properties_json"), F.col("f.geometry").alias("geometry"),
                        F.element_at(F.split("at.file", "/"), -1).alias("file"), "at")


def read_zones(spark: SparkSession, path: str, code: str = "code_iris", name: str = "nom_iris",
               commune: str = "insee_com", prefix: str | None = "751") -> DataFrame:
    """Zone table ``(zone, name, commune, coords, geometry, properties_json,
    position, district)``, ``position`` being the order of the file; ``prefix`` keeps zones whose code starts with it (FLT2);
    district = commune − 75100."""
    f = read_features(spark, path)
    z = f.select(F.col("properties")[code].alias("zone"), F.col("properties")[name].alias("name"),
                 F.col("properties")[commune].alias("commune"), "coords", "geometry", "properties_json",
                 F.col("at").alias("position"))
    if prefix:
        z = z.filter(F.col("zone").startswith(prefix))
    return z.withColumn("district", (F.col("commune").try_cast("int") - 75100).cast("int"))


def zone_edges(zones: DataFrame) -> DataFrame:
    """Edge table of a zone table (see :func:`zonage.operators.spatial.polygon_edges`)."""
    return polygon_edges(zones, "zone", "coords", multi=True)


def write_zone_tables(zones: DataFrame, base: str) -> tuple[str, str]:
    """Persist zones (their geometry as GeoJSON text) and edges as Parquet once."""
    zp, ep = f"{base}/zones", f"{base}/edges"
    zones.drop("coords").write.mode("overwrite").parquet(zp)
    zone_edges(zones).repartition("id").write.mode("overwrite").parquet(ep)
    return zp, ep


def geometry_coords(col: str) -> "F.Column":
    """GeoJSON geometry text column (``geo_shape``) -> multipolygon coordinates
    (Polygons wrapped as one-part MultiPolygons; other types -> NULL)."""
    gtype = F.get_json_object(F.col(col), "$.type")
    txt = F.get_json_object(F.col(col), "$.coordinates")
    return (F.when(gtype == "Polygon", F.array(F.from_json(txt, _POLY)))
             .when(gtype == "MultiPolygon", F.from_json(txt, _MULTI)))


def read_districts(spark: SparkSession, path: str, code: str = "c_arinsee") -> DataFrame:
    """District documents ``(code, properties_json, geometry)``."""
    return read_features(spark, path).select(F.col("properties")[code].alias("code"), "properties_json", "geometry")


def read_coverage_layers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC13: coverage layer files ``YYYY_Tn_couv_Metropole_<OP>_<TECH>_data…``
    (GeoJSON FeatureCollections) -> ``(id, op_code, techno, niveau, coords)``,
    one row per polygon feature; operator code and technology come from the
    file name, the level from the ``niveau`` property."""
    from .readers import coverage_layer_keys
    op, tech = coverage_layer_keys("file")
    return read_features(spark, paths).select(
        F.concat_ws("#", "file", F.col("at.block").cast("string"), F.col("at.row").cast("string")).alias("id"),
        op.alias("op_code"), tech.alias("techno"), F.col("properties")["niveau"].alias("niveau"), "coords")
