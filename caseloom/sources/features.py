"""Landed pages of a feature service: attributes as text plus geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.skew import attach_group

_POINTS = "array<array<array<double>>>"
GEOMETRY = f"struct<x: double, y: double, rings: {_POINTS}, paths: {_POINTS}>"


def attribute_schema(fields: list[dict]) -> T.StructType:
    """Every attribute of the layer metadata as a text column."""
    return T.StructType([T.StructField(f["name"], T.StringType()) for f in fields])


def require_complete(spark: SparkSession, path: str) -> None:
    """Raise when an extract was cut short: no page says that it is the last, or a page that
    promises more is empty. Pages are judged by their flag and the number of their features.
    """
    pages = spark.read.schema("features array<string>, exceededTransferLimit boolean").json(path, multiLine=True)
    more = F.coalesce("exceededTransferLimit", F.lit(False))
    seen = pages.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~more).alias("n_last"),
        F.count_if(more & (F.size(F.coalesce("features", F.array())) == 0)).alias("n_empty"),
    ).first()
    if seen["n"] and (not seen["n_last"] or seen["n_empty"]):
        raise RuntimeError(f"extract in {path} is truncated: {seen['n_last']} last pages, {seen['n_empty']} empty ones")


def read_feature_pages(spark: SparkSession, path: str, fields: list[dict]) -> DataFrame:
    """One row per feature of every landed JSON page; a truncated extract is an error."""
    require_complete(spark, path)
    attributes = attribute_schema(fields)
    features = T.ArrayType(
        T.StructType(
            [T.StructField("attributes", attributes), T.StructField("geometry", T.StructType.fromDDL(GEOMETRY[7:-1]))]
        )
    )
    schema = T.StructType([T.StructField("features", features), T.StructField("exceededTransferLimit", T.BooleanType())])
    pages = spark.read.schema(schema).json(path, multiLine=True)
    return pages.select(F.explode("features").alias("f")).select("f.attributes.*", F.col("f.geometry").alias("geometry"))


def _ring(points: Column) -> Column:
    pairs = F.transform(points, lambda p: F.concat_ws(" ", p[0].cast("string"), p[1].cast("string")))
    return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))


def geometry_wkt(geometry: Column) -> Column:
    """Well-known text: rings as polygon, x/y as point, the first path as line; without parts none."""
    point = F.concat(
        F.lit("POINT ("), geometry["x"].cast("string"), F.lit(" "), geometry["y"].cast("string"), F.lit(")")
    )
    polygon = F.concat(F.lit("POLYGON ("), F.array_join(F.transform(geometry["rings"], _ring), ", "), F.lit(")"))
    line = F.concat(F.lit("LINESTRING "), _ring(F.get(geometry["paths"], F.lit(0))))
    return (
        F.when(F.size(F.coalesce(geometry["rings"], F.array())) > 0, polygon)
        .when(geometry["x"].isNotNull() & geometry["y"].isNotNull(), point)
        .when(F.size(F.coalesce(geometry["paths"], F.array())) > 0, line)
    )


def _mean(points: Column, axis: int) -> Column:
    total = F.aggregate(points, F.lit(0.0).cast("double"), lambda s, p: s + p[axis])
    return total / F.nullif(F.size(points), F.lit(0))


def with_geometry(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``longitude``, ``latitude``, WKT and a flag for coordinates that are not degrees.

    Points keep their place; rings and paths are represented by the mean of the
    vertices of their first part.
    """
    g = F.col(geometry)
    vertices = F.coalesce(F.get(g["rings"], F.lit(0)), F.get(g["paths"], F.lit(0)))
    lon = F.coalesce(g["x"], _mean(vertices, 0))
    lat = F.coalesce(g["y"], _mean(vertices, 1))
    return (
        df.withColumn("longitude", lon)
        .withColumn("latitude", lat)
        .withColumn("out_of_range", (F.abs("longitude") > 180) | (F.abs("latitude") > 90))
        .withColumn(geometry, geometry_wkt(g))
    )


def collect_geometries(df: DataFrame, keys: list[str], wkt: str, part_shapes: int = 10_000) -> DataFrame:
    """Distinct shapes per key as geometry collections, one row per (key, part).

    A key has one part per ``part_shapes`` distinct shapes, rounded up, so no collection outgrows a task.
    """
    distinct = df.select(*keys, wkt).filter(F.col(wkt).isNotNull()).distinct()
    sized = attach_group(distinct, keys, {"_n": F.count(F.lit(1))}, [wkt])
    parted = sized.withColumn("part", F.pmod(F.xxhash64(wkt), F.ceil(F.col("_n") / part_shapes)).cast("int"))
    collected = parted.groupBy(*keys, "part").agg(
        F.count(F.lit(1)).alias("n_shapes"), F.array_join(F.array_sort(F.collect_list(wkt)), ", ").alias("_s")
    )
    return collected.withColumn("geometry", F.concat(F.lit("GEOMETRYCOLLECTION ("), F.col("_s"), F.lit(")"))).drop("_s")
