"""Landed files: names, raw lines, archives, feature pages, incremental ingest."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from caseloom.operators.stored import read_store
from caseloom.plans.registry import query
from caseloom.session import cut_lineage, run_path
from caseloom.sources.features import collect_geometries, read_feature_pages, with_geometry
from caseloom.sources.lines import line_kind, partition_date, read_lines, unpack_archives
from caseloom.sources.tables import table
from caseloom.streaming.ingest import ingest_new_files, ingested_lines, quarantined_files


@query(
    "partition_from_filename",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (1, 4) THEN CAST(o_orderdate AS DATE) WHEN o_orderkey % 5 = 2 THEN NULL
           WHEN year(o_orderdate) < 2000 THEN CAST(date_trunc('month', o_orderdate) + INTERVAL 100 YEAR AS DATE)
           ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS part_date
    FROM orders
    """,
)
def partition_from_filename(spark, sf):
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    yymm, yymmdd = F.date_format(d, "yyMM"), F.date_format(d, "yyMMdd")
    name = (
        F.when(key % 5 == 0, F.concat(F.lit("BEC.E2.BOD1.F03.C"), yymm, F.lit(".P1466.A3304557.C.ZIP")))
        .when(key % 5 == 1, F.concat(F.lit("CAD.A"), yymmdd, F.lit(".ZIP")))
        .when(key % 5 == 2, F.concat(F.lit("report.A3304557."), key.cast("string"), F.lit(".ZIP")))
        .when(key % 5 == 3, F.concat(F.lit("C25.C"), yymm, F.lit(".zip")))
        .otherwise(F.concat(F.lit("X.Aab"), yymmdd, F.lit("x.ZIP")))
    )
    return table(spark, sf, "orders").select("o_orderkey", partition_date(name).alias("part_date"))


def payroll_text(spark, sf):
    """Landed lines: data rows of line items, with header, footer and blank lines among them."""
    key = F.col("l_orderkey")
    line = (
        F.when((key % 97 == 0) & (F.col("l_linenumber") == 1), "")
        .when((key % 89 == 0) & (F.col("l_linenumber") == 1), "HEADER;2025")
        .otherwise(F.concat_ws(";", "l_orderkey", "l_linenumber", "l_partkey"))
    )
    return table(spark, sf, "lineitem").select(line.alias("line"))


LINE_KIND_SQL = """
    SELECT CASE WHEN l_linenumber = 1 AND l_orderkey % 97 = 0 THEN 'blank' WHEN l_linenumber = 1 AND l_orderkey % 89 = 0 THEN 'frame' ELSE 'data' END AS kind
    FROM lineitem
"""


@query("rawline_ingest", f"WITH k AS ({LINE_KIND_SQL}) SELECT kind, count(*) AS n_lines FROM k GROUP BY 1")
def rawline_ingest(spark, sf):
    path = run_path(spark, "lines")
    payroll_text(spark, sf).write.text(path)
    return read_lines(spark, path).groupBy(line_kind(F.col("line")).alias("kind")).agg(F.count(F.lit(1)).alias("n_lines"))


def _zip_bytes(batches):
    for batch in batches:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("lines.TXT", "\n".join(batch["line"]) + "\n")
            archive.writestr("readme.md", "not data")
        yield pd.DataFrame({"path": ["landed.zip"], "content": [packed.getvalue()]})


@query("archive_lines", f"WITH k AS ({LINE_KIND_SQL}) SELECT kind, 'lines.TXT' AS member, count(*) AS n_lines FROM k GROUP BY 1")
def archive_lines(spark, sf):
    """Lines packed into archives of bounded size, stored, and unpacked from the stored archives."""
    packed = payroll_text(spark, sf).mapInPandas(_zip_bytes, "path string, content binary")
    lines = unpack_archives(cut_lineage(packed, "archives"))
    return lines.groupBy(line_kind(F.col("line")).alias("kind"), "member").agg(F.count(F.lit(1)).alias("n_lines"))


FEATURE_FIELDS = [{"name": "objectid"}, {"name": "name"}, {"name": "segment"}]
PAGE_ROWS = 500


def landed_pages(spark, sf):
    """Feature pages made of customers: points, rings, paths and features without geometry."""
    key = F.col("c_custkey")
    x, y = (F.col("c_nationkey") * 10).cast("double"), (F.col("c_custkey") % 50).cast("double")
    at = lambda a, b: F.array(a, b)
    square = F.array(F.array(at(x, y), at(x + 2, y), at(x + 2, y + 2), at(x, y + 2)))
    path = F.array(F.array(at(x, y), at(x + 4, y + 2)))
    geometry = F.struct(
        F.when(key % 4 == 0, x).alias("x"),
        F.when(key % 4 == 0, y).alias("y"),
        F.when(key % 4 == 1, square).alias("rings"),
        F.when(key % 4 == 2, path).alias("paths"),
    )
    attributes = F.struct(
        key.alias("objectid"), F.col("c_name").alias("name"), F.when(key % 5 != 0, F.col("c_mktsegment")).alias("segment")
    )
    features = table(spark, sf, "customer").select(
        F.floor(key / PAGE_ROWS).alias("page"), F.struct(attributes.alias("attributes"), geometry.alias("geometry")).alias("f")
    )
    # a page holds PAGE_ROWS consecutive ids at most
    pages = features.groupBy("page").agg(F.collect_list("f").alias("features"))
    last = features.agg(F.max("page")).scalar()
    body = F.to_json(F.struct("features", (F.col("page") < last).alias("exceededTransferLimit")))
    folder = run_path(spark, "pages")
    pages.select(body.alias("value"), "page").write.partitionBy("page").text(folder)
    return read_feature_pages(spark, folder, FEATURE_FIELDS)


FEATURES_SQL = """
    c AS (SELECT c_custkey AS k, CAST(c_nationkey * 10 AS DOUBLE) AS x, CAST(c_custkey % 50 AS DOUBLE) AS y, * FROM customer),
    f AS (SELECT CAST(k AS VARCHAR) AS objectid, c_name AS name, CASE WHEN k % 5 <> 0 THEN c_mktsegment END AS segment,
                 CASE k % 4 WHEN 0 THEN x WHEN 1 THEN x + 1 WHEN 2 THEN x + 2 END AS longitude, CASE k % 4 WHEN 0 THEN y WHEN 1 THEN y + 1 WHEN 2 THEN y + 1 END AS latitude,
                 CASE k % 4 WHEN 0 THEN 'POINT (' || x || ' ' || y || ')'
                   WHEN 1 THEN 'POLYGON ((' || x || ' ' || y || ', ' || (x + 2) || ' ' || y || ', ' || (x + 2) || ' ' || (y + 2) || ', ' || x || ' ' || (y + 2) || '))'
                   WHEN 2 THEN 'LINESTRING (' || x || ' ' || y || ', ' || (x + 4) || ' ' || (y + 2) || ')' END AS geometry
          FROM c)
"""


@query("feature_pages_flatten", f"WITH {FEATURES_SQL} SELECT *, abs(longitude) > 180 OR abs(latitude) > 90 AS out_of_range FROM f")
def feature_pages_flatten(spark, sf):
    return with_geometry(landed_pages(spark, sf))


@query(
    "geometry_collect",
    f"""
    WITH {FEATURES_SQL}, d AS (SELECT DISTINCT segment, geometry FROM f WHERE geometry IS NOT NULL)
    SELECT segment, count(*) AS n_shapes, md5('GEOMETRYCOLLECTION (' || string_agg(geometry, ', ' ORDER BY geometry) || ')') AS geometry_key FROM d GROUP BY 1
    """,
)
def geometry_collect(spark, sf):
    shapes = with_geometry(landed_pages(spark, sf)).select("segment", "geometry")
    collected = collect_geometries(shapes, ["segment"], "geometry")
    return collected.select("segment", "n_shapes", F.md5("geometry").alias("geometry_key"))


def land(spark, lines, path):
    """Deliver lines as one file of this name, in place of an earlier delivery."""
    folder, jvm_path = run_path(spark, "delivery"), spark._jvm.org.apache.hadoop.fs.Path
    lines.coalesce(1).write.text(folder)
    fs = jvm_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    target = jvm_path(path)
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    fs.rename(fs.globStatus(jvm_path(f"{folder}/part-*"))[0].getPath(), target)


@query(
    "incremental_file_ingest",
    """
    WITH o AS (SELECT o_orderkey AS k, CAST(date_trunc('month', o_orderdate) + CASE WHEN year(o_orderdate) < 2000 THEN INTERVAL 100 YEAR ELSE INTERVAL 0 YEAR END AS DATE) AS part_date FROM orders)
    SELECT 'published' AS status, part_date, NULL AS reason, count(*) AS n_lines
    FROM (SELECT part_date FROM o UNION ALL SELECT DATE '2001-03-01' FROM o WHERE k % 89 = 0) GROUP BY 2
    UNION ALL SELECT 'rejected', NULL, NULL, count(*) FROM o WHERE k % 97 = 0
    UNION ALL SELECT 'quarantined', DATE '2000-01-01', 'empty file', 0 UNION ALL SELECT 'quarantined', DATE '2000-02-01', 'no data lines', 0
    """,
)
def incremental_file_ingest(spark, sf):
    """Every month is delivered in two files, by even and odd keys, and the ingest runs after each and once more.

    The first delivery also holds a file without content, one without data lines, one without a
    date and half a file, which the second delivers again in full under its name.
    """
    landing, final, checkpoint = (run_path(spark, n) for n in ("landing", "ingested", "checkpoint"))
    orders = table(spark, sf, "orders")
    line = F.concat_ws(";", "o_orderkey", "o_custkey").alias("value")
    lines = orders.select(
        line, F.concat(F.lit("BEC.C"), F.date_format("o_orderdate", "yyMM"), F.lit(".TXT")).alias("delivery"), (F.col("o_orderkey") % 2).alias("odd")
    )
    land(spark, orders.limit(0).select(line), f"{landing}/EMPTY.C0001.TXT/lines")
    land(spark, table(spark, sf, "region").select(F.concat(F.lit("HEADER;"), "r_name")), f"{landing}/HEAD.C0002.TXT/lines")
    land(spark, orders.filter("o_orderkey % 97 = 0").select(line), f"{landing}/UNDATED.TXT/lines")
    land(spark, orders.filter("o_orderkey % 178 = 0").select(line), f"{landing}/HALF.C0103.TXT/lines")
    for part in ("odd = 0", "odd = 1", None):
        if part:
            lines.filter(part).drop("odd").write.mode("append").partitionBy("delivery").text(landing)
        ingest_new_files(spark, landing + "/*", final, checkpoint, name_part=-2)
        land(spark, orders.filter("o_orderkey % 89 = 0").select(line), f"{landing}/HALF.C0103.TXT/lines")
    none = F.lit(None).cast("string")
    published = ingested_lines(spark, final).groupBy("part_date").agg(F.count(F.lit(1)).alias("n_lines"))
    rejected = read_store(spark, f"{final}-rejected").agg(F.count(F.lit(1)).alias("n_lines"))
    refused = quarantined_files(spark, f"{final}-quarantine")
    return (
        published.select(F.lit("published").alias("status"), "part_date", none.alias("reason"), "n_lines")
        .unionByName(rejected.select(F.lit("rejected").alias("status"), F.lit(None).cast("date").alias("part_date"), none.alias("reason"), "n_lines"))
        .unionByName(refused.select(F.lit("quarantined").alias("status"), "part_date", "reason", F.col("n_rows").alias("n_lines")))
    )
