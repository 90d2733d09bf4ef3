"""Geometry jobs and GeoParquet."""

from __future__ import annotations

from pyspark.sql import functions as F

from moorage.functions import wkb
from moorage.operators import geometry
from moorage.plans.registered import query
from moorage.session import workspace
from moorage.sinks import finalize, footers, geo_layout, geoparquet
from moorage.sources import files


def _points(t):
    """Customers with a point as WKB hex."""
    shape = F.struct(
        F.lit("Point").alias("type"),
        F.to_json(F.array(F.col("c_nationkey").cast("double"), F.col("c_acctbal"))).alias("coordinates"),
        F.lit(None).cast("array<string>").alias("geometries"),
    )
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", geometry.encode_geojson(shape).alias("g"))
    return rows.select("c_custkey", "c_nationkey", "c_mktsegment", F.hex("g.wkb").alias("geometry"))


@query(
    "geometry_encode_job",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN k = 0 THEN 'ring has fewer than 4 points' END AS geometry_error,
              CASE k WHEN 1 THEN 13 + 16 * 5 WHEN 2 THEN 9 + 4 + 16 * 4 WHEN 3 THEN 9 + 4 + 16 * 5 + 4 + 16 * 4 END AS n_bytes,
              CASE WHEN k > 0 THEN '0103000000' || CASE WHEN k = 3 THEN '02' ELSE '01' END || '000000' END AS head
       FROM (SELECT *, l_linenumber % 4 AS k FROM lineitem)""",
)
def geometry_encode_job(spark, t):
    # Rectangles around quantity and price: too short, open, triangular, or with a hole.
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    corner = lambda dx, dy: F.array(x + dx, y + dy)
    a, b, c, d = corner(0, 0), corner(9, 0), corner(9, 9), corner(0, 9)
    hole = F.array(corner(1, 1), corner(2, 1), corner(2, 2), corner(1, 1))
    kind = F.col("l_linenumber") % 4
    rings = (
        F.when(kind == 0, F.array(F.array(a, b)))
        .when(kind == 1, F.array(F.array(a, b, c, d)))
        .when(kind == 2, F.array(F.array(a, b, c)))
        .otherwise(F.array(F.array(a, b, c, d, a), hole))
    )
    shape = F.struct(
        F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), rings.alias("rings"),
        F.lit(None).cast("array<array<array<double>>>").alias("paths"),
    )
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", geometry.encode_esri(shape, F.lit("esriGeometryPolygon")).alias("g")
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("g.error").alias("geometry_error"),
        F.octet_length("g.wkb").alias("n_bytes"), F.substring(F.hex("g.wkb"), 1, 18).alias("head"),
    )


def _shapes(t):
    """Customers with a point, a polygon with a hole, two lines, a point with height, or nothing, as WKB hex."""
    x, y = F.col("c_nationkey").cast("double"), F.col("c_acctbal")
    at = lambda dx, dy: F.array(x + dx, y + dy)
    ring = lambda d, w: F.array(at(d, d), at(d + w, d), at(d + w, d + w), at(d, d))
    k = F.col("c_custkey") % 5
    name = F.when(k == 1, "Polygon").when(k == 2, "MultiLineString").when(k < 4, "Point")
    coordinates = (
        F.when(k == 0, F.to_json(at(0, 0)))
        .when(k == 1, F.to_json(F.array(ring(0, 9), ring(1, 1))))
        .when(k == 2, F.to_json(F.array(F.array(at(0, 0), at(1, 1)), F.array(at(-5, -5), at(0, 0)))))
        .when(k == 3, F.to_json(F.array(x, y, F.lit(7.0))))
    )
    shape = F.struct(name.alias("type"), coordinates.alias("coordinates"), F.lit(None).cast("array<string>").alias("geometries"))
    rows = t.customer.select("c_custkey", "c_mktsegment", F.when(k < 4, shape).alias("shape"))
    rows = rows.select("c_custkey", "c_mktsegment", geometry.encode_geojson(F.col("shape")).alias("g"))
    return rows.select("c_custkey", "c_mktsegment", F.hex("g.wkb").alias("geometry"))


_SHAPES_SQL = "(SELECT *, c_custkey % 5 AS k, CAST(c_nationkey AS DOUBLE) AS x, c_acctbal AS y FROM customer)"


@query(
    "geometry_decode_job",
    f"""SELECT c_custkey, CASE WHEN k < 4 THEN x END AS x, CASE WHEN k < 4 THEN y END AS y, CAST([1, 3, 5, 1, NULL][k + 1] AS INT) AS kind,
               CAST([1, 2, 2, 1, NULL][k + 1] AS INT) AS n_rings, CAST([2, 2, 2, 3, NULL][k + 1] AS INT) AS n_dims,
               CASE k WHEN 1 THEN x + 2 END AS hole_x, CAST(NULL AS VARCHAR) AS decode_error
        FROM {_SHAPES_SQL}""",
)
def geometry_decode_job(spark, t):
    rows = geometry.decode_hex(_shapes(t))
    member = F.get("decoded.members", F.lit(0))
    rings = F.get(member["coords"], F.lit(0))
    first = F.get(F.get(rings, F.lit(0)), F.lit(0))
    count = lambda c: F.when(c.isNotNull(), F.size(c))
    hole = F.when(member["kind"] == wkb.POLYGON, F.get(F.get(F.get(rings, F.lit(1)), F.lit(1)), F.lit(0)))
    return rows.select(
        "c_custkey", F.get(first, F.lit(0)).alias("x"), F.get(first, F.lit(1)).alias("y"), member["kind"].alias("kind"),
        count(rings).alias("n_rings"), count(first).alias("n_dims"), hole.alias("hole_x"), "decode_error",
    )


@query(
    "geometry_extent",
    f"""SELECT c_mktsegment, min(CASE k WHEN 2 THEN x - 5 ELSE x END) AS xmin, min(CASE k WHEN 2 THEN y - 5 ELSE y END) AS ymin,
               max(CASE k WHEN 1 THEN x + 9 WHEN 2 THEN x + 1 ELSE x END) AS xmax, max(CASE k WHEN 1 THEN y + 9 WHEN 2 THEN y + 1 ELSE y END) AS ymax,
               string_agg(DISTINCT ['Point', 'Polygon', 'MultiLineString', 'Point Z'][k + 1], ',' ORDER BY ['Point', 'Polygon', 'MultiLineString', 'Point Z'][k + 1])
                 AS geometry_types, count(*) AS geometries
        FROM {_SHAPES_SQL} WHERE k < 4 GROUP BY 1""",
)
def geometry_extent(spark, t):
    found = geometry.extent(_shapes(t), ["c_mktsegment"], geometry.hex_to_wkb(F.col("geometry")))
    return found.withColumn("geometry_types", F.concat_ws(",", "geometry_types"))


@query(
    "geoparquet_roundtrip",
    f"""SELECT c_custkey, c_mktsegment, CASE WHEN k < 4 THEN x END AS x, CASE WHEN k < 4 THEN y END AS y,
               CASE k WHEN 3 THEN '01E9030000' WHEN 0 THEN '0101000000' WHEN 1 THEN '0103000000' WHEN 2 THEN '0105000000' END AS head
        FROM {_SHAPES_SQL}""",
)
def geoparquet_roundtrip(spark, t):
    path = workspace(spark, "geoparquet")
    geoparquet.write(_shapes(t), path)
    rows = spark.read.parquet(path).withColumn("g", wkb.decode_wkb(F.col("geometry")))
    member = F.get("g.geometry.members", F.lit(0))
    first = F.get(F.get(F.get(member["coords"], F.lit(0)), F.lit(0)), F.lit(0))
    return rows.select(
        "c_custkey", "c_mktsegment", F.get(first, F.lit(0)).alias("x"), F.get(first, F.lit(1)).alias("y"),
        F.hex(F.substring("geometry", 1, 5)).alias("head"),
    )


@query(
    "geoparquet_partitions",
    f"""SELECT c_custkey, c_nationkey AS nation, c_mktsegment AS segment, CASE WHEN k < 4 THEN x END AS x FROM {_SHAPES_SQL}""",
)
def geoparquet_partitions(spark, t):
    # All customers, then those of some nations once more, which replaces their partitions.
    path = workspace(spark, "geoparquet-partitions")
    keyed = _shapes(t).join(t.customer.select("c_custkey", F.col("c_nationkey").alias("nation")), "c_custkey").withColumnRenamed("c_mktsegment", "segment")
    geo_layout.write(keyed, path, ["nation", "segment"])
    geo_layout.write(keyed.where("nation % 2 = 0"), path, ["nation", "segment"], mode="dynamic")
    rows = spark.read.parquet(path).withColumn("g", wkb.decode_wkb(F.col("geometry")))
    first = F.get(F.get(F.get(F.get("g.geometry.members", F.lit(0))["coords"], F.lit(0)), F.lit(0)), F.lit(0))
    return rows.select("c_custkey", "nation", "segment", F.get(first, F.lit(0)).alias("x"))


@query(
    "footer_audit",
    """SELECT count(*) AS n_rows, true AS all_geo, 'WKB' AS encoding, 'Point' AS geometry_types, min(c_nationkey)::DOUBLE AS xmin,
              min(c_acctbal) AS ymin, max(c_nationkey)::DOUBLE AS xmax, max(c_acctbal) AS ymax, 'EPSG:8193' AS crs_id FROM customer""",
)
def footer_audit(spark, t):
    path = workspace(spark, "footer_audit")
    geoparquet.write(_points(t), path, crs={"type": "ProjectedCRS", "name": "Local", "id": {"authority": "EPSG", "code": 8193}})
    audited = footers.footer_audit(files.listing(spark, path, "*.parquet"))
    box = F.col("bbox")
    return audited.agg(
        F.sum("num_rows").alias("n_rows"), F.bool_and("has_geo").alias("all_geo"), F.max("encoding").alias("encoding"),
        F.max(F.concat_ws(",", "geometry_types")).alias("geometry_types"), F.min(box[0]).alias("xmin"), F.min(box[1]).alias("ymin"),
        F.max(box[2]).alias("xmax"), F.max(box[3]).alias("ymax"), F.max("crs_id").alias("crs_id"),
    )


@query(
    "finalize_outcomes",
    """SELECT 'nation_' || k AS dataset_name,
              CASE floor(k / 5) WHEN 1 THEN 'skipped_non_spatial' WHEN 2 THEN 'skipped_no_files' WHEN 0 THEN 'error' WHEN 4 THEN 'error' ELSE 'converted' END AS status,
              CASE WHEN floor(k / 5) = 3 THEN n END AS row_count, floor(k / 5) = 4 AS bad_hex, 1 AS run
       FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1)
       UNION ALL
       SELECT 'nation_' || k,
              CASE floor(k / 5) WHEN 1 THEN 'skipped_non_spatial' WHEN 2 THEN 'skipped_no_files' WHEN 0 THEN 'error' WHEN 4 THEN 'error' ELSE 'already_published' END,
              NULL, floor(k / 5) = 4, 2
       FROM (SELECT DISTINCT c_nationkey AS k FROM customer)""",
)
def finalize_outcomes(spark, t):
    # A dataset per nation: without CRS, non-spatial, without files, good, or with a text that is no geometry.
    root = workspace(spark, "finalize")
    kind = F.floor(F.col("c_nationkey") / 5)
    rows = _points(t).withColumns(
        {
            "dataset": F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")),
            "geometry": F.when(kind == 4, F.lit("zz")).otherwise(F.col("geometry")),
        }
    )
    written = rows.where(kind != 2).select("c_custkey", "geometry", "dataset", F.lit(2025).alias("year"))
    written.hint("rebalance", F.col("dataset")).write.partitionBy("dataset", "year").parquet(f"{root}/raw")
    for folder in files.child_names(spark, f"{root}/raw"):
        if folder.startswith("dataset="):
            files.swap_in(spark, f"{root}/raw/{folder}", f"{root}/j/{folder.removeprefix('dataset=')}")
    datasets = t.customer.select("c_nationkey").distinct().select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("dataset_name"),
        (kind == 1).alias("non_spatial"), F.when(kind != 0, F.lit(8193)).alias("crs_epsg"), F.lit(None).cast("int").alias("crs_wkid"),
        F.lit(None).cast("string").alias("crs_wkt"), F.lit("geometry").alias("geometry_column"),
    )
    # The second run finds the good files published and leaves them alone.
    runs = [finalize.finalize(spark, f"{root}/j", datasets, workspace(spark, f"finalize_log_{n}")).withColumn("run", F.lit(n)) for n in (1, 2)]
    outcomes = runs[0].unionByName(runs[1])
    bad = F.coalesce(F.col("error").contains("ValueError"), F.lit(False))
    return outcomes.groupBy("dataset_name", "status", "run").agg(F.sum("row_count").alias("row_count"), F.bool_or(bad).alias("bad_hex"))


