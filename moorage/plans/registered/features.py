"""Feature pages, catalog, registry, sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from moorage.operators import geometry, registry, sampling
from moorage.plans.registered import query
from moorage.session import workspace
from moorage.sinks import tables
from moorage.sources import catalog, pages


def _point(x, y):
    return F.struct(F.lit("Point").alias("type"), F.array(x.cast("double"), y.cast("double")).alias("coordinates"))


@query(
    "feature_pages_geojson",
    """
    SELECT c_custkey, copy, c_name, c_acctbal,
           CASE WHEN copy = 0 THEN CAST(c_nationkey AS DOUBLE) END AS x,
           CASE WHEN copy = 0 THEN c_acctbal END AS y
    FROM customer CROSS JOIN (VALUES (0), (1)) AS v(copy)
    """,
)
def feature_pages_geojson(spark, t):
    # A page per customer with two features, the second without geometry.
    def feature(copy):
        properties = F.struct("c_custkey", F.lit(copy).alias("copy"), "c_name", "c_acctbal", F.lit("lost").alias("geometry"))
        shape = _point(F.col("c_nationkey"), F.col("c_acctbal"))
        return F.struct(properties.alias("properties"), F.when(F.lit(copy == 0), shape).alias("geometry"))

    body = F.to_json(F.struct(F.array(feature(0), feature(1)).alias("features")))
    landed = t.customer.select(F.lit("customer").alias("layer"), F.col("c_custkey").alias("offset"), body.alias("body"))
    rows = pages.geojson_rows(landed, "c_custkey bigint, copy int, c_name string, c_acctbal double, geometry string")
    at = F.col("decoded.members")[0]["coords"][0][0][0]
    return geometry.decode_hex(rows).select("c_custkey", "copy", "c_name", "c_acctbal", at[0].alias("x"), at[1].alias("y"))


@query(
    "feature_pages_esri",
    """
    SELECT s_suppkey, s_name, s_acctbal, CAST(s_nationkey AS DOUBLE) AS x, s_acctbal AS y, CAST(NULL AS VARCHAR) AS geometry_error
    FROM supplier
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL, NULL, 'unsupported geometry type' FROM supplier
    """,
)
def feature_pages_esri(spark, t):
    # A point page and a multipoint page per supplier; multipoints cannot be converted.
    attributes = F.struct("s_suppkey", "s_name", "s_acctbal")
    shape = F.struct(F.col("s_nationkey").cast("double").alias("x"), F.col("s_acctbal").alias("y"))
    features = F.array(F.struct(attributes.alias("attributes"), shape.alias("geometry")))
    kinds = F.explode(F.array(F.lit("esriGeometryPoint"), F.lit("esriGeometryMultipoint")))
    landed = (
        t.supplier.withColumn("kind", kinds)
        .select("kind", "s_suppkey", "s_name", "s_acctbal", "s_nationkey")
        .select(F.to_json(F.struct(F.col("kind").alias("geometryType"), features.alias("features"))).alias("body"))
    )
    rows = pages.esri_rows(landed, "s_suppkey bigint, s_name string, s_acctbal double")
    at = F.col("decoded.members")[0]["coords"][0][0][0]
    return geometry.decode_hex(rows).select("s_suppkey", "s_name", "s_acctbal", at[0].alias("x"), at[1].alias("y"), "geometry_error")


@query(
    "page_stop_rule",
    """
    WITH p AS (
      SELECT o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS layer,
             CAST(floor(o_orderkey / 2000) AS BIGINT) * 2000 AS "offset", count(*) AS n_features
      FROM orders GROUP BY 1, 2),
    s AS (
      SELECT *, coalesce(max(CASE WHEN n_features < 50 THEN 1 ELSE 0 END) OVER (
               PARTITION BY layer ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped
      FROM p)
    SELECT layer, "offset", CAST(n_features AS BIGINT) AS n_features FROM s WHERE stopped = 0 AND n_features > 0
    """,
)
def page_stop_rule(spark, t):
    layer = F.concat_ws("/", "o_orderpriority", F.year("o_orderdate").cast("string"))
    profiled = (
        t.orders.select(layer.alias("layer"), (F.floor(F.col("o_orderkey") / 2000) * 2000).alias("offset"))
        .groupBy("layer", "offset")
        .agg(F.count(F.lit(1)).alias("n_features"))
    )
    return pages.stop_rule(profiled, page_size=50).select("layer", "offset", "n_features")


def _documents(t):
    """A configuration document per customer, with two datasets."""
    def dataset(name, spatial, enabled):
        return F.struct(
            name.alias("name"),
            F.concat(F.lit("https://maps.example.org/"), F.col("c_custkey").cast("string"), F.lit("/query")).alias("layer_url"),
            F.lit(not spatial).alias("non_spatial"),
            F.struct(F.lit(enabled).alias("enabled")).alias("validation"),
        )

    datasets = F.array(dataset(F.lower("c_mktsegment"), True, True), dataset(F.concat(F.lit("roll_"), "c_custkey"), False, False))
    body = F.to_json(
        F.struct(
            F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("jurisdiction"),
            (F.col("c_nationkey") + 8000).alias("crs"),
            datasets.alias("datasets"),
        )
    )
    return catalog.parse_documents(t.customer.select(body.alias("body")))


_CATALOG_SQL = """
  SELECT 'nation_' || c_nationkey AS jurisdiction, CAST(c_nationkey + 8000 AS INT) AS crs, lower(c_mktsegment) AS name,
         'https://maps.example.org/' || c_custkey || '/query' AS layer_url, false AS non_spatial, true AS enabled FROM customer
  UNION ALL
  SELECT 'nation_' || c_nationkey, CAST(c_nationkey + 8000 AS INT), 'roll_' || c_custkey,
         'https://maps.example.org/' || c_custkey || '/query', true, false FROM customer
"""


@query("catalog_explode", f"SELECT jurisdiction, crs, name, layer_url, non_spatial FROM ({_CATALOG_SQL})")
def catalog_explode(spark, t):
    return catalog.explode_datasets(_documents(t)).select("jurisdiction", "crs", "name", "layer_url", "non_spatial")


@query(
    "catalog_filter",
    f"SELECT jurisdiction, crs, name, layer_url FROM ({_CATALOG_SQL}) WHERE name IN ('building', 'machinery')",
)
def catalog_filter(spark, t):
    rows = catalog.only(catalog.explode_datasets(_documents(t)), ["building", "machinery"])
    return rows.select("jurisdiction", "crs", "name", "layer_url")


@query(
    "catalog_by_jurisdiction",
    f"""SELECT jurisdiction, min(crs) AS crs, count(*) AS n_datasets,
               CAST(sum(CASE WHEN non_spatial THEN 1 ELSE 0 END) AS BIGINT) AS n_non_spatial
        FROM ({_CATALOG_SQL}) GROUP BY jurisdiction""",
)
def catalog_by_jurisdiction(spark, t):
    return catalog.by_jurisdiction(catalog.explode_datasets(_documents(t)))


@query(
    "gate_enabled",
    f"""SELECT jurisdiction, name, layer_url, enabled AND name NOT LIKE 'f%' AND name NOT LIKE 'h%' AS gated
        FROM ({_CATALOG_SQL})""",
)
def gate_enabled(spark, t):
    rows = catalog.explode_datasets(_documents(t))
    sampled = F.when(F.col("name").startswith("f"), F.lit(1000))
    gated = catalog.gate_enabled(True, F.col("name").startswith("h"), sampled)
    return rows.select("jurisdiction", "name", "layer_url", gated.alias("gated"))


def _registry(t):
    # By nation: no document, a corrupt one, then more and more of the reference known.
    key = F.floor(F.col("c_nationkey") / 5)
    reference = F.struct(
        F.when(key == 4, F.when(F.col("c_acctbal") > 0, F.col("c_nationkey") + 2000)).alias("latestWkid"),
        F.when(key >= 3, F.when(F.col("c_acctbal") > 0, F.col("c_nationkey") + 1000)).alias("wkid"),
        F.when(key >= 3, F.concat(F.lit("PROJCS["), "c_name", F.lit("]"))).alias("wkt"),
    )
    intact = F.to_json(
        F.struct(
            F.when(key >= 3, reference).alias("sourceSpatialReference"),
            F.when(key == 2, F.lit("esriGeometryEnvelope")).otherwise(F.lit("esriGeometryPolyline")).alias("geometryType"),
            F.struct(
                F.lit(0.5).alias("xmin"), F.col("c_acctbal").alias("ymin"), F.lit(9.5).alias("xmax"),
                (F.col("c_acctbal") + 1).alias("ymax"),
            ).alias("extent"),
            F.when(key == 4, F.lit(True)).alias("hasZ"),
        )
    )
    body = F.when(key == 1, F.lit('{"geometryType": ')).otherwise(intact)
    url = F.concat(F.lit("https://maps.example.org/"), F.col("c_custkey").cast("string"))
    documents = t.customer.where(key > 0).select(url.alias("service_url"), body.alias("body"))
    datasets = t.customer.select(
        F.col("c_name").alias("name"), F.concat(url, F.lit("/query/")).alias("layer_url"),
        F.lit(None).cast("boolean").alias("non_spatial"), F.lit("FromConfig").alias("geometry_type"),
    )
    return registry.registry(datasets, documents, "2025-01-01T00:00:00")


_REGISTRY_SQL = """
  SELECT c_name AS dataset_name, 'https://maps.example.org/' || c_custkey || '/query/' AS source_url, false AS non_spatial,
         CAST(CASE WHEN k = 4 AND c_acctbal > 0 THEN c_nationkey + 2000 END AS INT) AS crs_epsg,
         CAST(CASE WHEN k >= 3 AND c_acctbal > 0 THEN c_nationkey + 1000 END AS INT) AS crs_wkid,
         CASE WHEN k >= 3 THEN 'PROJCS[' || c_name || ']' END AS crs_wkt,
         CASE WHEN k < 2 THEN 'FromConfig' WHEN k = 2 THEN 'esriGeometryEnvelope' ELSE 'MultiLineString' END AS geometry_type,
         CASE WHEN k >= 2 THEN 0.5::DOUBLE END AS xmin, CASE WHEN k >= 2 THEN c_acctbal END AS ymin,
         CASE WHEN k >= 2 THEN 9.5::DOUBLE END AS xmax, CASE WHEN k >= 2 THEN c_acctbal + 1 END AS ymax,
         CASE WHEN k >= 2 THEN k = 4 END AS has_z, CASE WHEN k >= 2 THEN false END AS has_m
  FROM (SELECT *, floor(c_nationkey / 5)::INT AS k FROM customer)
"""


@query("metadata_registry", _REGISTRY_SQL)
def metadata_registry(spark, t):
    # Written in full each run: what an earlier run had is gone.
    at = workspace(spark, "metadata_registry")
    rows = _registry(t)
    tables.replace(rows.where("has_z"), at)
    tables.replace(rows, at)
    return spark.read.parquet(at).select(
        "dataset_name", "source_url", "non_spatial", "crs_epsg", "crs_wkid", "crs_wkt", "geometry_type",
        "xmin", "ymin", "xmax", "ymax", "has_z", "has_m",
    )


@query(
    "crs_label",
    f"""SELECT dataset_name, coalesce('EPSG:' || crs_epsg, 'EPSG:' || crs_wkid, crs_wkt) AS crs FROM ({_REGISTRY_SQL})""",
)
def crs_label(spark, t):
    return registry.label(_registry(t)).select("dataset_name", "crs")


@query(
    "sample_limit",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS rk FROM lineitem)
       WHERE rk <= 1000""",
)
def sample_limit(spark, t):
    rows = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey")
    return sampling.first_rows(rows, ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_partkey"])


_LOADED = {"passes": "1-URGENT", "fails": "2-HIGH", "broken": "3-MEDIUM", "first": "5-LOW"}


@query(
    "feature_load",
    """
    WITH o AS (SELECT o_orderpriority AS p, count(*) AS n, sum(o_totalprice) AS s, sum(round(o_totalprice * 1.02, 2)) AS more FROM orders GROUP BY 1)
    SELECT 'passes' AS dataset_name, 'loaded' AS outcome, n, CAST(round(more) AS BIGINT) AS total,
           '2025-01-01T00:00:00 no_baseline,2025-02-01T00:00:00 passed' AS audits FROM o WHERE p = '1-URGENT'
    UNION ALL SELECT 'fails', 'failed', n, CAST(round(s) AS BIGINT), '2025-01-01T00:00:00 no_baseline,2025-02-01T00:00:00 failed' FROM o WHERE p = '2-HIGH'
    UNION ALL SELECT 'broken', 'failed', n, CAST(round(s) AS BIGINT), '2025-01-01T00:00:00 no_baseline' FROM o WHERE p = '3-MEDIUM'
    UNION ALL SELECT 'first', 'loaded', CAST(sum(n) AS BIGINT), CAST(round(sum(s)) AS BIGINT), '2025-02-01T00:00:00 no_baseline' FROM o WHERE p >= '4'
    """,
)
def feature_load(spark, t):
    """Two whole loads: a dataset within its tolerance, one beyond it, one with an error page, and a new one."""
    from moorage.plans import feature_load as plan

    root, size = workspace(spark, "feature_load"), 500
    named = F.create_map(*[F.lit(x) for name, p in _LOADED.items() for x in (p, name)])
    layer = F.when(F.col("o_orderpriority") >= "4", F.lit("first")).otherwise(named[F.col("o_orderpriority")])
    place = F.row_number().over(Window.partitionBy("layer").orderBy("o_orderkey")) - 1
    rows = t.orders.select(layer.alias("layer"), "o_orderkey", "o_totalprice")
    rows = rows.withColumn("offset", F.floor(place / size) * size)

    def landed(price):
        properties = F.struct("o_orderkey", price.alias("Total"))
        feature = F.struct(properties.alias("properties"), _point(F.col("o_orderkey"), F.lit(0.0)).alias("geometry"))
        paged = rows.groupBy("layer", "offset").agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("body"))
        return paged.select(F.lit("j").alias("jurisdiction"), "layer", "offset", "body")

    check = {"metrics": [{"parquet_column": "total", "aggregate": "sum", "api_field": "Total", "tolerance_percent": 5.0}]}
    config = {"jurisdictions": {"j": {"datasets": [{"name": n, "layer_url": f"https://maps.example.org/{n}/query", "validation": check} for n in _LOADED]}}}
    documents = spark.createDataFrame([], "service_url string, body string")
    price = F.col("o_totalprice")
    later = F.when(F.col("layer") == "passes", F.round(price * 1.02, 2)).when(F.col("layer") == "fails", price * 1.5).otherwise(price)
    busy = spark.createDataFrame([("j", "broken", 1 << 40, '{"error": {"message": "busy"}}')], "jurisdiction string, layer string, offset bigint, body string")
    loads = [
        ("2025-01-01T00:00:00", landed(price).where("layer <> 'first'"), [n for n in _LOADED if n != "first"]),
        ("2025-02-01T00:00:00", landed(later).unionByName(busy), None),
    ]
    for run_time, pages_of, only in loads:
        options = plan.LoadOptions(root=root, year=2025, run_time=run_time, page_size=size, publish_geometry=False)
        outcome = plan.run(spark, config, pages_of, documents, options, only=only)
    told = spark.createDataFrame([(n.split("/")[1], o.split(":")[0]) for n, o in outcome.items()], "dataset_name string, outcome string")
    audit = spark.read.schema("validation_timestamp string, status string, dataset_name string").parquet(f"{root}/j/{plan.AUDIT_TABLE}")
    entry = F.concat_ws(" ", "validation_timestamp", "status")
    audits = audit.groupBy("dataset_name").agg(F.array_join(F.sort_array(F.collect_list(entry)), ",").alias("audits"))
    stored = None
    # Amounts add up exactly, in whatever order they come: a sum of doubles can fall short of a half.
    total = F.round(F.sum(F.col("total").cast("decimal(31,12)"))).cast("bigint")
    for name in _LOADED:
        one = spark.read.schema("o_orderkey bigint, total double").parquet(f"{root}/j/{name}")
        one = one.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).withColumn("dataset_name", F.lit(name))
        stored = one if stored is None else stored.unionByName(one)
    return told.join(stored, "dataset_name").join(audits, "dataset_name")
