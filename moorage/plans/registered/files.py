"""File scans, typing, table writes, conversion and re-layout."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.functions.names import below, normalize_columns, scanned_file, snake_case
from moorage.functions.paths import relayout_path
from moorage.operators import headers, inference
from moorage.plans.registered import query
from moorage.session import workspace
from moorage.sinks import convert, relayout, tables
from moorage.sources import delimited, files, geojson, parquet, workbook


def _text_files(t, root):
    """Customers as two comma files and a tab file; names carry an accent and quotes."""
    rows = t.customer.select(
        "c_custkey", F.concat("c_name", F.lit(' é "q"')).alias("c_name"), "c_acctbal", F.lit("one, line").alias("note")
    )
    for name, encoding, sep in (("csv_utf8", "UTF-8", ","), ("csv_latin1", "ISO-8859-1", ","), ("tsv_utf8", "UTF-8", "\t")):
        rows.write.option("header", True).option("encoding", encoding).option("sep", sep).option("escape", '"').csv(f"{root}/{name}")


def _source(path):
    return F.regexp_extract(path, "/((?:csv|tsv)_[a-z0-9]+)/", 1)


@query(
    "delimited_scan",
    """SELECT source, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' é "q"' AS c_name, CAST(round(c_acctbal * 100) AS BIGINT) AS cents,
              CASE source WHEN 'csv_lines' THEN 'one' || chr(10) || '5" line, ' || chr(10) || c_mktsegment ELSE 'one, line' END AS note
       FROM customer, (VALUES ('csv_utf8'), ('csv_latin1'), ('tsv_utf8'), ('csv_lines')) AS v(source)""",
)
def delimited_scan(spark, t):
    root = workspace(spark, "delimited_scan")
    _text_files(t, root)
    # Header and values with line breaks inside quotes.
    lines = F.concat(F.lit('one\n5" line, \n'), "c_mktsegment")
    spread = t.customer.select("c_custkey", F.concat("c_name", F.lit(' é "q"')).alias("c_name"), "c_acctbal", lines.alias("no\nte"))
    spread.write.option("header", True).option("escape", '"').csv(f"{root}/csv_lines")
    comma = delimited.read_delimited(spark, [f"{root}/csv_utf8", f"{root}/csv_latin1"], ",")
    rows = comma.unionByName(delimited.read_delimited(spark, f"{root}/tsv_utf8", "\t"))
    rows = rows.unionByName(delimited.read_delimited(spark, f"{root}/csv_lines", ",").withColumnRenamed("no\nte", "note"))
    cents = F.round(F.col("c_acctbal").cast("double") * 100).cast("bigint")
    return rows.select(_source(F.col("source_file")).alias("source"), "c_custkey", "c_name", cents.alias("cents"), "note")


@query(
    "encoding_choice",
    """SELECT source, encoding, false AS multi_line, count(*) AS n_rows
       FROM customer, (VALUES ('csv_utf8', 'UTF-8'), ('csv_latin1', 'ISO-8859-1'), ('tsv_utf8', 'UTF-8')) AS v(source, encoding)
       GROUP BY ALL""",
)
def encoding_choice(spark, t):
    """Rows by the encoding and the way their files are read; a file may hold a header alone, which any encoding reads."""
    root = workspace(spark, "encoding_choice")
    _text_files(t, root)
    found = []
    for paths, sep in (([f"{root}/csv_utf8", f"{root}/csv_latin1"], ","), (f"{root}/tsv_utf8", "\t")):
        for group in delimited.file_groups(delimited.profile(spark, paths, sep)):
            rows = delimited.read_group(spark, group, sep).select(_source(F.col("source_file")).alias("source"))
            found.append(rows.select("source", F.lit(group.encoding).alias("encoding"), F.lit(group.multi_line).alias("multi_line")))
    return reduce(DataFrame.unionByName, found).groupBy("source", "encoding", "multi_line").agg(F.count(F.lit(1)).alias("n_rows"))


def _workbook(cells: list[list[object]]) -> bytes:
    """A one-sheet workbook: texts inline, numbers as numbers."""
    def cell(r, c, v):
        ref = f"{chr(65 + c)}{r + 1}"
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'

    rows = "".join(
        f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>"
        for r, row in enumerate(cells)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Data" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()


def _supplier_workbooks(batches):
    for batch in batches:
        rows = batch.to_pylist()
        content = [
            _workbook(
                [["Supplier report"], ["s_suppkey", "s_name", "s_nationkey", "cents"], [r["s_suppkey"], r["s_name"], r["s_nationkey"], r["cents"]]]
            )
            for r in rows
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{r['s_name']}.xlsx" for r in rows]), pa.array(content, pa.binary())], names=["path", "content"]
        )


@query(
    "excel_cells_scan",
    """WITH s AS (SELECT s_name || '.xlsx' AS file, *, CAST(round(s_acctbal * 100) AS BIGINT) AS cents FROM supplier)
       SELECT file, 'Data' AS sheet, CAST(r AS INT) AS r, CAST(c AS INT) AS c, v FROM (
         SELECT file, 0 AS r, 0 AS c, 'Supplier report' AS v FROM s
         UNION ALL SELECT file, 1, k - 1, ['s_suppkey', 's_name', 's_nationkey', 'cents'][k] FROM s, unnest(range(1, 5)) AS u(k)
         UNION ALL SELECT file, 2, k - 1, [CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), CAST(cents AS VARCHAR)][k]
                   FROM s, unnest(range(1, 5)) AS u(k))""",
)
def excel_cells_scan(spark, t):
    rows = t.supplier.withColumn("cents", F.round(F.col("s_acctbal") * 100).cast("bigint"))
    books = rows.mapInArrow(_supplier_workbooks, "path string, content binary")
    return workbook.excel_cells(books).select("file", "sheet", "r", "c", "v")


@query(
    "header_detect",
    "SELECT c_name AS file, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name AS full_name, c_mktsegment AS full_name_1 FROM customer",
)
def header_detect(spark, t):
    # Cells of one small sheet per customer: two title rows, a header with a repeated name, one data row.
    lines = [
        [F.lit("Customers")],
        [F.lit("as of"), F.lit("2025")],
        [F.lit("C_CustKey"), F.lit("Full Name"), F.lit("full-name ")],
        [F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")],
    ]
    cells = [
        F.struct(F.lit(r).alias("r"), F.lit(c).alias("c"), v.alias("v")) for r, line in enumerate(lines) for c, v in enumerate(line)
    ]
    long = t.customer.select(F.col("c_name").alias("file"), F.lit("Data").alias("sheet"), F.inline(F.array(*cells)))
    path = workspace(spark, "header_detect")
    long.write.parquet(path)
    (table,) = headers.tables(spark.read.parquet(path))
    return table.drop("sheet", "r")


@query(
    "geojson_file_scan",
    "SELECT s_suppkey, s_name, s_nationkey, length(s_name) > 0 AS has_geometry FROM supplier",
)
def geojson_file_scan(spark, t):
    # Collections of at most 100 features, each in a file of its own: neighbours of one input
    # partition, so that no key can make a collection large.
    feature = F.struct(
        F.struct("s_suppkey", "s_name", "s_nationkey").alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array("s_acctbal", "s_acctbal").alias("coordinates")).alias("geometry"),
    )
    collections = t.supplier.withColumn("block", F.floor(F.monotonically_increasing_id() / 100)).groupBy("block").agg(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value")
    )
    root = workspace(spark, "geojson_file_scan")
    collections.write.partitionBy("block").text(root)
    rows = geojson.read_geojson(spark, root)
    return rows.select("s_suppkey", "s_name", F.col("s_nationkey").cast("int").alias("s_nationkey"), F.col("geometry").isNotNull().alias("has_geometry"))


def _by_year(t):
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("year"))


@query(
    "partitioned_scan_pruned",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) >= 1999",
)
def partitioned_scan_pruned(spark, t):
    root = workspace(spark, "partitioned_scan")
    tables.snapshot(_by_year(t), root)
    return parquet.partitioned(spark, root, "year >= 1999").select("o_orderkey", "o_totalprice", "year")


@query("normalized_parquet_scan", "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part")
def normalized_parquet_scan(spark, t):
    root = workspace(spark, "normalized_scan")
    rows = t.part.select("p_partkey", "p_name", "p_size")
    rows.where("p_size <= 25").write.parquet(f"{root}/year=2024")
    rows.where("p_size > 25").withColumn("p_size", F.col("p_size").cast("bigint")).write.parquet(f"{root}/year=2025")
    return parquet.read_normalized(spark, root)


@query(
    "file_listing",
    """SELECT DISTINCT 'year=' || year(o_orderdate) AS folder, 'parquet' AS extension, true AS has_bytes FROM orders
       UNION SELECT 'empty', 'parquet', false FROM orders WHERE year(o_orderdate) = 1999""",
)
def file_listing(spark, t):
    root = workspace(spark, "file_listing")
    tables.snapshot(_by_year(t), root)
    # A text without bytes under a name that is looked for: an upload that broke off at its start.
    broken = t.orders.where("year(o_orderdate) = 1999").select(F.lit(f"{root}/empty/a/b/broken.parquet").alias("path")).distinct()
    files.create_empty(broken)
    listed = files.every_file(spark, root, "*.parquet")
    return listed.select(
        F.split(below(F.col("path"), root), "/")[0].alias("folder"),
        F.element_at(F.split("path", r"\."), -1).alias("extension"), (F.col("length") > 0).alias("has_bytes"),
    ).distinct()


@query("rows_per_file", "SELECT 'year=' || year(o_orderdate) AS folder, count(*) AS row_count FROM orders GROUP BY 1")
def rows_per_file(spark, t):
    root = workspace(spark, "rows_per_file")
    tables.snapshot(_by_year(t), root)
    counted = files.rows_per_file(spark.read.parquet(root))
    return counted.groupBy(F.split(below(F.col("path"), root), "/")[0].alias("folder")).agg(F.sum("row_count").alias("row_count"))


@query(
    "add_partition_cols",
    """SELECT l_orderkey, l_linenumber, l_partkey, '2024' AS year, 'A' AS l_returnflag FROM lineitem""",
)
def add_partition_cols(spark, t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return tables.with_partitions(rows, {"year": "2024", "l_returnflag": "A"})


@query(
    "normalize_columns",
    """SELECT l_orderkey AS order_key, l_linenumber AS "line_number", l_shipdate::DATE AS ship_date, l_tax AS "ship_date_1",
              l_quantity AS total_taxes FROM lineitem""",
)
def normalize_columns_query(spark, t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias(" LINE Number "), F.col("l_shipdate").cast("date").alias("Ship-Date"),
        F.col("l_tax").alias("ship_date"), F.col("l_quantity").alias(snake_case("TotalTaxes")),
    )
    return normalize_columns(rows)


@query(
    "infer_types",
    """SELECT l_orderkey, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber::BIGINT END AS line,
              CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice END AS price, l_returnflag = 'A' AS flag,
              CASE WHEN l_linenumber = 5 THEN 'unknown' ELSE CAST(l_partkey AS VARCHAR) END AS mixed,
              CAST(l_shipdate::DATE AS VARCHAR) AS ship_date, '9' || CAST(10000000000000000000 + l_suppkey AS VARCHAR) AS long_id,
              CAST(NULL AS VARCHAR) AS nothing FROM lineitem""",
)
def infer_types(spark, t):
    number = F.col("l_linenumber")
    text = t.lineitem.select(
        F.concat(F.lit("00"), F.col("l_orderkey").cast("string")).alias("l_orderkey"),
        F.when(number == 3, F.lit("N/A")).otherwise(number.cast("string")).alias("line"),
        F.when(number == 4, F.lit("")).otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(F.col("l_returnflag") == "A", F.lit("True")).otherwise(F.lit("false")).alias("flag"),
        F.when(number == 5, F.lit("unknown")).otherwise(F.col("l_partkey").cast("string")).alias("mixed"),
        F.col("l_shipdate").cast("date").cast("string").alias("ship_date"),
        F.concat(F.lit("9"), (F.lit("10000000000000000000").cast("decimal(20,0)") + F.col("l_suppkey")).cast("string")).alias("long_id"),
        F.lit("NULL").alias("nothing"),
    )
    return inference.infer_types(text)


@query(
    "snapshot_replace",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) <> 2000
       UNION ALL SELECT o_orderkey, o_totalprice * 2, 2000 FROM orders WHERE year(o_orderdate) = 2000 AND o_orderpriority = '1-URGENT'""",
)
def snapshot_replace(spark, t):
    root = workspace(spark, "snapshot_replace")
    rows = _by_year(t)
    tables.snapshot(rows.drop("o_orderpriority"), root)
    again = rows.where((F.col("year") == 2000) & (F.col("o_orderpriority") == "1-URGENT"))
    tables.snapshot(again.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), "year"), root)
    return spark.read.parquet(root)


@query(
    "append_load",
    "SELECT o_orderkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 2001",
)
def append_load(spark, t):
    root = workspace(spark, "append_load")
    rows = _by_year(t)
    tables.append(rows.select("o_orderkey", "o_totalprice"), root)
    tables.append(rows.where("year = 2001").select("o_orderkey", "o_totalprice"), root)
    return spark.read.parquet(root)


@query(
    "hive_layout_write",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
              'year=' || year(o_orderdate) || '/month=' || month(o_orderdate) AS folder FROM orders""",
)
def hive_layout_write(spark, t):
    root = workspace(spark, "hive_layout")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    tables.append(rows, root, ["year", "month"])
    parts = F.split(below(scanned_file(), root), "/")
    return spark.read.parquet(root).select("o_orderkey", "year", "month", F.concat_ws("/", parts[0], parts[1]).alias("folder"))


@query(
    "partition_group_load",
    """SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CAST(year(o_orderdate) AS VARCHAR) AS year, 1 AS loads,
              count(*) OVER (PARTITION BY year(o_orderdate)) AS history_rows FROM orders""",
)
def partition_group_load(spark, t):
    from moorage.operators import discovery, history
    from moorage.plans import file_load

    # One CSV per year, named by it; a second run finds everything loaded.
    root, raw = workspace(spark, "group_load"), workspace(spark, "group_files")
    rows = _by_year(t).select("o_orderkey", F.col("o_totalprice").alias("Total Price"), F.concat(F.col("year"), F.lit("orders")).alias("name"))
    rows.hint("rebalance", F.col("name")).write.partitionBy("name").option("header", True).csv(raw)
    listed = files.listing(spark, raw, "*.csv").select("path")
    named = listed.withColumn("url", F.regexp_replace("path", "/name=([0-9]{4}orders)/", "/$1-"))
    fields = {"year": r"(19|20)\d{2}(?=orders)"}
    found = discovery.manifest(named, ["path"], fields)
    renamed = workspace(spark, "group_landed")
    relayout.relayout(found.select("path", F.concat(F.lit(renamed + "/"), "filename").alias("target")), workspace(spark, "group_log"))
    for _ in range(2):
        file_load.run(
            spark, found.select("url", "filename", "partition_values"), renamed, root, "orders", "j", "csv", fields, "2025-01-01T00:00:00"
        )
    past = history.read_history(spark, f"{root}/j").select(
        F.from_json("partition_values", "year string")["year"].alias("year"), "row_count"
    )
    per_year = past.groupBy("year").agg(F.sum("row_count").alias("history_rows"))
    stored = spark.read.schema("o_orderkey bigint, total_price double, year string").parquet(f"{root}/j/orders")
    loaded = stored.groupBy("o_orderkey", "total_price", "year").agg(F.count(F.lit(1)).cast("int").alias("loads"))
    cents = F.round(F.col("total_price") * 100).cast("bigint")
    return loaded.join(per_year, "year").select("o_orderkey", cents.alias("cents"), "year", "loads", "history_rows")


@query(
    "file_load_outcomes",
    """
    WITH o AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)
    SELECT y AS year, CASE y WHEN 1997 THEN 'column ''total_price'' is double in the table but not in the file'
             WHEN 1998 THEN 'loaded' WHEN 1999 THEN 'file is not landed' WHEN 2000 THEN 'several addresses have this file name' ELSE 'loaded' END AS outcome,
           CASE WHEN y IN (1997, 1999, 2000) THEN NULL WHEN y = 1998 THEN 0 ELSE n END AS row_count,
           CASE WHEN y IN (1997, 1998, 1999, 2000) THEN NULL WHEN y = 1995 THEN 0 ELSE n END AS prices FROM o
    """,
)
def file_load_outcomes(spark, t):
    """Files with an empty column, a conflicting one, only a header, no content on disk, and one name for two addresses."""
    from moorage.operators import discovery, history
    from moorage.plans import file_load

    root, raw = workspace(spark, "load_outcomes"), workspace(spark, "outcome_files")
    year, price = F.year("o_orderdate"), F.col("o_totalprice").cast("string")
    price = F.when(year == 1995, F.lit(None)).when(year == 1997, F.lit("unknown")).otherwise(price)
    rows = t.orders.select("o_orderkey", price.alias("Total Price"), year.alias("y"))
    rows.where(~year.isin(1998, 1999)).hint("rebalance", "y").write.partitionBy("y").option("header", True).csv(f"{raw}/filled")
    spark.createDataFrame([("o_orderkey,Total Price",)], "value string").coalesce(1).write.text(f"{raw}/headed/y=1998")
    listed = files.listing(spark, raw, "part-*").select("path", F.regexp_extract("path", "/y=([0-9]{4})/", 1).alias("y"))
    landed = workspace(spark, "outcomes_landed")
    name = F.concat("y", F.lit("-"), F.substring(F.md5("path"), 1, 8), F.lit(".csv"))
    named = listed.select("path", "y", name.alias("name"))
    relayout.relayout(named.select("path", F.concat(F.lit(landed + "/"), "name").alias("target")), workspace(spark, "outcomes_log"))
    sites = F.explode(F.when(F.col("y") == "2000", F.array(F.lit("north"), F.lit("south"))).otherwise(F.array(F.lit("north"))))
    found = named.select("name", sites.alias("site")).select(F.concat(F.lit("https://files.example.org/"), "site", F.lit("/"), "name").alias("url"))
    found = found.unionByName(spark.createDataFrame([("https://files.example.org/north/1999-gone.csv",)], "url string"))
    fields = {"year": r"^\d{4}"}
    todo = discovery.manifest(found, [], fields)
    first = todo.where("url rlike '/(1996|2001)-'")
    # The first load gives the table its types.
    for part in (first, todo):
        bad = file_load.run(spark, part, landed, root, "orders", "j", "csv", fields, "2025-01-01T00:00:00")
    errors = bad.select(F.regexp_extract("path", "/([0-9]{4})-[^/]*$", 1).cast("bigint").alias("year"), F.col("error").alias("outcome")).distinct()
    past = history.read_history(spark, f"{root}/j").groupBy(F.substring("filename", 1, 4).cast("bigint").alias("year"))
    loaded = past.agg(F.sum("row_count").alias("row_count")).withColumn("outcome", F.lit("loaded"))
    stored = spark.read.schema("o_orderkey bigint, total_price double, year string").parquet(f"{root}/j/orders")
    prices = stored.groupBy(F.col("year").cast("bigint").alias("year")).agg(F.count("total_price").alias("prices"))
    return loaded.unionByName(errors, allowMissingColumns=True).join(prices, "year", "left").select("year", "outcome", "row_count", "prices")


_PATHS_SQL = """
  SELECT o_orderkey, y, m, CASE k WHEN 0 THEN 'sales/' || y || m || 'CSV.parquet' WHEN 1 THEN 'sales/' || y || '/part.parquet'
         WHEN 2 THEN y || '13CSV.parquet' WHEN 3 THEN y || m || '.parquet' ELSE 'a/' || y || '/' || y || m || ' x.parquet' END AS path
  FROM (SELECT o_orderkey, o_orderkey % 5 AS k, CAST(year(o_orderdate) AS VARCHAR) AS y, lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS m FROM orders)
"""


@query(
    "relayout_paths",
    f"""SELECT o_orderkey, path,
          CASE o_orderkey % 5 WHEN 0 THEN 'legacy/sales/year=' || y || '/month=' || m || '/CSV.parquet'
            WHEN 1 THEN 'legacy/sales/year=' || y || '/part.parquet' WHEN 2 THEN 'legacy/' || path
            WHEN 3 THEN 'legacy/year=' || y || '/month=' || m || '/' || path
            ELSE 'legacy/a/' || y || '/year=' || y || '/month=' || m || '/ x.parquet' END AS hive_dated,
          CASE o_orderkey % 5 WHEN 1 THEN 'legacy/sales/year=' || y || '/part.parquet'
            WHEN 4 THEN 'legacy/a/year=' || y || '/' || y || m || ' x.parquet' ELSE 'legacy/' || path END AS hive,
          CASE o_orderkey % 5 WHEN 0 THEN 'legacy/sales/' || y || '/' || m || '/CSV.parquet'
            WHEN 3 THEN 'legacy/' || y || '/' || m || '/' || path
            WHEN 4 THEN 'legacy/a/' || y || '/' || y || '/' || m || '/ x.parquet' ELSE 'legacy/' || path END AS dated
        FROM ({_PATHS_SQL})""",
)
def relayout_paths(spark, t):
    y, m = F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "MM")
    path = F.elt(
        (F.col("o_orderkey") % 5 + 1).cast("int"),
        F.concat(F.lit("sales/"), y, m, F.lit("CSV.parquet")), F.concat(F.lit("sales/"), y, F.lit("/part.parquet")),
        F.concat(y, F.lit("13CSV.parquet")), F.concat(y, m, F.lit(".parquet")), F.concat(F.lit("a/"), y, F.lit("/"), y, m, F.lit(" x.parquet")),
    )
    rows = t.orders.select("o_orderkey", path.alias("path"))
    at = F.col("path")
    return rows.select(
        "o_orderkey", "path", relayout_path(at, "legacy", True, True).alias("hive_dated"),
        relayout_path(at, "legacy", True, False).alias("hive"), relayout_path(at, "legacy", False, True).alias("dated"),
    )


@query("relayout_write", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def relayout_write(spark, t):
    # A legacy tree has plain year folders; a rename makes one of Spark's own output.
    root, target = workspace(spark, "legacy"), workspace(spark, "relayout")
    tables.snapshot(_by_year(t).select("o_orderkey", "o_totalprice", "year"), root)
    for folder in files.child_names(spark, root):
        if folder.startswith("year="):
            files.swap_in(spark, f"{root}/{folder}", f"{root}/{folder.removeprefix('year=')}")
    relayout.relayout(relayout.mapping(spark, root, target, hive=True), workspace(spark, "relayout_log"))
    return spark.read.parquet(target)


@query(
    "conversion_summary",
    """WITH f AS (SELECT CAST(floor(c_nationkey / 2) AS INT) AS block FROM customer GROUP BY 1)
       SELECT status, sum(n)::BIGINT AS n FROM (
         SELECT CASE WHEN block < 3 THEN 'skipped' WHEN block < 6 THEN 'errored' ELSE 'converted' END AS status,
                CASE WHEN block BETWEEN 3 AND 5 THEN 2 ELSE 1 END AS n FROM f) GROUP BY 1""",
)
def conversion_summary(spark, t):
    # Per pair of nations one CSV; some have their output already, some a twin with the same stem.
    root = workspace(spark, "conversion")
    block = F.floor(F.col("c_nationkey") / 2).cast("int")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", block.alias("block"))
    rows.repartition("block").write.partitionBy("block").option("header", True).csv(f"{root}/in")
    listed = files.listing(spark, f"{root}/in", "*.csv").select("path")
    number = F.regexp_extract("path", "/block=([0-9]+)/", 1).cast("int")
    landed = F.concat(F.lit(f"{root}/landed/Some File "), number.cast("string"))
    copies = listed.withColumns({"n": number, "to": landed})
    plain = copies.select("path", F.concat("to", F.lit(".csv")).alias("target"))
    twins = copies.where("n between 3 and 5").select("path", F.concat("to", F.lit(".txt")).alias("target"))
    done = copies.where("n < 3").select("path", F.regexp_replace(F.concat("to", F.lit(".parquet")), "Some File ", "some_file_").alias("target"))
    relayout.relayout(plain.unionByName(twins).unionByName(done), workspace(spark, "conversion_log"))
    outcomes = convert.convert_directory(spark, f"{root}/landed", workspace(spark, "conversion_outcomes"))
    return convert.summary(outcomes)
