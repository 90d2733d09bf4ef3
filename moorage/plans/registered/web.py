"""Links, discovery, history, manifest, fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from moorage.functions import urls
from moorage.operators import discovery, history
from moorage.plans.registered import query
from moorage.session import workspace
from moorage.sources import files, html

_LINKS_SQL = """
  SELECT page_id, url, CAST(u.i - 1 AS INT) AS pos, l[u.i] AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]+)"', 1) AS l FROM pages), unnest(range(1, len(l) + 1)) AS u(i)
"""
_BASE_SQL = r"regexp_extract(url, '^([^:]+://[^/?#]+)', 1)"


@query("html_links", f"SELECT page_id, pos, href FROM ({_LINKS_SQL})")
def html_links(spark, t):
    return html.links(t.pages.select("page_id", "html"), ["page_id"])


@query("resolve_links", f"SELECT page_id, pos, {_BASE_SQL} || href AS url FROM ({_LINKS_SQL})")
def resolve_links(spark, t):
    found = html.links(t.pages.select("page_id", F.col("url").alias("base_url"), "html"), ["page_id", "base_url"])
    return found.select("page_id", "pos", urls.resolve(F.col("base_url"), F.col("href")).alias("url"))


@query(
    "discover_files",
    f"""SELECT url, filename, part FROM (
          SELECT {_BASE_SQL} || href AS url, split_part(href, '/', -1) AS filename,
                 nullif(regexp_extract(split_part(href, '/', -1), '[a-m]+', 0), '') AS part, page_id
          FROM ({_LINKS_SQL}) WHERE regexp_matches(href, '(?i)(the|tion)'))
        WHERE part IS NOT NULL GROUP BY url, filename, part, page_id""",
)
def discover_files(spark, t):
    pages = t.pages.select("page_id", F.col("url").alias("base_url"), "html")
    found = discovery.from_pages(pages, ["page_id"], ["the", "tion"], {"part": "[a-m]+"})
    return discovery.newest_first(found).select("url", "filename", F.col("partition_values")["part"].alias("part"))


@query(
    "discover_newest",
    f"""SELECT url, part, row_number() OVER (ORDER BY part DESC, url) - 1 AS position FROM (
          SELECT {_BASE_SQL} || href AS url, nullif(regexp_extract(split_part(href, '/', -1), '[a-m]+', 0), '') AS part, page_id
          FROM ({_LINKS_SQL}) WHERE regexp_matches(href, '(?i)(the|tion)'))
        WHERE part IS NOT NULL GROUP BY url, part, page_id""",
)
def discover_newest(spark, t):
    pages = t.pages.select("page_id", F.col("url").alias("base_url"), "html")
    found = discovery.from_pages(pages, ["page_id"], ["the", "tion"], {"part": "[a-m]+"})
    return discovery.newest_positions(found).select("url", F.col("partition_values")["part"].alias("part"), "position")


_TEMPLATES = ["{year}taxroll.xlsx", "TaxRoll{year}.xlsx"]


@query(
    "probe_years",
    """WITH e AS (
         SELECT o_custkey, year(o_orderdate) AS y, min(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS attempt
         FROM orders GROUP BY 1, 2),
       g AS (SELECT *, coalesce(lag(y) OVER w, 2003) - y - 1 AS misses FROM e WINDOW w AS (PARTITION BY o_custkey ORDER BY y DESC)),
       s AS (SELECT *, max(misses) OVER (PARTITION BY o_custkey ORDER BY y DESC ROWS UNBOUNDED PRECEDING) AS worst FROM g)
       SELECT o_custkey AS c_custkey, CAST(y AS INT) AS year,
              CASE WHEN attempt = 0 THEN y || 'taxroll.xlsx' ELSE 'TaxRoll' || y || '.xlsx' END AS filename
       FROM s JOIN customer ON c_custkey = o_custkey WHERE worst < 3""",
)
def probe_years(spark, t):
    # A customer's files exist for the years of their orders, under a name that depends on the order status.
    def base(key):
        return F.concat(F.lit("https://files.example.org/"), key.cast("string"), F.lit("/"))

    datasets = t.customer.select("c_custkey", base(F.col("c_custkey")).alias("base_url"))
    template = F.when(F.col("o_orderstatus") == "F", F.lit(_TEMPLATES[0])).otherwise(F.lit(_TEMPLATES[1]))
    existing = t.orders.select(
        F.concat(base(F.col("o_custkey")), urls.fill_template(template, F.year("o_orderdate"))).alias("url")
    )
    tried = discovery.candidates(datasets, ["c_custkey"], _TEMPLATES, start_year=2002, min_year=1990)
    return discovery.probe_years(tried, existing, ["c_custkey"], start_year=2002).select("c_custkey", "year", "filename")


@query(
    "explicit_file",
    r"""SELECT page_id, url, split_part(url, '/', -1) AS filename,
               nullif(regexp_extract(split_part(url, '/', -1), '[0-9]+', 0), '') AS number FROM pages""",
)
def explicit_file(spark, t):
    named = discovery.manifest(t.pages, ["page_id"], {"number": "[0-9]+"})
    return named.select("page_id", "url", "filename", F.col("partition_values")["number"].alias("number"))


@query(
    "files_by_partition",
    r"""SELECT regexp_extract(url, '^[^:]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[^:]+://[^/]+/([a-z]{2})/', 1) AS lang,
               count(*) AS n_files FROM pages GROUP BY 1, 2""",
)
def files_by_partition(spark, t):
    host = F.try_parse_url("url", F.lit("HOST"))
    lang = F.regexp_extract("url", "^[^:]+://[^/]+/([a-z]{2})/", 1)
    # The order of a map's entries does not matter for grouping.
    forward = F.create_map(F.lit("host"), host, F.lit("lang"), lang)
    backward = F.create_map(F.lit("lang"), lang, F.lit("host"), host)
    tagged = t.pages.select("url", F.when(F.col("page_id") % 2 == 0, forward).otherwise(backward).alias("partition_values"))
    grouped = discovery.by_partition(tagged)
    return grouped.select(
        F.col("partition_values")["host"].alias("host"), F.col("partition_values")["lang"].alias("lang"), "n_files"
    )


def _history(pages):
    """Every page is in, those of some length a second time."""
    loaded = pages.select(
        F.lit("pages").alias("dataset_name"), F.regexp_extract("url", r"\.([a-z]+)/", 1).alias("jurisdiction"), "url",
        urls.last_segment(F.col("url")).alias("filename"), F.create_map(F.lit("id"), F.col("page_id").cast("string")).alias("partition_values"),
        F.length("html").alias("row_count"), F.md5("html").alias("file_hash"),
    )
    again = loaded.where(F.col("row_count") > 5000)
    return history.records(loaded, "2025-01-01T00:00:00").unionByName(history.records(again, "2025-02-01T00:00:00"))


_HISTORY_SQL = r"""
  SELECT 'pages' AS dataset_name, regexp_extract(url, '\.([a-z]+)/', 1) AS jurisdiction, url AS source_url, split_part(url, '/', -1) AS filename,
         '{"id":"' || page_id || '"}' AS partition_values, day AS loaded_at, CAST(length(html) AS BIGINT) AS row_count, md5(html) AS file_hash
  FROM pages, (VALUES ('2025-01-01T00:00:00'), ('2025-02-01T00:00:00')) AS v(day)
  WHERE day < '2025-02' OR length(html) > 5000
"""


@query("history_append", _HISTORY_SQL)
def history_append(spark, t):
    root = workspace(spark, "history_append")
    rows = _history(t.pages)
    history.append(rows.where("loaded_at < '2025-02'"), root)
    history.append(rows.where("loaded_at >= '2025-02'"), root)
    return history.read_history(spark, root)


@query(
    "history_lookup",
    f"SELECT DISTINCT source_url FROM ({_HISTORY_SQL}) WHERE jurisdiction = 'org' AND dataset_name = 'pages'",
)
def history_lookup(spark, t):
    root = workspace(spark, "history_lookup")
    history.append(_history(t.pages), root)
    mine = history.select_history(history.read_history(spark, root), "org", "pages")
    return history.loaded_urls(history.newest_first(mine))


@query(
    "history_newest",
    f"SELECT source_url, loaded_at, row_number() OVER (ORDER BY loaded_at DESC, source_url) - 1 AS position FROM ({_HISTORY_SQL})",
)
def history_newest(spark, t):
    root = workspace(spark, "history_newest")
    history.append(_history(t.pages), root)
    return history.newest_positions(history.read_history(spark, root)).select("source_url", "loaded_at", "position")


_WEB_SQL = """
  WITH o AS (SELECT year(o_orderdate) AS y, o_orderkey, o_totalprice, o_orderpriority FROM orders)
  SELECT 'indexed' AS dataset_name, y AS year, 'loaded' AS status, count(*) AS n FROM o WHERE o_orderpriority < '4' GROUP BY y
  UNION ALL SELECT 'probed', y, 'loaded', count(*) FROM o WHERE o_orderpriority >= '4' AND y >= 1999 GROUP BY y
  UNION ALL SELECT 'absent', 2001, 'errored', NULL
"""


@query("web_file_load", _WEB_SQL)
def web_file_load(spark, t):
    """Three datasets from one configuration: linked in an index, found by probing, and linked but not landed."""
    from moorage.plans import web_load

    root, raw = workspace(spark, "web_load"), workspace(spark, "web_files")
    name = F.when(F.col("o_orderpriority") < "4", F.lit("indexed")).otherwise(F.lit("probed"))
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("Total Price"), name.alias("name"), F.year("o_orderdate").alias("y"))
    rows.hint("rebalance", "name", "y").write.partitionBy("name", "y").option("header", True).csv(raw)
    parts = files.listing(spark, raw, "*.csv").select(
        "path", F.regexp_extract("path", "/name=([a-z]+)/y=([0-9]{4})/", 1).alias("name"), F.regexp_extract("path", "/y=([0-9]{4})/", 1).alias("y")
    )
    at = F.concat(F.lit("https://files.example.org/"), "name", F.lit("/"))
    landed = parts.select(
        F.concat(at, F.when(F.col("name") == "indexed", F.concat(F.lit("sales"), "y", F.lit(".csv"))).otherwise(F.concat("y", F.lit("low.csv")))).alias("url"),
        "path", "name",
    )
    # Two probed years in a row do not answer, so the years before them are not looked for.
    existing = landed.where("name = 'probed' and not url rlike '/199[78]low'")
    links = landed.where("name = 'indexed'").agg(F.sort_array(F.collect_list(F.concat(F.lit('<a href="'), F.regexp_extract("url", "[^/]+$", 0), F.lit('">x</a>')))).alias("l"))
    indexed = links.select(F.lit("indexed").alias("dataset_name"), F.lit("https://files.example.org/indexed/").alias("base_url"), F.array_join("l", "").alias("html"))
    absent = spark.createDataFrame([("absent", "https://files.example.org/absent/", "<a href='gone2001.csv'>x</a>")], "dataset_name string, base_url string, html string")
    field = [{"field": "year", "source": "filename", "pattern": r"\d{4}"}]
    dataset = lambda name, *patterns: {
        "name": name, "base_url": f"https://files.example.org/{name}/", "file_type": "csv", "url_patterns": list(patterns), "partition": field,
    }
    config = {"jurisdictions": {"j": {"datasets": [dataset("indexed", "sales{year}.csv"), dataset("probed", "{year}low.csv"), dataset("absent", "gone{year}.csv")]}}}
    options = web_load.WebOptions(root=root, run_time="2025-01-01T00:00:00", start_year=2002, min_year=1990, max_misses=2)
    for _ in range(2):
        # Nothing that is loaded is loaded again; what is not landed comes back.
        told = web_load.run(spark, config, indexed.unionByName(absent), existing.unionByName(landed.where("name = 'indexed'")), landed.select("url", "path"), options)
    errors = told.where("status = 'errored'").select(
        "dataset_name", F.regexp_extract("url", "([0-9]{4})", 1).cast("bigint").alias("year"), "status", F.lit(None).cast("bigint").alias("n")
    )
    stored = [
        spark.read.parquet(f"{root}/j/{d}").groupBy(F.lit(d).alias("dataset_name"), F.col("year").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
        for d in ("indexed", "probed")
    ]
    loaded = stored[0].unionByName(stored[1]).withColumn("status", F.lit("loaded"))
    return loaded.unionByName(errors).select("dataset_name", "year", "status", "n")


@query(
    "incremental_antijoin",
    f"SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM ({_HISTORY_SQL}) h WHERE h.source_url = p.url AND p.url LIKE 'http:%')",
)
def incremental_antijoin(spark, t):
    # What was fetched over plain http is loaded already.
    return history.unloaded(t.pages.select("page_id", "url"), _history(t.pages.where(F.col("url").startswith("http:"))))


@query("file_fingerprint", "SELECT url AS path, md5(html) AS file_hash FROM pages")
def file_fingerprint(spark, t):
    return files.fingerprint(t.pages.select(F.col("url").alias("path"), F.encode("html", "UTF-8").alias("content")))
