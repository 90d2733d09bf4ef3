"""Finding the files of web datasets: index links first, year probing otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from moorage.functions import urls
from moorage.operators.positions import with_position
from moorage.sources import html

MIN_YEAR = 2010
MAX_MISSES = 3


def _newest() -> tuple[Column, str]:
    return F.map_values("partition_values").desc(), "url"


def newest_first(files: DataFrame) -> DataFrame:
    """Latest partition values first; the address settles ties, so equal values spread over tasks."""
    return files.orderBy(*_newest())


def newest_positions(files: DataFrame) -> DataFrame:
    """The same order as a column ``position``, which outlives joins and writes."""
    return with_position(files, *_newest())


def from_links(
    links: DataFrame,
    keys: Sequence[str],
    url_templates: Sequence[str],
    fields: Mapping[str, str],
    base: str = "base_url",
) -> DataFrame:
    """``keys, url, filename, partition_values`` of links that match a template and name a partition.

    ``links`` has the keys, the page's address, ``pos`` and ``href``. Of equal URLs of one dataset the
    first link counts, found with a partial aggregate so that a much repeated URL is no hot spot.
    """
    href = F.col("href")
    matching = None
    for template in url_templates:
        hit = href.rlike(urls.template_regex(template))
        matching = hit if matching is None else matching | hit
    kept = links.where(matching).select(*keys, "pos", "href", urls.resolve(F.col(base), href).alias("url"))
    first = kept.groupBy(*keys, "url").agg(F.min_by("href", "pos").alias("href"))
    named = first.select(*keys, "url", urls.last_segment(F.col("href")).alias("filename"))
    return named.withColumn("partition_values", urls.partition_values(F.col("filename"), fields)).where(
        F.size("partition_values") > 0
    )


def from_pages(
    pages: DataFrame, keys: Sequence[str], url_templates: Sequence[str], fields: Mapping[str, str], base: str = "base_url"
) -> DataFrame:
    """Files linked from landed index pages (``keys``, page address, ``html``)."""
    found = html.links(pages, [*keys, base])
    return from_links(found, keys, url_templates, fields, base)


def candidates(
    datasets: DataFrame, keys: Sequence[str], url_templates: Sequence[str], start_year: int, min_year: int = MIN_YEAR
) -> DataFrame:
    """Every URL worth probing: each year of each dataset with each template, in template order."""
    named = datasets.select(*keys, "base_url", F.posexplode(F.array(*[F.lit(t) for t in url_templates])).alias("attempt", "template"))
    # Resolved once per template; the year is filled in afterwards.
    resolved = named.withColumn("_url", urls.resolve(F.col("base_url"), F.col("template")))
    years = resolved.select("*", F.explode(F.sequence(F.lit(min_year), F.lit(start_year))).alias("year"))
    return years.select(
        *keys, "year", "attempt",
        urls.fill_template(F.col("template"), F.col("year")).alias("filename"),
        urls.fill_template(F.col("_url"), F.col("year")).alias("url"),
    )


def probe_years(
    tried: DataFrame, existing: DataFrame, keys: Sequence[str], start_year: int, max_misses: int = MAX_MISSES
) -> DataFrame:
    """Newest files per dataset down to the first run of ``max_misses`` years without a file.

    ``existing`` holds the URLs that answered. The first template that exists wins a year; the window
    sees at most one row per dataset and year.
    """
    hits = tried.join(existing.select("url").distinct(), "url", "left_semi")
    first = hits.groupBy(*keys, "year").agg(F.min_by(F.struct("filename", "url"), "attempt").alias("hit"))
    newer = W.partitionBy(*keys).orderBy(F.desc("year"))
    misses = F.coalesce(F.lag("year").over(newer), F.lit(start_year + 1)) - F.col("year") - 1
    gaps = first.withColumn("_misses", misses)
    worst = F.max("_misses").over(newer.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        gaps.withColumn("_worst", worst)
        .where(F.col("_worst") < max_misses)
        .select(*keys, "year", F.col("hit.url").alias("url"), F.col("hit.filename").alias("filename"))
    )


def discover(
    pages: DataFrame,
    datasets: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    url_templates: Sequence[str],
    fields: Mapping[str, str],
    start_year: int,
    base: str = "base_url",
    min_year: int = MIN_YEAR,
    max_misses: int = MAX_MISSES,
) -> DataFrame:
    """Files of all datasets: from index pages, or by probing where a dataset's index shows none."""
    indexed = from_pages(pages, keys, url_templates, fields, base)
    silent = datasets.join(indexed.select(*keys).distinct(), list(keys), "left_anti")
    tried = candidates(silent, keys, url_templates, start_year, min_year)
    probed = probe_years(tried, existing, keys, start_year, max_misses)
    probed = probed.withColumn("partition_values", urls.partition_values(F.col("filename"), fields)).drop("year")
    return newest_first(indexed.unionByName(probed))


def manifest(files: DataFrame, keys: Sequence[str], fields: Mapping[str, str], url: str = "url") -> DataFrame:
    """Files named outright: no discovery, no history; kept even without partition values."""
    named = files.select(*keys, F.col(url).alias("url"), urls.last_segment(F.col(url)).alias("filename"))
    return named.withColumn("partition_values", urls.partition_values(F.col("filename"), fields))


def by_partition(files: DataFrame) -> DataFrame:
    """How many files fall into each combination of partition values.

    The files stay rows: a partitioned write brings them together, not an array in one task.
    """
    return files.groupBy("partition_values").agg(F.count(F.lit(1)).alias("n_files"))
