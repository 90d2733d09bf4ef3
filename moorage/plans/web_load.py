"""Web-file load from configuration: discovery, history and load of every configured dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.operators import discovery, history
from moorage.plans import file_load
from moorage.session import settled


@dataclass(frozen=True)
class WebOptions:
    root: str
    run_time: str
    start_year: int
    min_year: int = discovery.MIN_YEAR
    max_misses: int = discovery.MAX_MISSES
    force: bool = False
    replace: bool = False
    parallel_jurisdictions: int = 4


STATUS = "jurisdiction string, dataset_name string, url string, path string, status string, error string"


def discovered_files(
    spark: SparkSession, dataset: Mapping, pages: DataFrame, existing: DataFrame, options: WebOptions
) -> DataFrame:
    """``url, filename, partition_values`` of one dataset, by its own templates and partition fields.

    ``pages`` are its landed index pages (``base_url, html``), ``existing`` the probed URLs that answered.
    """
    own = pages.select(F.lit(dataset["name"]).alias("dataset_name"), "base_url", "html")
    listed = spark.createDataFrame([(dataset["name"], dataset["base_url"])], "dataset_name string, base_url string")
    found = discovery.discover(
        own, listed, existing, ["dataset_name"], list(dataset["url_patterns"]), partition_fields(dataset),
        options.start_year, min_year=options.min_year, max_misses=options.max_misses,
    )
    return found.select("url", "filename", "partition_values")


def partition_fields(dataset: Mapping) -> dict[str, str]:
    return {p["field"]: p["pattern"] for p in dataset.get("partition") or []}


def run(
    spark: SparkSession,
    config: Mapping,
    pages: DataFrame,
    existing: DataFrame,
    landed: DataFrame,
    options: WebOptions,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Discover, subtract the history and load every configured dataset; returns a row for each new file.

    ``pages`` has the index pages (``dataset_name, base_url, html``), ``landed`` where each address was put (``url,
    path``); an address that is not there is reported as not landed. One dataset's failure does not stop the others.
    """

    def load(jurisdiction: str, dataset: Mapping) -> DataFrame:
        name, root = dataset["name"], f"{options.root.rstrip('/')}/{jurisdiction}"
        keys = [F.lit(jurisdiction).alias("jurisdiction"), F.lit(name).alias("dataset_name")]
        try:
            found = discovered_files(spark, dataset, pages.where(F.col("dataset_name") == name), existing, options)
            known = history.select_history(history.read_history(spark, root), jurisdiction, name)
            todo = history.unloaded(found, known, options.force).join(landed.select("url", "path"), "url", "left")
            todo = settled(todo.withColumn("path", F.coalesce("path", "url")), "new-files")
            bad = file_load.load_files(
                spark, todo, options.root, name, jurisdiction, dataset["file_type"], partition_fields(dataset), options.run_time,
                dataset.get("excel"), options.replace,
            )
            at = F.regexp_replace("path", "^file:/+", "/").alias("_at")
            bad = settled(bad.groupBy(at).agg(F.min("error").alias("error")), "file-outcomes")
            told = todo.select("url", "path", at).join(bad, "_at", "left")
            status = F.when(F.col("error").isNull(), "loaded").otherwise("errored")
            return told.select(*keys, "url", "path", status.alias("status"), "error")
        except Exception as exc:  # noqa: BLE001 - the other datasets go on
            row = (jurisdiction, name, None, None, "errored", f"{type(exc).__name__}: {exc}")
            return spark.createDataFrame([row], STATUS)

    def load_all(item: tuple[str, Mapping]) -> list[DataFrame]:
        # One after another: the datasets of a jurisdiction append to one history.
        jurisdiction, body = item
        chosen = [d for d in body.get("datasets") or [] if d.get("url_patterns") and (not only or d["name"] in only)]
        return [load(jurisdiction, dataset) for dataset in chosen]

    out = spark.createDataFrame([], STATUS)
    with ThreadPoolExecutor(options.parallel_jurisdictions) as pool:
        for told in pool.map(load_all, (config.get("jurisdictions") or {}).items()):
            for rows in told:
                out = out.unionByName(rows)
    return settled(out, "web-load")
