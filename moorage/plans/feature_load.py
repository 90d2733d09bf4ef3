"""Feature load: landed pages -> staged rows with metrics -> gate -> yearly snapshot -> GeoParquet.

Rows are written once, to a staging folder. The gate looks at metric rows only, and a dataset that
passes is promoted by moving its folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.functions.names import snake_case, suffix_duplicates
from moorage.operators import gate, registry
from moorage.operators.metrics import ROW_COUNT, Metric, baseline_aggregates, long_form, metric_names, observed
from moorage.operators.sampling import first_rows
from moorage.session import settled
from moorage.sinks import finalize, tables
from moorage.sources import catalog, files, pages

KEYS = ["jurisdiction", "dataset_name"]
LONG = "jurisdiction string, dataset_name string, metric_name string, value double"
AUDIT_TABLE, REGISTRY_TABLE, WARNING_TABLE = "validation_results", "spatial_metadata_registry", "load_warnings"
BROKEN = "_broken_geometries"


@dataclass(frozen=True)
class LoadOptions:
    root: str
    year: int
    run_time: str
    page_size: int = pages.PAGE_SIZE
    skip_validation: bool = False
    max_records: int | None = None
    baseline: str = "same_year"
    row_count_tolerance: float = gate.DEFAULT_TOLERANCE
    publish_geometry: bool = True
    allow_incomplete: bool = False
    parallel_datasets: int = 4
    projjson: Mapping[str, dict] = field(default_factory=dict)


class IncompleteError(Exception):
    """A dataset's pages show errors or gaps."""


def _dataset_path(options: LoadOptions, jurisdiction: str, name: str) -> str:
    return f"{options.root.rstrip('/')}/{jurisdiction}/{name}"


def _log_path(options: LoadOptions, jurisdiction: str, table: str, name: str) -> str:
    """A dataset's own partition of a log table: loads at the same time must not share an output folder."""
    return f"{_dataset_path(options, jurisdiction, table)}/dataset_name={quote(name, safe='')}"


def _metrics(dataset: Mapping) -> list[Metric]:
    listed = (dataset.get("validation") or {}).get("metrics") or []
    return [
        Metric(m["parquet_column"], m["aggregate"], m.get("api_field"), m.get("tolerance_percent")) for m in listed
    ]


def _gated(dataset: Mapping, options: LoadOptions) -> bool:
    enabled = (dataset.get("validation") or {}).get("enabled")
    return enabled is not False and not options.skip_validation and options.max_records is None


def _baseline_path(spark: SparkSession, options: LoadOptions, target: str) -> str:
    if options.baseline == "latest":
        years = [n for n in files.child_names(spark, target) if n.startswith("year=")]
        return f"{target}/{max(years, default=f'year={options.year}')}"
    return f"{target}/year={options.year}"


def _feature_rows(
    landed: DataFrame, profile: DataFrame, crs: int | None, options: LoadOptions, attributes: T.StructType | None
) -> DataFrame:
    key = "attributes" if crs else "properties"
    # The reading pass parses each body once; pages that are empty or carry an error have no features.
    kept = pages.until_stop(landed, pages.stop_offsets(profile, options.page_size))
    schema = attributes if attributes is not None else pages.infer_attributes(kept, key)
    read = pages.esri_rows if crs else pages.geojson_rows
    if options.max_records is None:
        return read(kept, schema)
    # The profile has a row a page: pages whose predecessors do not hold enough features yet.
    before = F.sum("n_features").over(Window.orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    needed = profile.where("n_features > 0").withColumn("_before", F.coalesce(before, F.lit(0)))
    needed = settled(needed.where(F.col("_before") < options.max_records).select("offset"), "sample-pages")
    rows = read(kept.join(needed, "offset", "left_semi"), schema, keep=["offset"])
    # Rows of a page are unnested in one task and in order.
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    return first_rows(rows, [], ["offset", "_place"], options.max_records).drop("offset", "_place")


def load_dataset(
    spark: SparkSession,
    landed: DataFrame,
    jurisdiction: str,
    crs: int | None,
    dataset: Mapping,
    options: LoadOptions,
    attributes: T.StructType | None = None,
) -> DataFrame:
    """Load one dataset's pages and return its gate results (none when not gated or without baseline).

    Pages with errors, pages the service cut short and geometries that could not be converted are noted in
    the table ``load_warnings``. Pages with errors or gaps raise ``IncompleteError`` unless ``allow_incomplete`` is
    set; a failed gate raises ``GateError`` after the audit row is written. The stored snapshot is then untouched.
    """
    name, metrics = dataset["name"], _metrics(dataset)
    target = _dataset_path(options, jurisdiction, name)
    staged = f"{options.root.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex}"
    # A light pass counts features per page; what it finds is small and used twice.
    profile = settled(pages.page_profile(landed).drop("body"), "page-profile")
    warned = settled(
        pages.page_warnings(profile, options.page_size).select(
            F.concat(F.lit("page at offset "), F.col("offset"), F.lit(": "), "reason").alias("warning")
        ),
        "page-warnings",
    )

    def note(warnings: DataFrame) -> None:
        own = warnings.select(F.lit(jurisdiction).alias("jurisdiction"), F.lit(options.run_time).alias("loaded_at"), "warning")
        tables.append(own, _log_path(options, jurisdiction, WARNING_TABLE, name))

    # Known from the profile: nothing is written of a load that is to be refused.
    if not options.allow_incomplete and options.max_records is None and (incomplete := warned.first()):
        note(warned)
        raise IncompleteError(f"{jurisdiction}/{name}: {incomplete.warning}")
    rows = _feature_rows(landed, profile, crs, options, attributes)
    rows, seen = observed(
        rows, metrics, f"{jurisdiction}.{name}", source=True, **{BROKEN: F.count("geometry_error")}
    )
    rows.drop("geometry_error").toDF(*suffix_duplicates([snake_case(c) for c in rows.columns if c != "geometry_error"])).write.parquet(staged)

    values = dict(seen.get)
    broken = values.pop(BROKEN)
    if broken:
        warned = warned.unionByName(spark.createDataFrame([(f"{broken} geometries could not be converted",)], "warning string"))
    note(warned)
    datasets = spark.createDataFrame(
        [(jurisdiction, name, _tolerance(dataset))], "jurisdiction string, dataset_name string, dataset_tolerance double"
    )
    results = None
    if _gated(dataset, options):
        at = _baseline_path(spark, options, target)
        incoming = spark.createDataFrame(
            [(jurisdiction, name, k, float(v)) for k, v in values.items() if v is not None], LONG
        )
        stored = spark.createDataFrame([], LONG)
        if files.has_data(spark, at):
            old = spark.read.parquet(at)
            stored = long_form(
                old.agg(*baseline_aggregates(old, metrics)).select(
                    F.lit(jurisdiction).alias("jurisdiction"), F.lit(name).alias("dataset_name"), "*"
                ),
                KEYS,
                [ROW_COUNT, *metric_names(metrics)],
            )
        expected = gate.checks(datasets, KEYS, metrics, options.row_count_tolerance)
        compared = gate.compare(expected, stored, incoming, KEYS)
        # A handful of rows, fixed here so that the baseline is scanned once.
        results = spark.createDataFrame(compared.collect(), compared.schema)
        record = gate.audit(datasets, results, KEYS, options.run_time)
        tables.append(record.drop("dataset_name"), _log_path(options, jurisdiction, AUDIT_TABLE, name))
        failed = [r for r in results.where(~F.col("passed")).collect()]
        if failed:
            files.delete(spark, staged)
            raise gate.GateError(
                f"{jurisdiction}/{name}: " + "; ".join(f"{r.metric_name}: {r.error_message or f'off by {r.percent_difference:.1f}%'}" for r in failed)
            )
    files.swap_in(spark, staged, f"{target}/year={options.year}")
    return results if results is not None else spark.createDataFrame([], "jurisdiction string")


def _tolerance(dataset: Mapping) -> float | None:
    value = (dataset.get("validation") or {}).get("tolerance_percent")
    return None if value is None else float(value)


def run(
    spark: SparkSession,
    config: Mapping,
    landed: DataFrame,
    documents: DataFrame,
    options: LoadOptions,
    only: Sequence[str] | None = None,
    attributes: Mapping[str, T.StructType] | None = None,
) -> dict[str, str]:
    """Load every configured dataset; returns ``jurisdiction/dataset -> status``.

    ``landed`` holds the pages of all datasets (``jurisdiction, layer, offset, body``; the layer is the
    dataset's name; stored partitioned by the first two, each dataset's load reads only its own pages), ``documents`` the service metadata (``service_url, body``). One dataset's failure
    does not keep the others from loading.
    """
    outcome: dict[str, str] = {}
    for jurisdiction, body in (config.get("jurisdictions") or {}).items():
        chosen = [d for d in body.get("datasets") or [] if not only or d["name"] in only]
        if not chosen:
            continue

        def load(dataset: Mapping, jurisdiction: str = jurisdiction, crs: int | None = body.get("crs")) -> str:
            mine = landed.where((F.col("jurisdiction") == jurisdiction) & (F.col("layer") == dataset["name"]))
            try:
                load_dataset(spark, mine, jurisdiction, crs, dataset, options, (attributes or {}).get(dataset["name"]))
                return "loaded"
            except (gate.GateError, IncompleteError) as exc:
                return f"failed: {exc}"
            except Exception as exc:  # noqa: BLE001 - the other datasets go on
                return f"errored: {type(exc).__name__}: {exc}"

        # Datasets are independent jobs; several at a time keep the cluster busy.
        with ThreadPoolExecutor(options.parallel_datasets) as pool:
            for dataset, status in zip(chosen, pool.map(load, chosen)):
                outcome[f"{jurisdiction}/{dataset['name']}"] = status
        rows = catalog.explode_datasets(catalog.from_config(spark, {"jurisdictions": {jurisdiction: {**body, "datasets": chosen}}}))
        registered = registry.registry(rows, documents, options.run_time)
        at = _dataset_path(options, jurisdiction, REGISTRY_TABLE)
        tables.replace(registered, at)
        if options.publish_geometry and options.max_records is None:
            root = f"{options.root.rstrip('/')}/{jurisdiction}"
            log = f"{options.root.rstrip('/')}/_log/finalize-{jurisdiction}-{uuid.uuid4().hex}"
            finalize.finalize(
                spark, root, spark.read.parquet(at), log, projjson=options.projjson, requested_crs=body.get("crs")
            )
    return outcome

