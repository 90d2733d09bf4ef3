"""Tables out of spreadsheet cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.functions import values
from moorage.functions.names import normalize_name, suffix_duplicates
from moorage.session import settled, workspace

KEYS = ["file", "sheet"]


def sheet_rows(cells: DataFrame) -> DataFrame:
    """One row per sheet row: map of column number -> value, without null tokens.

    A row holds at most the columns a sheet may have, so the list behind the map is bounded. Rows
    without any value have an empty map.
    """
    value = values.null_tokens_to_null(F.col("v"))
    entry = F.when(value.isNotNull(), F.struct("c", "v"))
    return cells.groupBy(*KEYS, "r").agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))


def header_rows(rows: DataFrame, min_columns: int = 3, explicit: int | None = None) -> DataFrame:
    """Header row number per sheet: the first row with enough values, or the given one."""
    if explicit is not None:
        found = F.lit(explicit)
    else:
        found = F.min(F.when(F.size("cells") >= min_columns, F.col("r")))
    grouped = rows.groupBy(*KEYS).agg(found.cast("int").alias("header_row"))
    missing = F.lit(f"no header: every row has fewer than {min_columns} filled cells")
    return grouped.withColumn("error", F.when(F.col("header_row").isNull(), missing))


def header_cells(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """``file, sheet, header_row, header, key``: the header's column numbers and names, and a key of them."""
    found = headers.where(F.col("header_row").isNotNull()).select(*KEYS, F.col("header_row").alias("r"))
    entries = F.array_sort(F.map_entries("cells"))
    return rows.join(found, [*KEYS, "r"]).select(
        *KEYS, F.col("r").alias("header_row"), entries.alias("header"), F.md5(F.to_json(entries)).alias("key")
    )


def body_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows below the header, with the key of their header."""
    below = found.select(*KEYS, "header_row", "key")
    return rows.join(below, KEYS).where(F.col("r") > F.col("header_row")).drop("header_row")


def tables(cells: DataFrame, min_columns: int = 3, explicit: int | None = None, normalize: bool = True) -> list[DataFrame]:
    """One text frame per distinct header, with ``file``, ``sheet`` and the sheet row ``r``.

    Only the distinct headers reach the driver; a plan cannot have columns it does not know. Columns
    with values but no name are called ``nan``; names used twice get a numeric suffix.
    """
    rows = settled(sheet_rows(cells), "sheet-rows")
    return sheet_tables(rows, settled(header_rows(rows, min_columns, explicit), "sheet-headers"), normalize)


def sheet_tables(rows: DataFrame, headers: DataFrame, normalize: bool = True) -> list[DataFrame]:
    """The same from sheet rows and header rows that are written already.

    Rows are dealt and written by header once, and each table is read from its own folder, so that neither scans nor plans
    grow with the number of headers.
    """
    # One row per sheet: settled, so that its size decides how the many body rows are joined.
    found = settled(header_cells(rows, headers), "sheet-names")
    body, path = body_rows(rows, found), workspace(rows.sparkSession, "sheet-tables")
    body.hint("rebalance", F.col("key")).write.partitionBy("key").parquet(path)
    reader = rows.sparkSession.read.schema(body.drop("key").schema)
    used = rows.sparkSession.read.schema(body.schema).parquet(path).select("key", F.explode_outer(F.map_keys("cells")).alias("c")).distinct()
    columns = used.groupBy("key").agg(F.collect_list("c").alias("used"))
    distinct = found.groupBy("key").agg(F.min("header").alias("header")).join(columns, "key", "left").orderBy("key")
    out = []
    for row in distinct.toLocalIterator():
        names = {e["key"]: e["value"] for e in row.header}
        numbers = sorted(set(names) | set(row.used or []))
        raw = [names.get(n, "nan") for n in numbers]
        labels = suffix_duplicates([normalize_name(n) for n in raw] if normalize else raw)
        # A header without rows below it has no folder.
        own = reader.parquet(f"{path}/key={row.key}") if row.used is not None else rows.limit(0)
        out.append(own.select(*KEYS, "r", *[F.col("cells")[n].alias(label) for n, label in zip(numbers, labels)]))
    return out
