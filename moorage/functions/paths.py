"""Re-layout of dated paths into Hive partitions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relayout_path(relative: Column, prefix: str, hive: bool = False, by_file_date: bool = False) -> Column:
    """Destination of a file at ``relative`` below ``prefix``.

    A file name that starts with a valid YYYYMM moves below year and month folders and loses the
    date, unless that would leave no stem. Otherwise, in Hive mode, 4-digit folders become ``year=``.
    """
    parts = F.split(relative, "/")
    name = F.element_at(parts, -1)
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    year = F.regexp_extract(name, r"^([0-9]{4})(0[1-9]|1[0-2])", 1)
    month = F.regexp_extract(name, r"^([0-9]{4})(0[1-9]|1[0-2])", 2)
    rest = F.substring(name, 7, 1 << 30)
    kept = F.when((rest == "") | rest.startswith("."), name).otherwise(rest)
    label = ("year=", "month=") if hive else ("", "")
    dated = F.concat(
        folders, F.array(F.concat(F.lit(label[0]), year), F.concat(F.lit(label[1]), month), kept)
    )
    undated = parts
    if hive:
        as_year = F.transform(
            folders, lambda p: F.when(p.rlike("^[0-9]{4}$"), F.concat(F.lit("year="), p)).otherwise(p)
        )
        undated = F.concat(as_year, F.array(name))
    chosen = F.when(year != "", dated).otherwise(undated) if by_file_date else undated
    return F.concat_ws("/", F.lit(prefix), chosen)
