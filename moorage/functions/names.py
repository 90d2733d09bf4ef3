"""Column and file naming rules."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize_name(name: object) -> str:
    return re.sub("[ -]", "_", str(name).lower().strip())


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalised column names; names that collide afterwards get a numeric suffix."""
    return df.toDF(*suffix_duplicates([normalize_name(c) for c in df.columns]))


def suffix_duplicates(names: Sequence[str]) -> list[str]:
    """``a, a, b`` -> ``a, a_1, b``; no column is lost."""
    taken, seen, out = set(names), Counter(), []
    for name in names:
        candidate = name
        if seen[name]:
            candidate = f"{name}_{seen[name]}"
            while candidate in taken:
                seen[name] += 1
                candidate = f"{name}_{seen[name]}"
            taken.add(candidate)
        seen[name] += 1
        out.append(candidate)
    return out


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Delimited-file headers: a blank cell is named by position, a repeat gets ``.n``."""
    raw = [c if c else f"Unnamed: {i}" for i, c in enumerate(cells)]
    taken, seen, out = set(raw), Counter(), []
    for name in raw:
        candidate = name
        while seen[name] and candidate in taken:
            candidate = f"{name}.{seen[name]}"
            seen[name] += candidate in taken
        taken.add(candidate)
        seen[name] += 1
        out.append(candidate)
    return out


def snake_case(name: str) -> str:
    """API field name -> stored column name: ``TotalTaxes`` -> ``total_taxes``."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def scanned_file() -> Column:
    """Path of the file behind a row, in the plain form listings use (file metadata is URI-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(file_name(path), r"\.([^.]+)$", 1))


def parquet_target(path: Column) -> Column:
    """Sibling ``.parquet`` path of a source file: stem lowered, spaces to underscores."""
    folder = F.regexp_replace(path, r"[^/]*$", "")
    stem = F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")
    return F.concat(folder, F.replace(F.lower(stem), F.lit(" "), F.lit("_")), F.lit(".parquet"))


def below(path: Column, root: str) -> Column:
    """Part of a listed path below ``root`` (listed paths may carry a scheme that ``root`` lacks)."""
    base = root.rstrip("/") + "/"
    return F.substr(path, F.locate(base, path) + F.lit(len(base)))
