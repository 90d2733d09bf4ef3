"""URL and file-name expressions used by discovery."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the template placeholders stand for.
PLACEHOLDERS = {"{year}": r"\d{4}", "{month}": r"\d{2}"}


def template_regex(template: str) -> str:
    """Case-insensitive search pattern of a file template; everything but placeholders is literal."""
    pieces = re.split(r"(\{year\}|\{month\})", template)
    return "(?i)" + "".join(PLACEHOLDERS.get(p) or re.escape(p) for p in pieces)


def fill_template(template: Column, year: Column, month: str = "01") -> Column:
    filled = F.replace(template, F.lit("{year}"), year.cast("string"))
    return F.replace(filled, F.lit("{month}"), F.lit(month))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def first_match(text: Column, pattern: str) -> Column:
    """Whole first match of ``pattern``, null when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def partition_values(filename: Column, fields: Mapping[str, str]) -> Column:
    """Map of partition field -> value found in a file name; fields without a match are absent."""
    entries = [F.struct(F.lit(f).alias("key"), first_match(filename, p).alias("value")) for f, p in fields.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


@F.arrow_udf(T.StringType())
def _urljoin(base: pa.Array, link: pa.Array) -> pa.Array:
    def join(b, u):
        if b is None or u is None:
            return None
        try:
            return urljoin(b, u)
        except ValueError:
            return None

    return pa.array([join(b, u) for b, u in zip(base.to_pylist(), link.to_pylist())], pa.string())


# So declared, a filter on the result is not moved below the call, where it would call it again.
_urljoin = _urljoin.asNondeterministic()


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of ``link`` on page ``base``.

    Plain links are resolved by expressions; only links whose resolution needs full reference
    rules (dot segments, query or fragment only, odd schemes) reach the Arrow function.
    """
    plain_base = base.rlike(r"^(?i:https?)://[^/?#\s]+(/[^?#;\s]*)?([?#].*)?$")
    scheme = F.regexp_extract(base, r"^([^:]+):", 1)
    origin = F.regexp_extract(base, r"^([^:]+://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"^[^:]+://[^/?#]+(/(?:[^?#]*/)?)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    odd = (
        ~F.coalesce(plain_base, F.lit(False))
        | base.rlike(r"/\.{1,2}(/|$)|^[^?#]*[A-Z][^?#/]*://")
        | base.rlike("^[^:]+://[^?#]*//")
        | link.rlike("^(?!https?://|//).*//")
        | link.rlike(r"(^|/)\.{1,2}(/|$|\?|#)|^[?#;]|^$|#$|\?$|\?#|[\s;]|^///|[\x00-\x20]")
        | (link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") & ~link.rlike(r"^https?://[^/?#]+"))
    )
    plain = (
        F.when(link.rlike("^https?://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .otherwise(F.concat(origin, folder, link))
    )
    hard = _urljoin(F.when(odd, base), F.when(odd, link))
    return F.when(odd, hard).otherwise(plain)
