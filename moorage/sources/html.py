"""Links of HTML index pages."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text of comments, scripts and styles holds no links.
_IGNORED = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*[^>]*>|$)"
_ANCHOR = r"(?i)<a(?=[\s/>])((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>"
_ATTRIBUTE = r"([^\s\"'>/=][^\s/>=]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)?"


@F.arrow_udf(T.StringType())
def _unescape(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())


# So declared, a filter on the result is not moved below the call, where it would call it again.
_unescape = _unescape.asNondeterministic()


def anchor_hrefs(page: Column) -> Column:
    """Array of the raw ``href`` values of all anchors in document order."""
    tags = F.regexp_extract_all(F.regexp_replace(page, _IGNORED, ""), F.lit(_ANCHOR), F.lit(1))
    pairs = F.flatten(
        F.transform(
            tags,
            lambda t: F.arrays_zip(
                F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(1)).alias("name"),
                F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(2)).alias("value"),
            ),
        )
    )
    hrefs = F.filter(pairs, lambda p: F.lower(p["name"]) == "href")
    return F.transform(hrefs, lambda p: F.regexp_replace(p["value"], r"(?s)^([\"'])(.*)\1$", "$2"))


def links(pages: DataFrame, key: list[str], page: str = "html") -> DataFrame:
    """``key, pos, href``: every non-empty link, numbered in document order.

    Character references are decoded; only values that contain one are passed to Python.
    """
    # The outer form keeps Spark from running the patterns a second time to test the array.
    found = pages.select(*key, F.posexplode_outer(anchor_hrefs(F.col(page))).alias("pos", "raw")).where(F.col("pos").isNotNull())
    escaped = F.col("raw").contains("&")
    href = F.when(escaped, _unescape(F.when(escaped, F.col("raw")))).otherwise(F.col("raw"))
    return found.select(*key, "pos", href.alias("href")).where(F.col("href") != "")
