"""Text-to-value rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a delimited file may use for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The texts read as booleans.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

# Integers that may fit 64 bits.
BIGINT_PATTERN = r"^\s*[+-]?0*[0-9]{1,19}\s*$"
# Without backtracking into digits, which a date or a key would set off at every one of them.
NUMBER_PATTERN = (
    r"^\s*+[+-]?(?:(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*+$"
)


def null_tokens_to_null(col: Column) -> Column:
    return F.when(~col.isin(*NULL_TOKENS), col)


def text_to_double(col: Column) -> Column:
    """Numeric value of a text, null when it is not a number (``12d`` is not one).

    The pattern also keeps texts away from the cast, where every failure costs an exception.
    """
    return F.when(col.rlike(NUMBER_PATTERN), col.try_cast("double"))


def text_to_bigint(col: Column) -> Column:
    return F.when(col.rlike(BIGINT_PATTERN), F.trim(col).try_cast("bigint"))


def beyond_bigint(col: Column) -> Column:
    """Whether the digits of a whole number need more than 64 bits.

    Compared as text: a cast that fails costs an exception, which for a column of long keys is one a row.
    """
    digits = F.regexp_extract(col, r"^\s*[+-]?0*([0-9]*)\s*$", 1)
    largest = F.when(F.startswith(F.trim(col), F.lit("-")), "9223372036854775808").otherwise("9223372036854775807")
    return (F.length(digits) > 19) | (F.length(digits) == 19) & (digits > largest)


def text_to_boolean(col: Column) -> Column:
    return F.when(col.isin(*TRUE_TOKENS), F.lit(True)).when(col.isin(*FALSE_TOKENS), F.lit(False))


def numeric(col: Column, is_text: bool) -> Column:
    """Double value of a column; values that are not numbers count as missing."""
    return text_to_double(col) if is_text else col.try_cast("double")
