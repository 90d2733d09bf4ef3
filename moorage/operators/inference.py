"""Column types of all-string frames: integer, else float, else boolean, else text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions import values


def _name(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def clean_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: values.null_tokens_to_null(_name(c)) for c in columns})


# What the values of a column look like, as bits of one mask.
_WHOLE, _LONG_WHOLE, _FRACTION, _FLAG, _TEXT = 1, 2, 4, 8, 16


def _look(col: Column) -> Column:
    """What one value looks like, as a bit."""
    # One pattern match per value in the common cases; a number with none of these marks is whole.
    fraction = None
    for mark in ".eEnN":
        has = col.contains(mark)
        fraction = has if fraction is None else fraction | has
    number = (
        F.when(fraction, _FRACTION)
        .when(F.length(col) <= 18, _WHOLE)
        .when(values.beyond_bigint(col), _LONG_WHOLE)
        .otherwise(_WHOLE)
    )
    flag = col.isin(*values.TRUE_TOKENS, *values.FALSE_TOKENS)
    return F.when(col.isNull(), 0).when(flag, _FLAG).when(col.rlike(values.NUMBER_PATTERN), number).otherwise(_TEXT)


def mask_array(columns: list[str]) -> Column:
    """Aggregate: one bit mask per column, or-ed over values whose null tokens are nulls already."""
    return F.array(*[F.coalesce(F.bit_or(_look(_name(c))), F.lit(0)) for c in columns])


def type_of_mask(mask: int) -> str:
    """Integers beyond 64 bits stay text, as do columns without any value."""
    if mask == _WHOLE:
        return "bigint"
    if mask == _FLAG:
        return "boolean"
    return "double" if mask & _FRACTION and not mask & (_FLAG | _TEXT) else "string"


def fits(mask: Column, kind: str) -> Column:
    """Whether values with this mask can be stored as ``kind``; a column without values fits everywhere."""
    numbers = mask.bitwiseAND(_FLAG | _TEXT) == 0
    allowed = {
        "string": F.lit(True),
        "bigint": mask == _WHOLE,
        "double": (mask == _WHOLE) | (mask.bitwiseAND(_FRACTION) > 0) & numbers,
        "boolean": mask == _FLAG,
    }
    return (mask == 0) | allowed.get(kind, F.lit(False))


def mask_report(df: DataFrame, columns: list[str], keys: list[str] | None = None, **more: Column) -> DataFrame:
    """One scan: ``masks`` aligned with ``columns`` and ``row_count``, overall or per key (such as the file)."""
    # Cleaned in a step of its own, so that each value is looked up once and not per reference.
    return (
        clean_nulls(df, columns)
        .groupBy(*(keys or []))
        .agg(mask_array(columns).alias("masks"), F.count(F.lit(1)).alias("row_count"), *[c.alias(n) for n, c in more.items()])
    )


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Null tokens to null, then every column to its type."""
    convert = {
        "bigint": values.text_to_bigint,
        "double": values.text_to_double,
        "boolean": values.text_to_boolean,
        "string": lambda c: c,
    }
    typed = {c: convert[t](_name(c)) for c, t in types.items()}
    return clean_nulls(df, list(types)).withColumns(typed)


def infer_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Typed frame; a column with one odd value stays text instead of losing that value."""
    columns = columns or df.columns
    masks = mask_report(df, columns).first()["masks"]
    return cast_columns(df, dict(zip(columns, map(type_of_mask, masks))))
