"""General column functions. All are native expressions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def int_list(text: Column | str) -> Column:
    """Integer list written as text, e.g. ``[101, 1801]`` or ``(101, 1801)``; anything else is []."""
    text = F.regexp_replace(F.translate(F.trim(_col(text)), "()", "[]"), r",\s*\]$", "]")
    return F.coalesce(F.from_json(text, T.ArrayType(T.IntegerType())), F.array().cast("array<int>"))


def int_lists(value: Column | str, dtype: T.DataType) -> Column:
    """As ``int_list``, but real arrays are accepted too."""
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(_col(value).cast("array<int>"), F.array().cast("array<int>"))
    return int_list(value)


def map_labels(codes: Column | str, labels: Column, default: str = "Unknown") -> Column:
    """Label of every code in an array, from a code-to-label map."""
    return F.transform(_col(codes), lambda c: F.coalesce(F.try_element_at(labels, c), F.lit(default)))


def literal_map(entries: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def length(array: Column | str) -> Column:
    return F.coalesce(F.size(_col(array)), F.lit(0))


def padded(array: Column | str, size: int, prefix: str = "Placeholder ") -> Column:
    """The first ``size`` entries; missing ones become ``Placeholder 0``, ``Placeholder 1``, ..."""
    array = F.coalesce(_col(array), F.array().cast("array<string>"))
    filler = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.concat(F.lit(prefix), i.cast("string")))
    return F.slice(F.concat(array, filler), 1, size)


def numbered_columns(array: Column | str, size: int, prefix: str) -> list[Column]:
    """Array entries as columns ``prefix1`` .. ``prefixN``."""
    return [F.try_element_at(_col(array), F.lit(i)).alias(f"{prefix}{i}") for i in range(1, size + 1)]


def other_key(mapping: Column | str, key: Column | str) -> Column:
    """Of a map with two keys, the one that is not ``key``."""
    first = _col(key)
    return F.get(F.filter(F.map_keys(_col(mapping)), lambda k: k != first), F.lit(0))


def flag(condition: Column) -> Column:
    """Condition as 1 or 0; unknown is 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def with_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def years_since(date: Column | str, year: int | Column) -> Column:
    """Calendar-year age, without regard to the day."""
    return (F.lit(year) if isinstance(year, int) else year) - F.year(_col(date))


def seconds_since(timestamp: str, start: str) -> Column:
    """Seconds between a start and a timestamp without time zone, whatever the session's zone."""
    passed = f"`{timestamp}` - TIMESTAMP_NTZ '{start}'"
    return F.expr(f"CAST(CAST({passed} AS INTERVAL SECOND) AS DECIMAL(18, 6))").cast("double")


def rounded(value: Column | str, digits: int = 2) -> Column:
    """Round half to even."""
    return F.bround(_col(value), digits)


def season_number(season: Column | str, mode: str = "stream", strict: bool = True) -> Column:
    """Season text as a number: ``2020`` is 2020, ``2007/08`` is the middle of its two years.

    ``mode="stream"`` reads the second part as a two-digit year of this century (2007.5);
    ``mode="batch"`` takes it as it stands (1007.5). Text that fits neither form is an error, or null unless ``strict``.
    """
    text = _col(season).cast("string")
    parts = F.split(text, "/")
    first, second = F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
    century = {"stream": 2000, "batch": 0}[mode]
    number = (
        F.when(F.size(parts) == 1, first.cast("double"))
        .when(F.size(parts) == 2, (first + century + second) / F.lit(2.0))
    )
    if not strict:
        return number
    invalid = F.raise_error(F.concat(F.lit("Invalid season: "), text)).cast("double")
    return F.when(text.isNull(), F.lit(None).cast("double")).otherwise(F.coalesce(number, invalid))
