"""Scalar column functions; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a CSV reader of data frames takes for a missing value.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Patterns of pipeline source text.
DATETIME_CALL = r"(datetime\([^)]+\))"
DATETIME_ARGUMENTS = r"datetime\(([\d\s,]+)\)"


def first_group(text: Column, pattern: str, default: str) -> Column:
    """First capture group of the first match, or ``default`` where nothing matches."""
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found == "", F.lit(default)).otherwise(found)


def replace_all(text: Column, table: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, applied one after the other in table order."""
    for old, new in table:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def quote_datetimes(text: Column) -> Column:
    """Put double quotes around every ``datetime(...)`` call."""
    return F.regexp_replace(text, DATETIME_CALL, '"$1"')


def datetime_value(text: Column) -> Column:
    """The timestamp of the first ``datetime(y, m, d, ...)`` call in a text, else NULL."""
    parts = F.split(F.regexp_extract(text, DATETIME_ARGUMENTS, 1), ",")

    def part(i: int) -> Column:
        return F.trim(F.get(parts, F.lit(i))).try_cast("int")

    def clock(i: int) -> Column:
        return F.coalesce(part(i), F.lit(0))

    seconds = clock(5) + clock(6).cast("decimal(16,6)") / 1_000_000
    return F.try_make_timestamp_ntz(part(0), part(1), part(2), clock(3), clock(4), seconds)


def base64_text(text: Column) -> Column:
    """Base64 of the UTF-8 bytes, on one line."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), "[\r\n]", "")


def path_join(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def default_to(value: Column, default: str | None) -> Column:
    return F.coalesce(value, F.lit(default))


def lookup(key: Column, table: Mapping[str, str], default: str | None) -> Column:
    """Value of ``key`` in a small parameter table, or ``default``."""
    result = F.lit(default)
    for name, value in table.items():
        result = F.when(key == name, F.lit(value)).otherwise(result)
    return result


def null_tokens(text: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    """NULL where the text is one of the missing-value tokens."""
    return F.when(text.isin(*tokens), F.lit(None)).otherwise(text)
