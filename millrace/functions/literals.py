"""List columns that were saved as text, such as ``['Drama', "Kid's"]``."""

from __future__ import annotations

import ast
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: One list of quoted strings, numbers or names, and nothing after it. Most texts are such.
_WHOLE_LIST = (
    r"""(?s)^\s*\[\s*(?:(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|[-+.\w]+)"""
    r"""(?:\s*,\s*(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+"|[-+.\w]+))*+\s*)?\]\s*$"""
)
#: Stands after a text that is put into a list with it, where nothing of the text is left to read.
_END = "\ue000end of the list\ue000"
_JSON_OPTIONS = {"allowUnquotedControlChars": "true"}

# Workers get the reader below with the task and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parse_list(text: Column, exact: bool = False) -> Column:
    """Array of strings from list text; NULL where the text is no list.

    The JSON reader covers the common forms inside the JVM. With ``exact`` the texts it
    refuses (``None`` elements, ``\\x`` escapes, tuples) are read as Python literals in Arrow
    batches; texts it accepted reach the Python worker as NULL.
    """
    # The JSON reader stops at the end of the list and would ignore what follows it.
    whole = F.when(text.rlike(_WHOLE_LIST), True).when(text.rlike(r"^\s*\["), _is_one_value(text))
    parsed = F.when(whole, F.from_json(text, "array<string>", _JSON_OPTIONS))
    if not exact:
        return parsed
    return F.coalesce(parsed, _literal_udf()(F.when(parsed.isNull(), text)))


def _is_one_value(text: Column) -> Column:
    """Whether the JSON reader finds one value in ``text``, nested ones included, and nothing after it."""
    around = F.concat(F.lit("["), text, F.lit(f', "{_END}"]'))
    found = F.from_json(around, "array<string>", _JSON_OPTIONS)
    return (F.size(found) == 2) & (F.get(found, F.lit(1)) == _END)


def list_literal(items: Column) -> Column:
    """Inverse of `parse_list`: list text of an array of strings."""
    items_text = F.array_join(_escaped(items), "', '")
    plain = F.replace(items_text, F.lit("\n"), F.lit("\\n"))
    plain = F.replace(F.replace(plain, F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    return F.when(F.size(items) == 0, F.lit("[]")).when(
        items_text.isNotNull(), F.concat(F.lit("['"), plain, F.lit("']"))
    )


def _escaped(items: Column) -> Column:
    def one(item: Column) -> Column:
        return F.replace(F.replace(item, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))

    return F.transform(items, one)


def _strings(text: str | None) -> list[str | None] | None:
    if text is None:
        return None
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    if not isinstance(value, (list, tuple)):
        return None
    return [None if item is None else str(item) for item in value]


def _literal_udf():
    @F.pandas_udf(ArrayType(StringType()))
    def literal_list(texts: pd.Series) -> pd.Series:
        return texts.map(_strings, na_action="ignore")

    return literal_list
