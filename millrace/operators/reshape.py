"""Projection and schema operators: each one is a single ``select`` over the input."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    NullType,
    StringType,
    StructType,
    VariantType,
)

from millrace.functions.literals import parse_list


def column(name: str) -> Column:
    """Column by its exact name, also when the name holds dots."""
    return F.col(f"`{name.replace('`', '``')}`")


def flatten(
    df: DataFrame, sep: str = "_", emit_null_parents: bool | Collection[tuple[str, ...]] = False
) -> DataFrame:
    """Nested structs to flat columns, names joined by ``sep``; lists stay values.

    Only the schema is walked. ``emit_null_parents`` adds, for each nested struct, a bare
    column of NULLs under the parent's own name, as a record reader does that meets a
    null parent; given paths (those of `records.discover`), for these structs only.
    """
    flat: list[Column] = []
    names: list[str] = []

    def walk(schema: StructType, value: Column | None, prefix: str, above: tuple[str, ...] = ()) -> None:
        for field in schema.fields:
            path = (*above, field.name)
            inner = column(field.name) if value is None else value.getField(field.name)
            name = f"{prefix}{sep}{field.name}" if prefix else field.name
            if isinstance(field.dataType, StructType):
                if prefix if emit_null_parents is True else emit_null_parents and path in emit_null_parents:
                    add(F.lit(None).cast("string"), name)
                walk(field.dataType, inner, name, path)
            else:
                add(inner, name)

    def add(value: Column, name: str) -> None:
        names.append(name)
        flat.append(value.alias(name))

    walk(df.schema, None, "")
    clashes = [n for n, count in Counter(n.lower() for n in names).items() if count > 1]
    if clashes:
        raise ValueError(f"flattened names are not unique: {sorted(clashes)}")
    return df.select(*flat)


def cast_strings(df: DataFrame, null_token: str | None = None) -> DataFrame:
    """Every column as text: lists, maps and structs as JSON, NULL kept (or ``null_token``)."""

    def text(name: str, kind: DataType) -> Column:
        nested = isinstance(kind, (ArrayType, MapType, StructType, VariantType))
        value = F.to_json(column(name)) if nested else column(name).cast("string")
        if null_token is not None:
            value = F.coalesce(value, F.lit(null_token))
        return value.alias(name)

    return df.select(*[text(f.name, f.dataType) for f in df.schema.fields])


def sanitize(df: DataFrame) -> DataFrame:
    """Columns a plain table cannot hold (void, array) to string; the others unchanged."""
    return df.select(
        *[
            column(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, (NullType, ArrayType))
            else column(f.name)
            for f in df.schema.fields
        ]
    )


def align(df: DataFrame, target: StructType) -> DataFrame:
    """Columns, order, names and types of ``target``.

    Names match regardless of case; columns ``df`` lacks are NULL, columns ``target`` lacks go.
    """
    have = {name.lower(): name for name in df.columns}

    def one(name: str, kind: DataType) -> Column:
        source = have.get(name.lower())
        value = F.lit(None) if source is None else column(source)
        return value.cast(kind).alias(name)

    return df.select(*[one(f.name, f.dataType) for f in target.fields])


def all_strings(names: Sequence[str]) -> StructType:
    """Schema of an all-text table."""
    schema = StructType()
    for name in names:
        schema = schema.add(name, StringType())
    return schema


def explode_lists(df: DataFrame, *names: str) -> DataFrame:
    """One row per list element, the other columns repeated.

    Several lists give their cross product within the row. A row whose list is empty or NULL
    stays, with NULL. Names are resolved as Spark does; an unknown one raises.
    """
    for name in _resolved(df, names):
        df = df.select(
            *[F.explode_outer(column(c)).alias(c) if c == name else column(c) for c in df.columns]
        )
    return df


@dataclass(frozen=True)
class FanOut:
    """Rows before and after a step that makes several of one, and the most that one row became."""

    rows_in: int
    rows_out: int
    largest: int


def observed_lists(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[], FanOut]]:
    """As `explode_lists`, and what gives its `FanOut` after the first action on the result.

    The numbers are summed in the tasks of that action, without another scan. It must read all rows, as a
    write does; until it has ended the call waits.
    """
    observation = Observation()
    became = F.lit(1).cast("bigint")
    for name in _resolved(df, names):
        became = became * F.greatest(F.coalesce(F.size(column(name)), F.lit(0)), F.lit(1))
    seen = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows_in"),
        F.coalesce(F.sum(became), F.lit(0)).alias("rows_out"),
        F.coalesce(F.max(became), F.lit(0)).alias("largest"),
    )
    return explode_lists(seen, *names), lambda: FanOut(**observation.get)


def _resolved(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns' names as ``df`` spells them."""
    return [name if name in df.columns else _spelled(df, name) for name in names]


def _spelled(df: DataFrame, name: str) -> str:
    same = [c for c in df.columns if c.lower() == name.lower()]
    if len(same) != 1 or df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        raise ValueError(f"column {name!r} is not one of {df.columns}")
    return same[0]


def parse_lists(df: DataFrame, *names: str, exact: bool = False) -> DataFrame:
    """List text to arrays in the named columns; an unknown name raises."""
    names = tuple(_resolved(df, names))
    return df.select(
        *[
            parse_list(column(c), exact).alias(c) if c in names else column(c)
            for c in df.columns
        ]
    )


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, columns matched by name, missing ones NULL."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result
