"""Keyed operators: de-duplication, keyed update, insert of new rows, upsert.

How a hot key is kept out of a single task:

* `keep_one` cuts every key to one row per input task before the shuffle;
* target keys are made distinct, with map-side combine, before they meet the staged rows;
* target rows with a NULL key cannot match, so they never enter the shuffle;
* the update join gives both sides their own exchange on a key hash, the shape in which
  adaptive execution splits a skewed target partition (the staged side is one row per key).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    AtomicType,
    DataType,
    NullType,
    StringType,
    StructType,
    VariantType,
)

from millrace.operators.reshape import align, column


#: Known to be more staged rows than that, they are not sent to every task: Spark decides by the size of files, of
#: which rows that resemble each other fill very few.
BROADCAST_ROWS = 50_000


def keep_one(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[Column] = ()) -> DataFrame:
    """One row per key (NULLs form a key too): the first in ``tiebreak`` order.

    Rows that tie are told apart by their remaining columns, so a task that is run again
    picks the same row.
    """
    rest = [
        column(f.name).desc_nulls_first()
        for f in df.schema.fields
        if f.name not in keys and _orderable(f.dataType)
    ]
    order = [*tiebreak, *rest] or [F.lit(1)]
    ranked = F.row_number().over(Window.partitionBy(*map(column, keys)).orderBy(*order))
    rank = free_name("_rn", df)
    return df.withColumn(rank, ranked).where(column(rank) == 1).drop(rank)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` begins with it in any case."""
    taken = [c.lower() for frame in frames for c in frame.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    return isinstance(kind, (AtomicType, NullType)) and not isinstance(kind, VariantType)


def matched_rows(
    staging: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Staged rows whose key is in the target."""
    return _hash_join(staging, _key_set(target, keys), keys, "left_semi", null_safe)


def new_rows(
    staging: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Staged rows whose key is not in the target; a NULL key never is, unless ``null_safe``."""
    present = _present_keys(target, staging, keys, null_safe)
    if null_safe:
        return _hash_join(staging, present, keys, "left_anti", True)
    keyed, keyless = _split_null_keys(staging, keys)
    return _union(_hash_join(keyed, present, keys, "left_anti", False), keyless)


def update_from(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target rows, each one whose key is staged taking all columns of the staged row.

    ``staged`` holds one row per key; it is aligned to the target. A staged NULL overwrites.
    """
    staged = align(staged, target.schema)
    if null_safe:
        return _take_staged(target, staged, keys, True)
    keyed, keyless = _split_null_keys(target, keys)
    updated = _take_staged(keyed, _split_null_keys(staged, keys)[0], keys, False)
    return _union(updated, keyless)


def insert_new(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Target plus the staged rows, aligned to it, whose key it lacks."""
    return target.unionByName(new_rows(align(staged, target.schema), target, keys, null_safe))


def upsert(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    staged_rows: int | None = None,
) -> DataFrame:
    """Next version of ``target``: matched rows updated, new keys inserted once.

    A full outer join would do both in one step, but cannot be split at a hot target key, nor
    broadcast. See `replace_by_key` for a target with one row per key. ``staged_rows`` says how many
    rows ``staging`` has, where that was counted; above ``BROADCAST_ROWS`` the joins shuffle both sides.
    """
    many = _is_many(staged_rows)
    staging = align(staging, target.schema)
    staged = keep_one(staging, keys, tiebreak)
    if null_safe:
        updated = _take_staged(target, staged, keys, True, many)
        present = _present_keys(target, staging, keys, True, many)
        return _union(updated, _hash_join(staged, present, keys, "left_anti", True, many=many))
    # The same filter on both uses of the staged rows lets Spark reuse their exchange.
    staged, fresh_keyless = _split_null_keys(staged, keys)
    keyed, keyless = _split_null_keys(target, keys)
    updated = _take_staged(keyed, staged, keys, False, many)
    present = _present_keys(keyed, staging, keys, False, many)
    fresh = staged.join(_shuffled(present, many), list(keys), "left_anti")
    return _union(updated, keyless, fresh, fresh_keyless)


def replace_by_key(
    target: DataFrame,
    staging: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    staged_rows: int | None = None,
) -> DataFrame:
    """Upsert for a target with one row per key, such as a table that upserts built up.

    An update sets every column, so the result is the target rows whose key is not staged, plus
    the staged rows. The target is read once and meets the batch's keys only: batches of some
    million rows leave it unshuffled where Spark may broadcast that much key data. If the target
    has a key twice, a staged row replaces all its rows by one. ``staged_rows`` as in `upsert`.
    """
    many = _is_many(staged_rows)
    staging = align(staging, target.schema)
    staged = keep_one(staging, keys, tiebreak)
    wanted = _key_set(staging, keys)
    if null_safe:
        return _union(_hash_join(target, wanted, keys, "left_anti", True, many=many), staged)
    keyed, keyless = _split_null_keys(target, keys)
    return _union(_hash_join(keyed, wanted, keys, "left_anti", False, many=many), keyless, staged)


def _is_many(staged_rows: int | None) -> bool:
    return staged_rows is not None and staged_rows > BROADCAST_ROWS


def _shuffled(side: DataFrame, many: bool) -> DataFrame:
    """``side`` of a join, which is not to be sent to every task if it has ``many`` rows."""
    return side.hint("merge") if many else side


def _key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*map(column, keys)).distinct()


def _present_keys(
    target: DataFrame, staging: DataFrame, keys: Sequence[str], null_safe: bool, many: bool = False
) -> DataFrame:
    """Distinct target keys that are staged. Reads the key columns only.

    Where the staged keys are small enough for Spark to broadcast them, the semi join is
    pushed below the distinct and cuts the target's keys during the scan.
    """
    wanted, present = _key_set(staging, keys), _key_set(target, keys)
    if null_safe:
        return _hash_join(present, wanted, keys, "left_semi", True, many=many)
    return present.join(_shuffled(wanted, many), list(keys), "left_semi")


def _split_null_keys(
    df: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a whole key, and rows with a NULL in it (None if the schema rules them out)."""
    nullable = [f.name for f in df.schema.fields if f.name in keys and f.nullable]
    if not nullable:
        return df, None
    keyless = reduce(Column.__or__, [column(k).isNull() for k in nullable])
    return df.where(~keyless), df.where(keyless)


def _union(first: DataFrame, *others: DataFrame | None) -> DataFrame:
    return reduce(DataFrame.unionByName, [o for o in others if o is not None], first)


def _take_staged(
    target: DataFrame, staged: DataFrame, keys: Sequence[str], null_safe: bool, many: bool = False
) -> DataFrame:
    hit, prefix = free_name("_hit", target), free_name("_staged_", target)
    side = staged.select(
        *[column(c).alias(prefix + c) for c in target.columns], F.lit(True).alias(hit)
    )
    joined = _hash_join(target, side, keys, "left", null_safe, prefix=prefix, many=many)
    return joined.select(
        *[
            F.when(column(hit), column(prefix + c)).otherwise(column(c)).alias(c)
            for c in target.columns
        ]
    )


def _hash_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool,
    prefix: str | None = None,
    many: bool = False,
) -> DataFrame:
    """Join on the keys and, ahead of them, on their hash.

    The hash makes Spark shuffle the right side for this join even if it is already
    partitioned by the keys: both inputs are then plain sorted exchanges, which adaptive
    execution needs to split skewed partitions. It also makes the sort cheap. Keys of different
    types are hashed in the type Spark compares them in. Text under a collation, where equal
    values can have different hashes, is joined by the keys alone.
    """
    if prefix is None:
        prefix = free_name("_staged_", left)
        right = right.select(*[column(c).alias(prefix + c) for c in right.columns])
    types = [_compared_in(left, k, right, prefix + k) for k in keys]
    hashes = []
    condition = F.lit(True)
    if all(map(_hash_follows_equality, types)):
        hashes = [free_name("_left_key_hash", left, right), free_name("_right_key_hash", left, right)]
        names = (keys, [prefix + k for k in keys])
        left, right = (
            frame.withColumn(h, F.xxhash64(*[column(n).cast(t) for n, t in zip(listed, types)]))
            for frame, h, listed in zip((left, right), hashes, names)
        )
        condition = column(hashes[0]) == column(hashes[1])
    for k in keys:
        same = left[f"`{k}`"].eqNullSafe(right[f"`{prefix}{k}`"]) if null_safe else (
            left[f"`{k}`"] == right[f"`{prefix}{k}`"]
        )
        condition = condition & same
    return left.join(_shuffled(right, many), condition, how).drop(*hashes)


def _compared_in(left: DataFrame, lname: str, right: DataFrame, rname: str) -> DataType:
    """The common type of two columns, as Spark finds it; no job runs."""
    kinds = [left.select(column(lname)).schema[0].dataType, right.select(column(rname)).schema[0].dataType]
    if kinds[0] == kinds[1]:
        return kinds[0]
    both = F.coalesce(*[F.lit(None).cast(kind) for kind in kinds])
    return left.sparkSession.range(0).select(both.alias("k")).schema[0].dataType


def compared_by_hash(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys always have equal hashes, which text under a collation need not have."""
    return all(_hash_follows_equality(df.select(column(k)).schema[0].dataType) for k in keys)


def _hash_follows_equality(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _hash_follows_equality(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hash_follows_equality(field.dataType) for field in kind.fields)
    return not isinstance(kind, StringType) or kind.collation == "UTF8_BINARY"
