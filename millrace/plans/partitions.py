"""Upsert into a partitioned folder, rewriting only the partitions a batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from millrace.operators.keyed import keep_one, replace_by_key, upsert
from millrace.operators.reshape import align, column
from millrace.sources.sinks import overwrite_partitions

#: Most partitions of a batch whose values go to every task to prune the scan.
BROADCAST_PARTITIONS = 100_000


def upsert_partitions(
    spark: SparkSession,
    path: str,
    staging: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str],
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
) -> None:
    """Keyed upsert where the partition columns are part of the key.

    A staged row can then only meet target rows of its own partition, so the scan, the join
    and the write are cut to the partitions the batch has: a semi join on the partition columns,
    which prunes directories where the batch's distinct values are few enough to broadcast.
    Files of those partitions are replaced when the job commits, each partition by itself: a reader
    may see some of them new and some old. A path that is not there yet is created.

    The target keeps its columns: those the batch lacks are kept where no row is staged and are NULL in
    staged rows, those only the batch has are added. Empty text in a partition column is NULL, as a
    directory name cannot tell the two apart. ``unique_target`` states that the folder has one row per key.
    """
    if not set(partitions) <= set(keys):
        raise ValueError("partition columns must be key columns")
    for field in staging.schema.fields:
        if field.name in partitions and isinstance(field.dataType, StringType):
            staging = staging.withColumn(field.name, F.nullif(column(field.name), F.lit("")))
    if staging.isEmpty():
        return
    try:
        have = spark.read.parquet(path).schema
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        overwrite_partitions(keep_one(staging, keys, tiebreak), path, partitions)
        return
    target = spark.read.schema(_merged(have, staging.schema, partitions)).parquet(path)
    merge = replace_by_key if unique_target else upsert
    touched = _touched(target, staging, partitions)
    merged = merge(touched, align(staging, target.schema), keys, tiebreak, null_safe)
    overwrite_partitions(merged, path, partitions)


def _merged(have: StructType, batch: StructType, partitions: Sequence[str]) -> StructType:
    """The target's columns, then those only the batch has. Partition columns have the batch's types,
    as those of directory names are a guess."""
    given = {f.name.lower(): f for f in batch.fields}
    by_batch = {name.lower() for name in partitions}
    fields = [given[f.name.lower()] if f.name.lower() in by_batch else f for f in have.fields]
    known = {f.name.lower() for f in have.fields}
    return StructType([*fields, *[f for f in batch.fields if f.name.lower() not in known]])


def _touched(target: DataFrame, staging: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in partitions that ``staging`` has; NULL is a partition too."""
    values = staging.select(*map(column, partitions)).distinct()
    if values.limit(BROADCAST_PARTITIONS + 1).count() <= BROADCAST_PARTITIONS:
        values = F.broadcast(values)
    values = values.select(*[_directory(name).alias(f"_touched{i}") for i, name in enumerate(partitions)])
    same = F.lit(True)
    for i, name in enumerate(partitions):
        same = same & (_directory(name) == column(f"_touched{i}"))
    return target.join(values, same, "left_semi")


def _directory(name: str) -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))
