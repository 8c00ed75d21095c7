"""Upsert into a large table without partitions of its own: only the buckets a batch touches are rewritten.

A row's bucket is a hash of its key, so a staged row can meet target rows of its own bucket only. A version is a
table whose partitions are the buckets, each with a folder of its own; the next version takes over the folders
of untouched buckets as they are, and has new ones for the others. Publishing swaps a view as in `sinks.publish`,
so readers see all of a batch or nothing, and versions before stay readable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from millrace.operators.keyed import compared_by_hash, keep_one, replace_by_key, upsert
from millrace.operators.reshape import align, column
from millrace.sources.sinks import Conflict, current, new_version, old_versions, properties_of, swap, versions

BUCKET = "_bucket"
COUNT, SAFE = "millrace.buckets", "millrace.null_safe"
#: The folders of a version's buckets, in a table next to its own.
LISTED, PLACES = "__buckets", "bucket int, place string"


def create_buckets(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    folder: str,
    null_safe: bool = False,
    buckets: int = 256,
    keep: int = 2,
    properties: Mapping[str, str] | None = None,
) -> str:
    """Publishes the rows of ``df`` as they are, as a table for `upsert_buckets`; returns the version.

    A bucket of some hundred MB is rewritten in few tasks, and there should be more buckets than a batch has use
    for. Their number and ``null_safe`` stay with the table. Files are below ``folder``.
    """
    if BUCKET in df.columns:
        raise ValueError(f"{BUCKET} is a column of the table's own")
    base = current(df.sparkSession, name)
    given = {**(properties or {}), COUNT: str(buckets), SAFE: str(null_safe)}
    placed = df.withColumn(BUCKET, _bucket(df, keys, buckets, null_safe, buckets))
    return _publish(placed, name, folder, {}, base, keep, given)


def upsert_buckets(
    staging: DataFrame,
    name: str,
    keys: Sequence[str],
    folder: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    buckets: int = 256,
    keep: int = 2,
    properties: Mapping[str, str] | None = None,
) -> str | None:
    """Publishes the keyed upsert of ``staging`` into ``name`` and returns the new version; None without rows.

    The first batch creates the table, if `create_buckets` has not. The target keeps its columns, as in `upsert`;
    those the batch lacks are NULL in staged rows. Rows with a NULL in the key match nothing unless ``null_safe``:
    each version has them in a partition of its own, beyond the buckets, which no later one reads or writes.
    ``unique_target`` states that the table has one row per key. Folders of dropped versions that no kept one uses
    are deleted. Raises `sinks.Conflict` if another writer has published in between; nothing is changed then.
    """
    spark = staging.sparkSession
    if staging.isEmpty():
        return None
    base = current(spark, name)
    if base is None:
        first = keep_one(staging, keys, tiebreak)
        return create_buckets(first, name, keys, folder, null_safe, buckets, keep, properties)
    target, known = spark.table(base), properties_of(spark, base)
    if known[SAFE] != str(null_safe):
        raise ValueError(f"the table was made with null_safe={known[SAFE]}")
    staging = align(staging, StructType([f for f in target.schema.fields if f.name != BUCKET]))
    places = _places(spark, base)
    count = int(known[COUNT])
    apart = max([count - 1, *places]) + 1
    staged = staging.withColumn(BUCKET, _bucket(staging, keys, count, null_safe, apart))
    # At most one value for each bucket and one more.
    touched = sorted(r[0] for r in staged.select(BUCKET).distinct().collect())
    merge = replace_by_key if unique_target else upsert
    merged = merge(target.where(F.col(BUCKET).isin(touched)), staged, [*keys, BUCKET], tiebreak, null_safe)
    return _publish(merged, name, folder, places, base, keep, properties)


def _bucket(df: DataFrame, keys: Sequence[str], buckets: int, null_safe: bool, apart: int) -> Column:
    """Each row's bucket; ``apart`` for a row that matches nothing."""
    if not compared_by_hash(df, keys):
        raise ValueError("keys under a collation, where equal values have different hashes, have no bucket")
    number = F.pmod(F.xxhash64(*map(column, keys)), F.lit(buckets)).cast("int")
    keyless = reduce(Column.__or__, [column(k).isNull() for k in keys])
    return number if null_safe else F.when(keyless, F.lit(apart)).otherwise(number)


def _publish(
    merged: DataFrame,
    name: str,
    folder: str,
    places: Mapping[int, str],
    base: str | None,
    keep: int,
    properties: Mapping[str, str] | None,
) -> str:
    """Writes the buckets of ``merged`` and makes them, with the others of ``places``, the next version."""
    spark = merged.sparkSession
    table = new_version(spark, name)
    path = f"{folder.rstrip('/')}/{table}"
    merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    places = {**places, **{number: f"{path}/{BUCKET}={number}" for number in _written(spark, path)}}
    columns = [c for c in merged.columns if c != BUCKET]
    fields = StructType([*merged.select(*map(column, columns)).schema.fields, StructField(BUCKET, IntegerType())])
    spark.createDataFrame(sorted(places.items()), PLACES).coalesce(1).write.parquet(f"{path}{LISTED}")
    spark.sql(f"CREATE TABLE {table} ({fields.toDDL()}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{path}'")
    if places:
        added = " ".join(f"PARTITION ({BUCKET} = {b}) LOCATION '{place}'" for b, place in places.items())
        spark.sql(f"ALTER TABLE {table} ADD {added}")
    try:
        swap(spark, name, table, columns, base, properties)
    except Conflict:
        _delete(spark, {path, f"{path}{LISTED}"})
        raise
    _drop(spark, name, old_versions(spark, name, table, keep))
    return table


def _drop(spark: SparkSession, name: str, old: Sequence[str]) -> None:
    """Drops versions, and deletes the folders that only they have used."""
    if not old:
        return
    used = {t: set(_places(spark, t).values()) for t in versions(spark, name)}
    kept = set().union(*[used[t] for t in used if t not in old])
    lists = {f"{_location(spark, t)}{LISTED}" for t in old}
    for table in old:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    _delete(spark, set().union(lists, *[used[t] for t in old]) - kept)


def _written(spark: SparkSession, path: str) -> list[int]:
    """The buckets that a folder has: at most one entry for each."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return [int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}=")]


def _delete(spark: SparkSession, paths: set[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def _places(spark: SparkSession, table: str) -> dict[int, str]:
    return dict(spark.read.schema(PLACES).parquet(f"{_location(spark, table)}{LISTED}").collect())
