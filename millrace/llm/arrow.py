"""Arrow batches in and out of Python tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import SparkSession

TYPES = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<struct<start:int,end:int,lang:string>>": pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
    ),
}


def batch_of(rows: Sequence[Sequence], schema: str) -> pa.RecordBatch:
    """Rows as one batch of ``schema``, given as ``name type, name type``; nulls stay nulls."""
    fields = [part.split(" ", 1) for part in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    arrays = [pa.array(values, TYPES[kind]) for values, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


@contextmanager
def batches_of(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Jobs that run meanwhile send Python tasks batches that close once they hold ``most_bytes``."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
