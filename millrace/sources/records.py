"""Nested JSON records, of a declared or a discovered schema, and the gate that keeps unreadable ones out of the stage."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, StringType, StructType

from millrace.operators.reshape import column
from millrace.sources.files import file_path

CORRUPT = "_corrupt_record"


def scan_json(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> DataFrame:
    """Objects, or lists of objects, as rows of the declared schema.

    ``multi_line`` reads files that are one JSON document each; such a file is read by one
    task. Land large inputs as JSON lines.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def scan_json_gated(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Good records, and the records that do not fit the schema with their raw text and file.

    The quarantined rows keep what could be read of them next to the text.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    gated = StructType([*schema.fields]).add(CORRUPT, "string")
    rows = (
        spark.read.schema(gated)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .json(path)
    )
    read = _always_read(schema)
    good = rows.where(F.col(CORRUPT).isNull() & read).drop(CORRUPT)
    bad = rows.where(F.col(CORRUPT).isNotNull() & read).select(
        file_path(),
        F.col(CORRUPT).alias("raw"),
        F.to_json(F.struct(*[column(f.name) for f in schema.fields])).alias("salvaged"),
    )
    return good, bad


def _always_read(schema: StructType) -> Column:
    """True for every row, and keeps one data column in the scan.

    Spark refuses a scan that is cut down to the corrupt-record column, as a mere count of the
    good or the bad rows would do.
    """
    simple = [f for f in schema.fields if isinstance(f.dataType, AtomicType)]
    return F.xxhash64(column((simple or schema.fields)[0].name)) >= F.lit(-(2**63))


def scan_records_gated(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """As `scan_json_gated`, but each record of a list is judged by itself.

    A document (a line, or a whole file with ``multi_line``) is first cut into the texts of its records, then each
    text is read alone, so a list with some records that do not fit loses only those. Bad rows have their file,
    ``pos``, the place in the list from 0 (NULL if the document is no list), ``raw``, the record's text without
    blanks between its parts, and what could be read of it. A record that is no object is bad; one that is a
    text is read as what the text holds. A document that is no JSON is one bad row. Blank documents are none.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    gated = StructType([*schema.fields]).add(CORRUPT, "string")
    listed = _documents(spark, path, multi_line).select(
        file_path(), "value", F.from_json("value", ArrayType(StringType())).alias("texts")
    )
    single = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.col("value").alias("raw")))
    several = F.transform("texts", lambda raw, i: F.struct(i.alias("pos"), F.coalesce(raw, F.lit("null")).alias("raw")))
    rows = listed.select("path", F.explode(F.coalesce(several, single)).alias("record")).select("path", "record.*")
    read = rows.withColumn("read", F.from_json("raw", gated, {"columnNameOfCorruptRecord": CORRUPT}))
    is_object = F.startswith(F.ltrim("raw"), F.lit("{"))
    fits = F.coalesce(is_object & F.col("read").isNotNull() & F.col("read")[CORRUPT].isNull(), F.lit(False))
    fields = [F.col("read")[f.name].alias(f.name) for f in schema.fields]
    salvaged = F.when(is_object, F.to_json(F.struct(*fields))).alias("salvaged")
    return read.where(fits).select(*fields), read.where(~fits).select("path", "pos", "raw", salvaged)


def _documents(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """The texts of lines, or of whole files, in ``value``; blank ones are left out."""
    return spark.read.text(path, wholetext=multi_line).where(F.length(F.trim(F.translate("value", "\r\n\t", "   "))) > 0)


@dataclass(frozen=True)
class Discovered:
    """``schema``: of all records together. ``null_parents``: the paths of nested objects that are null, not
    just missing, in some record."""

    schema: StructType
    null_parents: frozenset[tuple[str, ...]]


def discover(spark: SparkSession, path: str, multi_line: bool = False, sample: float | None = None) -> Discovered:
    """Schema of the objects in JSON documents, or in lists of them, found by aggregating over all of them.

    Types are merged as they are counted, in every task, so only one schema reaches the driver. Whole numbers are
    ``bigint``, others ``double``; a field that is null everywhere, or holds kinds that do not go together, is
    text. Records that cannot be read add nothing. A second pass over the same documents looks for null parents.
    ``sample`` reads that share of the documents instead of all; fields of the others may then be missed.
    """
    documents = _documents(spark, path, multi_line)
    if sample is not None:
        documents = documents.sample(sample, seed=0)
    parsed = documents.select(F.try_parse_json("value").alias("v"))
    records = parsed.select(F.explode(F.expr("coalesce(try_variant_get(v, '$', 'array<variant>'), array(v))")).alias("v"))
    records = records.where(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT<")))
    text = records.agg(F.schema_of_variant_agg("v")).first()[0]
    if text is None or not text.startswith("OBJECT<"):
        return Discovered(StructType(), frozenset())
    schema = _declared(text)
    marks = {parent: F.is_variant_null(_inner(F.col("v"), parent)) for parent in _parents(schema)}
    if not marks:
        return Discovered(schema, frozenset())
    met = records.agg(*[F.coalesce(F.bool_or(mark), F.lit(False)) for mark in marks.values()]).first()
    return Discovered(schema, frozenset(parent for parent, is_null in zip(marks, met) if is_null))


_VARIANT_TYPE = re.compile(r"`(?:[^`]|``)*`|\b(?:VOID|VARIANT|DECIMAL\(\d+, *\d+\))(?!\w|:)|\bOBJECT(?=<)")


def _declared(found: str) -> StructType:
    """The schema that a text such as ``OBJECT<a: BIGINT, b: VOID>`` describes."""

    def one(token: re.Match) -> str:
        if token[0].startswith("`"):
            return token[0]
        if token[0] == "OBJECT":
            return "STRUCT"
        return "DOUBLE" if token[0].startswith("DECIMAL") else "STRING"

    return StructType.fromDDL(f"record {_VARIANT_TYPE.sub(one, found)}")[0].dataType


def _parents(schema: StructType, above: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for field in schema.fields:
        if isinstance(field.dataType, StructType):
            path = (*above, field.name)
            found += [path, *_parents(field.dataType, path)]
    return found


def _inner(value: Column, path: tuple[str, ...]) -> Column:
    """The variant at ``path``, read name by name: a path text could not hold every name."""
    for name in path:
        quoted = name.replace("`", "``")
        value = F.try_variant_get(value, "$", f"struct<`{quoted}`: variant>").getField(name)
    return value
