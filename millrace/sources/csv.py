"""CSV files with a header, alone or as a folder of mixed headers."""

from __future__ import annotations

import re
from csv import reader

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import MISSING_TOKENS, null_tokens
from millrace.operators.reshape import all_strings, column, union_by_name
from millrace.sources.files import file_path

_GLOB_SIGNS = r"[\[\]{}*?\\]"
_QUOTING = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header; ``""`` is a quote inside quotes.

    Types are inferred unless a schema is given or ``infer`` is off (all text); inference reads
    the input once more. With ``multi_line`` a value may hold line breaks, at the price of one
    task per file; switch it off to split large files.
    """
    scan = spark.read.options(**_QUOTING).option("multiLine", multi_line)
    if schema is not None:
        return scan.schema(schema).csv(path)
    return scan.option("inferSchema", infer).csv(path)


def scan_csv_folder(
    spark: SparkSession,
    folder: str,
    glob: str = "*.csv",
    tokens: tuple[str, ...] = MISSING_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """All CSV files directly in ``folder`` as one text table, columns matched by name.

    Files are read in one scan per distinct header and combined by name, so a file with other
    or reordered columns keeps its values under the right names. Missing-value texts are NULL.
    """
    parts = []
    for header, paths in _files_by_header(spark, folder, glob).items():
        names = [name or f"_c{i}" for i, name in enumerate(next(reader([header])))]
        if len({name.lower() for name in names}) < len(names):
            raise ValueError(f"a header names a column twice: {header}")
        part = scan_csv(spark, paths, schema=all_strings(names), multi_line=multi_line)
        parts.append(part.select(*[null_tokens(column(c), tokens).alias(c) for c in names]))
    if not parts:
        return spark.createDataFrame([], StructType())
    return union_by_name(*parts)


def _files_by_header(spark: SparkSession, folder: str, glob: str) -> dict[str, list[str]]:
    """Paths per header line, headers in order.

    The first line of a file is the first row of its first block. Each task keeps one line per
    file; only headers and paths, which a scan needs on the driver anyway, get there.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .text(folder)
        .select(
            file_path(),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("nth"),
            "value",
        )
        .where("start = 0")
    )
    first = lines.groupBy("path").agg(F.min_by("value", "nth").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("header", "path").toLocalIterator():
        header = row.header.removeprefix("\ufeff")
        found.setdefault(header, []).append(re.sub(_GLOB_SIGNS, r"\\\g<0>", row.path))
    return found
