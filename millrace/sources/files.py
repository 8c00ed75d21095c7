"""File listings and whole-file text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_listing(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files directly in ``folder``: path, modification time, length. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "modificationTime", "length")
    )


def file_path() -> Column:
    """Path of the file a scanned row comes from, as the file system spells it."""
    return url_path("_metadata.file_path").alias("path")


def url_path(name: str) -> Column:
    """A column's paths with their escapes decoded."""
    return F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B")))


def source_files(spark: SparkSession, folder: str, glob: str = "*.py") -> DataFrame:
    """Whole files as rows ``(path, source)``."""
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(folder, wholetext=True)
        .select(file_path(), F.col("value").alias("source"))
    )
