"""Sinks.

The file sinks replace their folder the way Spark does: old files go when the write starts. Tables
that readers depend on, the stage among them, are published as versions instead.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.reshape import column


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, without an index. Lists need `sanitize` or `cast_strings` first.

    Spaces and tabs at the ends of a value stay.
    """
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', **kept).csv(path)


def write_text(df: DataFrame, value: str, path: str) -> None:
    """One text column to files."""
    df.select(column(value).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_text_by(df: DataFrame, value: str, by: Sequence[str], path: str) -> None:
    """One text column to a folder per ``by`` value, ``path/name=value``; a large one is spread."""
    (
        df.select(column(value).cast("string").alias("value"), *map(column, by))
        .hint("rebalance", *by)
        .write.mode("overwrite")
        .partitionBy(*by)
        .text(path)
    )


def replace_stage(df: DataFrame, table: str, folder: str | None = None) -> None:
    """Replace a staging table: published like any table, without keeping the version before.

    Overwriting a table in place would drop it first, and a failed write would leave nothing.
    """
    publish(df, table, keep=1, folder=folder)


def replace_stage_if_any(df: DataFrame, table: str, folder: str | None = None) -> bool:
    """Replace the staging table only if there is a row; else leave it untouched."""
    if df.isEmpty():
        return False
    replace_stage(df, table, folder)
    return True


def replace_stage_if(df: DataFrame, table: str, wanted: Callable[[], bool], folder: str | None = None) -> bool:
    """Replace the staging table if ``wanted``, asked once all rows are written, says so; else leave it untouched.

    With an observation of ``df`` behind ``wanted`` the rows are computed once, not once more to look for one.
    """
    version = write_version(df, table, folder)
    if not wanted():
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {version}")
        return False
    publish_version(df.sparkSession, table, version, df.columns, keep=1)
    return True


class Conflict(RuntimeError):
    """Another writer has published since the version that a new one was made from."""


#: For `publish`: the new version replaces whatever is current.
ANY = object()
#: Table properties that every version takes over from the one before.
KEPT = "millrace."


def publish(
    df: DataFrame,
    name: str,
    keep: int = 2,
    folder: str | None = None,
    base: object = ANY,
    properties: Mapping[str, str] | None = None,
) -> str:
    """Make ``df`` the next version of ``name`` and return the table that holds it.

    Every version is a table of its own; readers use the view ``name``, which is pointed to the
    new table after it is complete. ``df`` may read the view. A failed write leaves the view as it
    was. The last ``keep`` versions stay, for readers that still use them. With ``folder`` the
    versions are tables over sub-folders of it, whose files stay when a version is dropped.

    ``base`` is the version that ``df`` was made from, as `current` gave it (None: there was none). If another
    is current when the new one is complete, `Conflict` is raised and the new one is dropped: start again from
    `current`. ``properties`` become properties of the table, and stay with later versions where their names
    begin with ``KEPT``.
    """
    table = write_version(df, name, folder)
    publish_version(df.sparkSession, name, table, df.columns, keep, base, properties)
    return table


def write_version(df: DataFrame, name: str, folder: str | None = None) -> str:
    """Write ``df`` as a version of ``name`` that readers do not see yet."""
    table = new_version(df.sparkSession, name)
    writer = df.write.mode("errorifexists").format("parquet")
    if folder is not None:
        writer = writer.option("path", f"{folder}/{table}")
    writer.saveAsTable(table)
    return table


def publish_version(
    spark: SparkSession,
    name: str,
    table: str,
    columns: Sequence[str],
    keep: int = 2,
    base: object = ANY,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Let readers see a written version, and drop those from before the last ``keep``."""
    swap(spark, name, table, columns, base, properties)
    for old in old_versions(spark, name, table, keep):
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def current(spark: SparkSession, name: str) -> str | None:
    """The version that ``name`` is now; None if nothing was published under it."""
    if not spark.catalog.tableExists(name):
        return None
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    found = re.search(r" FROM (\S+__v\d+_[0-9a-f]{8})$", rows.get("View Text") or "")
    if not found:
        raise ValueError(f"{name} is not a published table")
    return found.group(1)


def properties_of(spark: SparkSession, table: str | None) -> dict[str, str]:
    """The properties of a version that later ones take over."""
    if table is None:
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if r["key"].startswith(KEPT)}


def new_version(spark: SparkSession, name: str) -> str:
    """A free table name for the next version."""
    return f"{name}__v{max(versions(spark, name).values(), default=0) + 1}_{uuid.uuid4().hex[:8]}"


def swap(
    spark: SparkSession,
    name: str,
    table: str,
    columns: Sequence[str],
    base: object = ANY,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Point ``name`` to ``table``, a complete version, unless another than ``base`` is current."""
    now = current(spark, name)
    if base is not ANY and now != base:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise Conflict(f"{name} is {now} and no longer {base}")
    given = {**properties_of(spark, now), **(properties or {})}
    if given:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in given.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    names = ", ".join("`" + c.replace("`", "``") + "`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {names} FROM {table}")


def old_versions(spark: SparkSession, name: str, table: str, keep: int) -> list[str]:
    """All but the last ``keep`` versions up to ``table``."""
    last = int(re.search(r"__v(\d+)_[0-9a-f]{8}$", table).group(1))
    return [t for t, number in versions(spark, name).items() if number <= last - keep]


def versions(spark: SparkSession, name: str) -> dict[str, int]:
    """Version tables of ``name`` with their numbers."""
    *database, short = name.split(".")
    scope = f" IN {'.'.join(database)}" if database else ""
    pattern = re.compile(re.escape(short) + r"__v(\d+)_[0-9a-f]{8}", re.IGNORECASE)
    rows = spark.sql(f"SHOW TABLES{scope} LIKE '{short}__v*'").collect()
    return {
        ".".join([*database, row.tableName]): int(m.group(1))
        for row in rows
        if (m := pattern.fullmatch(row.tableName))
    }


def overwrite_partitions(df: DataFrame, path: str, names: Sequence[str]) -> None:
    """Replace just the partitions that ``df`` has rows for; a large one is spread over tasks."""
    (
        df.hint("rebalance", *names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*names)
        .parquet(path)
    )
