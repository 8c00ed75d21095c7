"""Incremental form of the batch load: each run takes the files that landed since the last one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.keyed import keep_one, replace_by_key, upsert
from millrace.plans.buckets import upsert_buckets
from millrace.plans.partitions import upsert_partitions
from millrace.plans.steps import Step, run_steps
from millrace.sources.files import file_listing, url_path
from millrace.sources.sinks import KEPT, current, properties_of, publish


def landed_files(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    form: str = "csv",
    after: str = "off",
    archive: str | None = None,
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream over files in ``folder``.

    ``after`` says what becomes of a file once its batch is done: ``off`` leaves it, ``archive``
    moves it below ``archive``, ``delete`` removes it. Either happens one batch later; the loads'
    ``consumed`` does it in the same run.
    """
    settings = {"cleanSource": after, "pathGlobFilter": f"*.{form}", **options}
    if after == "archive":
        if archive is None:
            raise ValueError("after='archive' needs an archive folder")
        settings["sourceArchiveDir"] = archive
    if files_per_batch is not None:
        settings["maxFilesPerTrigger"] = str(files_per_batch)
    if form == "csv":
        settings = {"header": "true", "quote": '"', "escape": '"', **settings}
    return spark.readStream.schema(schema).format(form).options(**settings).load(folder)


def upsert_landed(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    steps: Sequence[Step] = (),
    folder: str | None = None,
    consumed: Consumed | None = None,
) -> None:
    """Upsert all files that are there now into ``table``, then stop.

    The checkpoint remembers consumed files. The published version remembers the last batch of each stream
    that went into it, so a batch that is run again after a failure is left out if it was published: also rows
    with a NULL key are inserted once. Where batches disagree, the last one wins. ``unique_target`` states that
    the table has one row per key, which holds if only these runs write it. Another writer's version in between
    raises `sinks.Conflict`; the next run takes the batch again. ``consumed`` clears the landing folder when done.
    """

    def load(rows: DataFrame, batch: Batch) -> None:
        spark = rows.sparkSession
        base = current(spark, table)
        if batch.published(spark, base):
            return
        if base is not None:
            merge = replace_by_key if unique_target else upsert
            merged = merge(spark.table(base), rows, keys, tiebreak, null_safe)
        else:
            merged = keep_one(rows, keys, tiebreak)
        publish(merged, table, folder=folder, base=base, properties=batch.properties())

    _run_available(stream, load, checkpoint, steps, consumed)


def upsert_landed_buckets(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    folder: str,
    checkpoint: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    buckets: int = 256,
    steps: Sequence[Step] = (),
    consumed: Consumed | None = None,
) -> None:
    """As `upsert_landed`, into a table of `buckets.upsert_buckets`: a batch rewrites the buckets it has rows for."""

    def load(rows: DataFrame, batch: Batch) -> None:
        if not batch.published(rows.sparkSession, current(rows.sparkSession, table)):
            upsert_buckets(
                rows, table, keys, folder, tiebreak, null_safe, unique_target, buckets, properties=batch.properties()
            )

    _run_available(stream, load, checkpoint, steps, consumed)


def upsert_landed_partitions(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    partitions: Sequence[str],
    checkpoint: str,
    tiebreak: Sequence[Column] = (),
    null_safe: bool = False,
    unique_target: bool = False,
    steps: Sequence[Step] = (),
    consumed: Consumed | None = None,
) -> None:
    """As `upsert_landed`, into a folder partitioned by key columns.

    A batch rewrites the partitions it has rows for, not the whole table: the form for small
    batches and a large target. Partitions are replaced one by one and remember no batch, so one that is run
    again inserts rows with a NULL key once more, unless ``null_safe``.
    """

    def load(rows: DataFrame, _batch: Batch) -> None:
        upsert_partitions(
            rows.sparkSession, path, rows, keys, partitions, tiebreak, null_safe, unique_target
        )

    _run_available(stream, load, checkpoint, steps, consumed)


@dataclass(frozen=True)
class Consumed:
    """What becomes of the files in ``folder`` that a run has loaded: ``after`` is ``archive`` (moved into the
    folder ``archive``) or ``delete``. ``glob``: the stream's files."""

    folder: str
    after: str = "archive"
    archive: str | None = None
    glob: str = "*.csv"

    def __post_init__(self) -> None:
        if self.after not in ("archive", "delete"):
            raise ValueError(f"after={self.after!r} is neither 'archive' nor 'delete'")
        if self.after == "archive" and self.archive is None:
            raise ValueError("after='archive' needs an archive folder")


def consumed_files(spark: SparkSession, checkpoint: str, consumed: Consumed) -> DataFrame:
    """``path`` and ``timestamp`` of the files still in the folder that batches of ``checkpoint`` have committed.

    The checkpoint notes the path and the time of each file of a batch before the batch runs. A file that has
    landed since under the name of one loaded before has another time and is not among them.
    """
    noted = spark.read.text(f"{checkpoint}/sources/0").select(
        F.from_json("value", "path string, timestamp bigint, batchId bigint").alias("file")
    )
    done = file_listing(spark, f"{checkpoint}/commits").agg(
        F.max(F.regexp_extract("path", "/([0-9]+)$", 1).try_cast("bigint")).alias("last")
    )
    # A scheme without a host is written in two ways.
    path = F.regexp_replace(url_path("file.path"), "^([^:/]+):///", "$1:/")
    loaded = noted.select(path.alias("path"), "file.timestamp", "file.batchId")
    loaded = loaded.join(done, F.col("batchId") <= F.col("last")).select("path", "timestamp").distinct()
    there = file_listing(spark, consumed.folder, consumed.glob).select(
        "path", F.unix_millis("modificationTime").alias("timestamp")
    )
    return there.join(loaded, ["path", "timestamp"], "left_semi")


def clear_consumed(spark: SparkSession, checkpoint: str, consumed: Consumed) -> int:
    """Moves or deletes `consumed_files`, and says how many.

    Paths are found by a join and pass the driver one partition at a time; each takes one call of the file
    system and no data moves. A run that was stopped in between is made up by the next one. A name that the
    archive has already gets the file's time before it.
    """
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    if consumed.after == "archive":
        target = path_of(consumed.archive)
        target.getFileSystem(conf).mkdirs(target)
    n = 0
    for row in consumed_files(spark, checkpoint, consumed).toLocalIterator():
        source = path_of(row["path"])
        system = source.getFileSystem(conf)
        if consumed.after == "delete":
            done = system.delete(source, False)
        else:
            moved = path_of(consumed.archive, source.getName())
            if system.exists(moved):
                moved = path_of(consumed.archive, f"{row['timestamp']}-{source.getName()}")
            done = system.rename(source, moved)
        if not done:
            raise OSError(f"could not {consumed.after} {row['path']}")
        n += 1
    return n


@dataclass(frozen=True)
class Batch:
    """A batch of a stream; both are the same when it is run again from its checkpoint."""

    stream: str
    number: int

    def _property(self) -> str:
        return f"{KEPT}batch.{self.stream}"

    def properties(self) -> dict[str, str]:
        """What a version says that has this batch in it."""
        return {self._property(): str(self.number)}

    def published(self, spark: SparkSession, version: str | None) -> bool:
        """Whether ``version`` has this batch, or a later one of its stream, in it."""
        last = properties_of(spark, version).get(self._property())
        return last is not None and int(last) >= self.number


def _run_available(
    stream: DataFrame,
    load: Callable[[DataFrame, Batch], None],
    checkpoint: str,
    steps: Sequence[Step],
    consumed: Consumed | None = None,
) -> None:
    def take(batch: DataFrame, batch_id: int) -> None:
        # The id that the checkpoint holds, not that of the run.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = run_steps(batch, *steps).persist()  # read several times by a load
        try:
            if not rows.isEmpty():
                load(rows, Batch(query, batch_id))
        finally:
            rows.unpersist()

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if consumed is not None:
        clear_consumed(stream.sparkSession, checkpoint, consumed)
