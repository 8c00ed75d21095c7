"""Merkle fixity audit of archived web records across replicas.

Records stand one after another in archive files, at offsets that the first replica's manifest fixes. A
replica's tree over a file has its records as leaves, each the hash of the record's bytes, and above them
nodes over ordered offset ranges: a node of level k covers ``leaf_bytes * fanout ** k`` bytes, and its hash
is taken over its children's in order of offset. The nodes of the top level, which one range covers, are
the file's root.

An audit compares roots, then only the children of nodes that differ, down to the records. The trees are
written by level, so a level is read for the mismatching branches alone.

Nulls in a record's fields are empty. Records that share an id are matched in order of their hash; those
without one by their hash, so a changed one is missing and extra. A record that a replica lacks is ``missing``, one beyond the manifest ``extra``, one with other bytes
``corrupt``. Empty tables have no nodes, and an audit of equal replicas no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import work_path


@dataclass(frozen=True)
class Tree:
    """``leaf_bytes``: bytes a node above the records covers; ``fanout``: nodes of a level below one node.
    ``levels``: levels above the records; the last covers a whole file, so files hold no more bytes than
    ``leaf_bytes * fanout ** (levels - 1)``. ``file_records``: records of one file."""

    leaf_bytes: int = 1 << 18
    fanout: int = 16
    levels: int = 6
    file_records: int = 2000


def warc_record(url: Column, body: Column) -> Column:
    """A response record with its header, as text."""
    body = F.coalesce(body, F.lit(""))
    lines = ["WARC/1.1", "WARC-Type: response", "WARC-Target-URI: %s", "Content-Type: text/html", "Content-Length: %s"]
    head = F.format_string("\r\n".join(lines) + "\r\n\r\n", F.coalesce(url, F.lit("")), F.octet_length(body))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def _numbered(records: DataFrame, how: Tree) -> DataFrame:
    """``file``, ``record_id``, ``nth`` (among records of one id, by hash), ``n_bytes`` and ``hash``.

    Records without an id are told apart by their hash, and dealt out by it to files of their own.
    """
    hashed = records.select(
        "record_id", F.octet_length("record").cast("bigint").alias("n_bytes"), F.sha2("record", 256).alias("hash")
    )
    no_id = F.col("record_id").isNull()
    own = F.floor(F.col("record_id") / F.lit(how.file_records)).cast("bigint")
    unnamed = -1 - F.pmod(F.xxhash64("hash"), F.lit(1 << 20)) - (1 << 60)
    nth = F.row_number().over(Window.partitionBy("record_id", "_anonymous").orderBy("hash"))
    return (
        hashed.withColumns({"file": F.when(no_id, unnamed).otherwise(own), "_anonymous": F.when(no_id, F.col("hash"))})
        .withColumn("nth", nth)
        .drop("_anonymous")
    )


def manifest(records: DataFrame, how: Tree = Tree()) -> DataFrame:
    """``file``, ``offset``, ``n_bytes``, ``record_id``, ``nth`` and ``hash`` of ``records`` (``record_id``,
    ``record``), in files of consecutive ids. Each file's few thousand rows are ordered by themselves."""
    numbered = _numbered(records, how)
    in_file = Window.partitionBy("file").orderBy("record_id", "hash", "nth")
    before = F.sum("n_bytes").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(before, F.lit(0)).cast("bigint")
    return numbered.select("file", offset.alias("offset"), "n_bytes", "record_id", "nth", "hash")


def write_tree(leaves: DataFrame, folder: str, how: Tree = Tree()) -> None:
    """Writes the levels of a tree over ``leaves`` (``file``, ``offset``, ``hash``): per level the nodes
    ``file``, ``node``, ``parent`` and ``hash``."""
    leaves.select(
        "file",
        F.col("offset").alias("node"),
        F.floor(F.col("offset") / F.lit(how.leaf_bytes)).alias("parent"),
        "hash",
    ).write.mode("overwrite").parquet(f"{folder}/level=0")
    for level in range(1, how.levels + 1):
        below = leaves.sparkSession.read.parquet(f"{folder}/level={level - 1}")
        ordered = F.transform(F.sort_array(F.collect_list(F.struct("node", "hash"))), lambda x: x["hash"])
        nodes = below.groupBy("file", F.col("parent").alias("node")).agg(F.sha2(F.array_join(ordered, ""), 256).alias("hash"))
        nodes.select("file", "node", F.floor(F.col("node") / F.lit(how.fanout)).alias("parent"), "hash").write.mode(
            "overwrite"
        ).parquet(f"{folder}/level={level}")


def audit(left: str, right: str, spark, how: Tree = Tree()) -> DataFrame:
    """``file``, ``offset`` and ``status`` of each record in which the trees in two folders differ."""
    branches = None
    for level in range(how.levels, -1, -1):
        sides = []
        for folder, name in ((left, "left_hash"), (right, "right_hash")):
            nodes = spark.read.parquet(f"{folder}/level={level}")
            if branches is not None:
                nodes = nodes.join(branches, ["file", "parent"], "left_semi")
            sides.append(nodes.select("file", "node", F.col("hash").alias(name)))
        differ = sides[0].join(sides[1], ["file", "node"], "full_outer").where("not (left_hash <=> right_hash)")
        if level:
            branches = differ.select("file", F.col("node").alias("parent")).checkpoint()
    status = F.when(F.col("right_hash").isNull(), "missing").when(F.col("left_hash").isNull(), "extra").otherwise("corrupt")
    return differ.select("file", F.col("node").alias("offset"), status.alias("status"))


def replica_leaves(records: DataFrame, listed: DataFrame, how: Tree = Tree()) -> DataFrame:
    """The leaves of a replica: each record it holds, at the place ``listed`` (the manifest) gives it; one
    that has none there at a place below 0."""
    held = _numbered(records, how).withColumn("_anonymous", F.when(F.col("record_id").isNull(), F.col("hash")))
    places = listed.select(
        F.col("record_id").alias("_id"),
        F.col("nth").alias("_nth"),
        F.col("file").alias("_file"),
        "offset",
        F.when(F.col("record_id").isNull(), F.col("hash")).alias("_hash"),
    )
    same = (
        F.col("record_id").eqNullSafe(F.col("_id"))
        & (F.col("nth") == F.col("_nth"))
        & F.col("_anonymous").eqNullSafe(F.col("_hash"))
    )
    unlisted = -1 - F.pmod(F.xxhash64("record_id", "nth", "hash"), F.lit(1 << 60))
    return held.join(places, same, "left").select(
        F.coalesce("_file", "file").alias("file"), F.coalesce("offset", unlisted).alias("offset"), "hash"
    )


def audited(original: DataFrame, replica: DataFrame, how: Tree = Tree()) -> DataFrame:
    """``record_id``, ``file``, ``offset``, ``n_bytes`` and ``status`` of each record (``record_id``,
    ``record``) in which ``replica`` differs from ``original``."""
    spark = original.sparkSession
    folder = work_path(spark, "fixity")
    manifest(original, how).write.parquet(f"{folder}/manifest")
    listed = spark.read.parquet(f"{folder}/manifest")
    write_tree(listed, f"{folder}/original", how)
    write_tree(replica_leaves(replica, listed, how), f"{folder}/replica", how)
    found = audit(f"{folder}/original", f"{folder}/replica", spark, how)
    return found.join(listed.drop("hash"), ["file", "offset"], "left").select(
        "record_id", "file", "offset", "n_bytes", "status"
    )
