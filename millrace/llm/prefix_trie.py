"""The trie of conversation prefixes, by truncation peeling.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. Peeling
goes from the deepest turns up: conversations that end at a depth join the nodes that survive from below,
equal ones merge, what they hold is added up, and the survivors lose their last turn and are grouped anew by
what is left. Nodes are found and their subtrees summed on the same way.

A round takes a block of depths, four times as wide as the one above it, so rounds grow as the logarithm of
the longest conversation. Within a block the members of a node are the survivors and the conversations that
end there. Each stands for all it has merged and needs the turns of its smallest conversation only; turns of the
others in the block are not read again. Sums over the part of a subtree in the block come from lengths added
up along each conversation: a turn belongs to the node's smallest member, so what a member owns is the end of
its turns from some depth on, and differences of two running sums say how long that is.

A prefix is known by a 128-bit sum of hashes of its turns and their places. Running sums are made over rows in
ranges, not conversation by conversation, and ids that end at a node are hashed in pieces of such ranges: one
conversation, first turn or group of copies may hold any share of the rows. Every round is written below the
shared folder.

A null ``role`` or ``text`` is empty. Rows without a ``conv_id`` are left out. Turns are in ascending order,
nulls first; rows that share a turn follow the hash of role and text; repeated rows are a turn each. Other
columns are not read. Without conversations there are no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package
from millrace.session import work_path

#: A block begins at the power of 4 of its number.
WIDER = 4
#: Ids in one piece of a node's list.
PIECE = 50_000
NODE = ["depth", "p1", "p2"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` (from 1), two hashes ``key1`` and ``key2`` of role and text, and ``chars`` of the text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"),
        "turn",
        F.xxhash64(role, text).alias("key1"),
        F.xxhash64(F.lit(1), role, text).alias("key2"),
        F.length(text).cast("bigint").alias("chars"),
        # Of the scan, so a task that runs again gives the same; it tells equal rows apart.
        F.monotonically_increasing_id().alias("number"),
    )
    order = [F.col("turn").asc_nulls_first(), "key1", "key2", "number"]
    ranked = running(turns.withColumn("one", F.lit(1)), order, {"place": ("sum", "one")}, "trie-turns")
    return ranked.select("conv_id", "place", "key1", "key2", "chars")


def running(rows: DataFrame, order: list, sums: dict[str, tuple[str, str]], name: str) -> DataFrame:
    """``rows`` with running sums along each ``conv_id``: ``sums`` has, for each new column, ``sum`` or ``xor`` and
    the column to add up.

    Rows are dealt in ranges of ``conv_id`` and ``order`` and summed within a range; sums of the ranges before it
    are added to conversations that reach over several. Of those there is at most one for each range.
    """
    ranged = rows.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id())
    rows = _stored(ranged, name)
    within = Window.partitionBy("range", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    add = {"sum": F.sum, "xor": F.bit_xor}
    totals = rows.groupBy("conv_id", "range").agg(*[add[how](of).alias(new) for new, (how, of) in sums.items()])
    before = totals.select(
        F.col("conv_id").alias("_conv_id"),
        F.col("range").alias("_range"),
        *[add[how](new).over(earlier).alias(f"_{new}") for new, (how, _) in sums.items()],
        F.row_number().over(Window.partitionBy("conv_id").orderBy("range")).alias("_nth"),
    ).where("_nth > 1")
    same = (F.col("conv_id") == F.col("_conv_id")) & (F.col("range") == F.col("_range"))
    summed = rows.withColumns({new: add[how](of).over(within) for new, (how, of) in sums.items()})
    joined = summed.join(F.broadcast(before), same, "left")
    both = {
        new: F.coalesce(F.col(f"_{new}").bitwiseXOR(F.col(new)) if how == "xor" else F.col(f"_{new}") + F.col(new), F.col(new))
        for new, (how, _) in sums.items()
    }
    return joined.withColumns(both).drop(*before.columns, "range")


def _stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _block(depth: str) -> Column:
    return F.floor((F.length(F.bin(depth)) - 1) / 2).cast("int")


def prefix_rows(turns: DataFrame) -> DataFrame:
    """The prefix that each of ``turns`` ends: ``p1`` and ``p2``, those of the prefix before it, ``q1`` and ``q2``,
    and ``upto``, the characters up to its end; with its ``depth`` and block."""
    keys = ["key1", "key2", "place"]
    hashed = turns.select(
        "conv_id", "place", "chars", F.xxhash64(*keys).alias("z1"), F.xxhash64(F.lit(1), *keys).alias("z2")
    )
    sums = {"p1": ("xor", "z1"), "p2": ("xor", "z2"), "upto": ("sum", "chars")}
    rows = running(hashed, ["place"], sums, "trie-hashes").select(
        "conv_id", F.col("place").cast("bigint").alias("depth"), "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("z1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("z2")).alias("q2"),
        "chars", "upto",
    )
    rows = rows.withColumn("block", _block("depth"))
    return _stored(rows.hint("rebalance", "block"), "trie-prefixes", "block")


def _ends(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The prefix that each conversation is, as ``conv_id`` and the columns of ``NODE``; the root without turns."""
    last = rows.groupBy(F.col("conv_id").alias("_conv_id")).agg(F.max(F.struct(*NODE)).alias("last"))
    joined = conversations.join(last, F.col("conv_id") == F.col("_conv_id"), "left")
    ends = joined.select("conv_id", *[F.coalesce(f"last.{c}", F.lit(0).cast("bigint")).alias(c) for c in NODE])
    return _stored(ends, "trie-ends")


def ends_sha256(ends: DataFrame) -> DataFrame:
    """For each node at which conversations end, the SHA-256 of their ids in ascending order, joined by commas."""
    piece_schema = "depth bigint, p1 bigint, p2 bigint, first bigint, ids string"
    names = [*NODE, "first", "ids"]

    def pieces(batches: Iterator) -> Iterator:
        from millrace.llm.prefix_trie import PIECE, batch_of_columns

        node, ids = None, []
        for batch in batches:
            found = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id"))):
                if key != node or len(ids) == PIECE:
                    if ids:
                        found.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = key, []
                ids.append(conv)
            yield batch_of_columns(found, names, [pa.int64()] * 4 + [pa.string()])
        if ids:
            yield batch_of_columns([(*node, ids[0], ",".join(map(str, ids)))], names, [pa.int64()] * 4 + [pa.string()])

    def hashed(batches: Iterator) -> Iterator:
        from millrace.llm.prefix_trie import batch_of_columns

        node, sha = None, None
        types = [pa.int64()] * 3 + [pa.string()]
        for batch in batches:
            found = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key == node:
                    sha.update(b"," + text.encode())
                else:
                    if node is not None:
                        found.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(text.encode())
            yield batch_of_columns(found, [*NODE, "sha"], types)
        if node is not None:
            yield batch_of_columns([(*node, sha.hexdigest())], [*NODE, "sha"], types)

    ship_package(ends.sparkSession)
    order = [*NODE, "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = ordered.mapInArrow(pieces, piece_schema)
    cut = cut.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return cut.select(*NODE, "ids").mapInArrow(hashed, "depth bigint, p1 bigint, p2 bigint, sha string")


def batch_of_columns(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _merged(members: DataFrame) -> DataFrame:
    """One member for each prefix: its smallest conversation, and sums of what it has merged."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    return members.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *sums)


def _peeled(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of a block. ``rows`` are the prefixes in it, ``members`` what ends in it or survives from below."""
    end = members.select("conv_id", F.col("depth").alias("end"), "n_convs")
    owned = rows.join(end, "conv_id").where("depth <= end")
    parts = [F.min(F.struct("conv_id", "q1", "q2")).alias("least"), F.sum("n_convs").alias("n_convs")]
    found = owned.groupBy(*NODE).agg(*parts).select(*NODE, "least.*", "n_convs")
    found = _stored(found, "trie-found")
    children = found.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    children = children.agg(F.count("*").alias("within"))
    # From which characters on a member's turns are its own, and where they end.
    owner = found.select(*NODE, F.col("conv_id").alias("owner"))
    others = F.max(F.when(F.col("conv_id") != F.col("owner"), F.col("upto")))
    from_first = F.min(F.col("upto") - F.col("chars"))
    spans = owned.join(owner, NODE).groupBy("conv_id").agg(
        F.max("upto").alias("last"), F.coalesce(others, from_first).alias("from")
    )
    members = members.join(children, NODE, "left").join(spans, "conv_id")
    leaf = (F.col("n_children") + F.coalesce("within", F.lit(0)) == 0).cast("bigint")
    members = members.select("conv_id", F.col("depth").alias("end"), "n_convs", (F.col("n_leaves") + leaf).alias("n_leaves"),
                             "saved", "n_children", "last", "from")
    start = F.col("upto") - F.col("chars")
    saved = F.col("saved") + F.col("n_convs") * (F.col("last") - start) - (F.col("last") - F.greatest(start, "from"))
    below = F.when(F.col("depth") == F.col("end"), F.col("n_children")).otherwise(0)
    sums = rows.join(members, "conv_id").where("depth <= end").groupBy(*NODE).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum(saved).alias("saved"), F.sum(below).alias("below")
    )
    nodes = found.join(sums, NODE).join(children, NODE, "left")
    nodes = nodes.withColumn("n_children", F.col("below") + F.coalesce("within", F.lit(0)))
    return nodes.select(*NODE, "q1", "q2", "conv_id", "n_convs", "n_children", "n_leaves", "saved")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` (as from ``ordered_turns``) of all ``conversations`` (distinct ``conv_id``).

    Per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``
    and ``saved_tokens`` over its subtree, ``ends_sha256`` of the members that end there, and ``p1`` and ``p2``,
    the identity of its prefix.
    """
    rows = prefix_rows(turns)
    ends = _ends(rows, conversations)
    zero = F.lit(0).cast("bigint")
    ended = ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    ended = ended.select(*NODE, "conv_id", "n_convs", *[zero.alias(c) for c in ("n_children", "n_leaves", "saved")])
    deepest = ends.agg(F.max("depth")).first()[0]
    survivors, levels = None, []
    blocks = [] if not deepest else range((int(deepest).bit_length() - 1) // 2, -1, -1)
    for block in blocks:
        fresh = ended.where((F.col("depth") > 0) & (_block("depth") == block))
        members = _stored(_merged(fresh if survivors is None else fresh.unionByName(survivors)), "trie-members")
        nodes = _stored(_peeled(rows.where(F.col("block") == block).drop("block"), members), "trie-nodes")
        levels.append(nodes)
        top = nodes.where(F.col("depth") == WIDER**block)
        parent = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
        survivors = top.select(*parent, "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved")
    root = ended.where("depth = 0")
    root = _merged(root if survivors is None else root.unionByName(survivors))
    root = root.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
    root = root.select(*NODE, zero.alias("q1"), zero.alias("q2"), "conv_id", "n_convs", "n_children", "n_leaves", "saved")
    levels.append(_stored(root, "trie-nodes"))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    parents = nodes.select(*[F.col(a).alias(b) for a, b in (("depth", "_d"), ("p1", "_p1"), ("p2", "_p2"), ("conv_id", "parent_conv_id"))])
    to_parent = (F.col("depth") - 1 == F.col("_d")) & (F.col("q1") == F.col("_p1")) & (F.col("q2") == F.col("_p2"))
    found = nodes.join(ends_sha256(ends), NODE, "left").join(parents, to_parent, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "p1", "p2",
    )
