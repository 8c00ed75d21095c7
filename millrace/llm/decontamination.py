"""Benchmark decontamination by size-partitioned MinHash containment search, as DataFrame operations only.

A test item is short and a document may be long, so their Jaccard similarity says little: what counts is
the share of the item's shingles that the document holds. Items are partitioned by size, a partition for
each power of two, and each takes the smallest hashes of an item's shingles as its MinHash sketch: ``spare``
more than the largest item of the partition may lack. Of an item with n shingles a document must hold
``need = ceil(n * percent / 100)``, so it lacks at most ``n - need`` of them, and of s sketched ones it holds
at least ``s - (n - need)``, which is more than ``spare`` or all. Documents that hold as many are candidates: none
is missed. Documents need no sketch, and none is cut or sampled.

Candidates, pairs of a document and an item, are written to the shared folder. Only documents that are in
one are read again, and all shingles of the candidate's item are counted in them exactly.

Sketches and candidates go to every task if a count shows them below ``broadcast_rows``, else Spark joins both
sides, which it can split. Partial counts are made before the shuffle, so a passage that many documents share
costs no more.

Shingles are of lower-cased words and compared by a 64-bit hash. A text with fewer words than a shingle
is one shingle of its whole sequence, so an item that short is found in documents of the same few words
only. Nulls, empty and blank texts and items have no shingles and meet nothing. Each text is searched, and each
item looked for, by itself: rows that share a ``doc_id`` (or an ``item_id``) and differ in text are not put
together, and rows with both the same count once. A null ``doc_id`` or ``item_id`` is a value like any other.
Very long texts are read whole. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import NOT_WORD, hashed_shingles, lower_ascii, settled, text_key, without_texts, words
from millrace.session import work_path

#: What tells texts, and items, apart.
DOC = ["doc_id", "text1", "text2"]
ITEM = ["item_id", "item1", "item2"]


@dataclass(frozen=True)
class Containment:
    """``shingle`` words make a shingle; an item is found where ``percent`` of its shingles are. ``spare``:
    sketched shingles beyond those a match may lack. ``broadcast_rows``: most rows of item shingles or of
    candidates that go to every task, some 50 bytes each."""

    shingle: int = 5
    percent: int = 80
    spare: int = 3
    broadcast_rows: int = 1_000_000


def _shingles(rows: DataFrame, key: list[str], how: Containment) -> DataFrame:
    listed = rows.select(*key, settled(words(lower_ascii(F.col("text")), NOT_WORD)).alias("_words"))
    listed = listed.select(*key, hashed_shingles(F.col("_words"), how.shingle, distinct=False).alias("_shingles"))
    # Not explode: its implied filter on the array would be moved down and run the lambda twice.
    return listed.select(*key, F.explode_outer("_shingles").alias("shingle"))


def index(items: DataFrame, how: Containment = Containment()) -> DataFrame:
    """Each shingle of each item: ``item_id``, ``item1`` and ``item2`` (the hash of its text), ``shingle``,
    ``n_item`` (the item's shingles), ``need`` (as many a document must hold), ``size_part``, ``sketched`` (whether
    the sketch of its partition holds it) and ``need_sketched`` (as many of the sketch a document must hold)."""
    keyed = items.select("item_id", *[k.alias(f"item{i}") for i, k in enumerate(text_key(), 1)], "text")
    distinct = _shingles(keyed, ITEM, how).where("shingle is not null").distinct()
    gathered = distinct.groupBy(*ITEM).agg(F.sort_array(F.collect_list("shingle")).alias("all"))
    sized = gathered.select(*ITEM, "all", F.size("all").alias("n_item"))
    sized = sized.withColumn("need", F.expr(f"cast((n_item * {how.percent} + 99) div 100 as int)"))
    # The binary digits of the size; its largest number lacks the most.
    sized = sized.withColumn("size_part", F.length(F.bin("n_item")))
    lack = F.expr(f"cast(((shiftleft(1L, size_part) - 1) * {100 - how.percent}) div 100 as int)")
    sized = sized.withColumn("n_sketch", F.least("n_item", lack + how.spare + 1))
    placed = sized.select(
        *ITEM, "n_item", "need", "size_part", "n_sketch", F.posexplode("all").alias("place", "shingle")
    )
    return placed.select(
        *ITEM,
        "shingle",
        "n_item",
        "need",
        "size_part",
        (F.col("place") < F.col("n_sketch")).alias("sketched"),
        (F.col("n_sketch") - (F.col("n_item") - F.col("need"))).alias("need_sketched"),
    )


def _few(rows: DataFrame, how: Containment) -> DataFrame:
    return F.broadcast(rows) if rows.limit(how.broadcast_rows + 1).count() <= how.broadcast_rows else rows


def candidates(texts: DataFrame, indexed: DataFrame, how: Containment = Containment()) -> DataFrame:
    """The keys of documents and items where the document holds enough of the item's sketch."""
    sketches = indexed.where("sketched").select(*ITEM, "shingle", "size_part", "need_sketched")
    met = _shingles(texts, DOC, how).join(_few(sketches, how), "shingle")
    distinct = met.groupBy(*DOC, *ITEM, "size_part", "need_sketched", "shingle").agg(F.lit(1).alias("one"))
    held = distinct.groupBy(*DOC, *ITEM, "size_part", "need_sketched").agg(F.count("*").alias("n_held"))
    return held.where("n_held >= need_sketched").select(*DOC, *ITEM)


def contaminations(docs: DataFrame, items: DataFrame, how: Containment = Containment()) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_found`` and ``containment`` of each item in each document
    that holds enough of it."""
    return _found(docs, items, how).select(
        "doc_id", "item_id", "n_item", "n_found", (F.col("n_found") / F.col("n_item")).alias("containment")
    )


def _found(docs: DataFrame, items: DataFrame, how: Containment) -> DataFrame:
    """The keys of documents and items, ``n_item`` and ``n_found`` where a text holds enough of an item."""
    spark = docs.sparkSession
    folder = work_path(spark, "containment")
    index(items, how).write.parquet(f"{folder}/index")
    indexed = spark.read.parquet(f"{folder}/index")
    texts = docs.select(F.col("doc_id").cast("bigint"), *text_key(), "text")
    candidates(texts, indexed, how).write.parquet(f"{folder}/candidates")
    pairs = spark.read.parquet(f"{folder}/candidates")

    # Both sides' null ids are values, so they are compared under other names.
    wanted = pairs.select(*[F.col(name).alias(f"_{name}") for name in DOC]).distinct()
    same = F.col("text1") == F.col("_text1")
    same = same & (F.col("text2") == F.col("_text2")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    again = texts.join(_few(wanted, how), same, "left_semi")
    held = _shingles(again, DOC, how).where("shingle is not null").distinct()

    one = indexed.select(*[F.col(name).alias(f"_{name}") for name in ITEM], "shingle", "n_item", "need")
    of_item = (F.col("item1") == F.col("_item1")) & (F.col("item2") == F.col("_item2"))
    of_item = of_item & F.col("item_id").eqNullSafe(F.col("_item_id"))
    expected = pairs.join(_few(one, how), of_item).select(
        *[F.col(name).alias(f"_{name}") for name in DOC], "shingle", *ITEM, "n_item", "need"
    )
    expected = expected.withColumnRenamed("shingle", "_shingle")
    counted = held.join(expected, same & (F.col("shingle") == F.col("_shingle")))
    found = counted.groupBy(*DOC, *ITEM, "n_item", "need").agg(F.count("*").cast("int").alias("n_found"))
    return found.where("n_found >= need").select(*DOC, *ITEM, "n_item", "n_found")


def clean(docs: DataFrame, items: DataFrame, how: Containment = Containment()) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, with all their columns."""
    return without_texts(docs, _found(docs, items, how)).select("_row.*")
