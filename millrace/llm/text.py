"""Column expressions over whole texts, shared by the corpus operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of these separate words: space, and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"
#: Runs of these separate words where only ASCII letters, ASCII digits and all beyond ASCII count.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Character classes of the histogram, as regular expressions; the rest is one class more.
CLASSES = {
    "lower": r"[a-z]",
    "upper": r"[A-Z]",
    "digit": r"[0-9]",
    "blank": r"[\x20\x09-\x0D]",
    "stop": r"[.,;:'\"()?-]",
    "symbol": r"[!#*$%&|<>=+@/\\^~_{}\[\]`]",
}


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; all other characters, also other upper-case letters, stay."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column, separator: str = BLANK) -> Column:
    """The words of a text in order; none for a null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def text_key() -> list[Column]:
    """``text1`` and ``text2``: a 128-bit hash of ``text``; a null text has one of its own."""
    return [F.xxhash64("text").alias("text1"), F.xxhash64(F.lit(1), "text").alias("text2")]


def settled(column: Column) -> Column:
    """``column``, computed where it stands.

    Spark moves filters below projections and merges projections by putting expressions in place of the
    columns they make; inside a lambda that would evaluate them for every element. It moves nothing past
    an expression that depends on the partition, which this one does in form.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def count_chars(text: Column, chars: str) -> Column:
    """Characters of ``text`` that the character class ``chars`` holds."""
    return (F.length(text) - F.length(F.regexp_replace(text, chars + "+", ""))).cast("bigint")


def hashed_shingles(word_list: Column, size: int, distinct: bool = True) -> Column:
    """The (distinct) 64-bit hashes of ``size`` consecutive words.

    A text with fewer words has its whole sequence as one shingle, one without words has none.
    The hash is over the words and their number, so shingles of other sizes do not meet.
    ``word_list`` must be a ``settled`` column: the lambda reads it at each place.
    """
    whole = F.array(F.xxhash64(word_list, F.lit(-1)))
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(word_list) - size),
        lambda i: F.xxhash64(*[F.get(word_list, i + k) for k in range(size)], F.lit(size)),
    )
    return F.when(F.size(word_list) == 0, F.array().cast("array<bigint>")).when(
        F.size(word_list) < size, whole
    ).otherwise(F.array_distinct(hashes) if distinct else hashes)


def with_class_counts(docs: DataFrame) -> DataFrame:
    """Adds ``classes``: the counts of each character class in order, then of all other characters.

    Each class is cut out of what the ones before it have left, so later ones read little.
    """
    left = [f"_left{i}" for i in range(len(CLASSES))]
    cut = docs
    for before, after, chars in zip(["text", *left], left, CLASSES.values()):
        cut = cut.withColumn(after, F.regexp_replace(before, chars + "+", ""))
    lengths = [F.length(name).cast("bigint") for name in ["text", *left]]
    counts = [a - b for a, b in zip(lengths, lengths[1:])] + [lengths[-1]]
    return cut.withColumn("classes", F.array(*counts)).drop(*left)


def with_row(docs: DataFrame) -> DataFrame:
    """``_row``, the whole row as a struct, with ``doc_id`` and ``text`` beside it (null text: empty).

    Columns that an operator adds then clash with none of the input's.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(row.alias("_row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def without_texts(docs: DataFrame, others: DataFrame, sent: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The rows of ``docs``, with all their columns, but those whose ``doc_id`` and text (``text1``, ``text2``)
    stand in ``others``, which go through ``sent`` first. A null ``doc_id`` is a value like any other."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(row.alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), *text_key())
    others = others.select(*[F.col(name).alias(f"_{name}") for name in ("doc_id", "text1", "text2")]).distinct()
    same = F.col("_id").eqNullSafe(F.col("_doc_id"))
    same = same & (F.col("text1") == F.col("_text1")) & (F.col("text2") == F.col("_text2"))
    return rows.join(sent(others), same, "left_anti")


def kept_rows(judged: DataFrame, kept: Column) -> DataFrame:
    """The rows of ``with_row`` for which ``kept`` holds, as they were.

    The row number keeps Spark from moving the filter below the expressions it tests, where it would
    evaluate them again for each mention, lambdas included.
    """
    marked = judged.select("_row", kept.alias("_kept"), F.monotonically_increasing_id().alias("_number"))
    return marked.where("_kept and _number >= 0").select("_row.*")
