"""Quality rules on distribution divergence, as DataFrame operations only.

A document's histograms of character classes and of common words are compared with those of each
language by Jensen-Shannon distance; the nearest language counts. Histograms of short texts are
noise, so texts below a minimum length are not judged by them, and the limits widen by a share of
``1 / sqrt(words)``.

The references are exact counts over all rows that carry a language, one reference for every language.
They are some twenty numbers each whatever the corpus holds, and meet the second pass as one broadcast row.

Nulls, empty and blank texts have no words: counts 0, ``base_failed``. Repeated rows each get a row
of their own with the same verdict. A corpus without any language has no references: the base rules
alone decide. Other columns of the input are not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.text import CLASSES, count_chars, kept_rows, settled, with_class_counts, with_row, words

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.

    ``common``: words of a language's histogram, those that stand most often in all its rows. ``min_words``:
    below it a text fails, and no histogram is compared.
    ``max_repeat_percent``: words in repeated windows. ``char_limit`` and ``word_limit``: largest
    distance to the nearest language, each plus ``slack / sqrt(words)``.
    """

    common: int = 12
    min_words: int = 50
    max_repeat_percent: int = 50
    char_limit: float = 0.15
    word_limit: float = 0.18
    slack: float = 1.6


def references(docs: DataFrame, rules: Rules = Rules()) -> list[dict]:
    """Per language its shares of character classes and its commonest words with their shares.

    ``docs`` has ``text`` and ``lang``. Counts cover all rows with a language. One entry of ``common`` words
    for each language reaches the driver; of words as common as each other the first in order are taken.
    """
    tagged = docs.where("lang is not null and text is not null").select("lang", "text")
    places = range(len(CLASSES) + 1)
    by_class = (
        with_class_counts(tagged)
        .groupBy("lang")
        .agg(F.count("*").alias("docs"), *[F.sum(F.get("classes", F.lit(i))).alias(f"c{i}") for i in places])
        .orderBy(F.desc("docs"), "lang")
        .collect()
    )
    if not by_class:
        return []
    counted = (
        tagged.select("lang", F.explode_outer(words(F.col("text"))).alias("word"))
        .where("word is not null")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    # Spark takes the first of each task before it deals the rows by language.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counted.withColumn("place", place).where(F.col("place") <= rules.common).select("lang", "word", "n")
    totals = counted.groupBy("lang").agg(F.lit(None).cast("string").alias("word"), F.sum("n").alias("n"))
    rows = top.union(totals).collect()
    total = {r["lang"]: r["n"] for r in rows if r["word"] is None}
    by_word: dict[str, dict[str, float]] = {lang: {} for lang in total}
    for row in sorted((r for r in rows if r["word"] is not None), key=lambda r: (-r["n"], r["word"])):
        by_word[row["lang"]][row["word"]] = row["n"] / total[row["lang"]]
    found = []
    for row in by_class:
        counts = [row[f"c{i}"] for i in places]
        if row["lang"] in by_word:
            found.append(
                {"lang": row["lang"], "classes": [c / sum(counts) for c in counts], "words": by_word[row["lang"]]}
            )
    return found


def _part(p: Column, q: Column) -> Column:
    """One bin's share of the Jensen-Shannon divergence in bits."""
    middle = (p + q) / 2
    left = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
    right = F.when(q > 0, q * F.log2(q / middle)).otherwise(0.0)
    return (left + right) / 2


def _distance(shares: Column, rest: Column | None = None) -> Column:
    """Jensen-Shannon distance over ``shares``, an array of pairs ``p`` and ``q``.

    ``rest`` is the reference's share of all else, which is one bin more.
    """
    start = F.struct(F.lit(0.0).alias("divergence"), F.lit(0.0).alias("share"))

    def add(state: Column, x: Column) -> Column:
        divergence = state["divergence"] + _part(x["p"], x["q"])
        return F.struct(divergence.alias("divergence"), (state["share"] + x["p"]).alias("share"))

    def end(state: Column) -> Column:
        divergence = state["divergence"]
        if rest is not None:
            divergence = divergence + _part(F.greatest(1.0 - state["share"], F.lit(0.0)), rest)
        return F.sqrt(F.greatest(divergence, F.lit(0.0)))

    return F.aggregate(shares, start, add, end)


def _class_distance(reference: Column) -> Column:
    return _distance(F.zip_with("_shares", reference["classes"], lambda p, q: F.struct(p.alias("p"), q.alias("q"))))


def _word_distance(reference: Column) -> Column:
    """Over the language's common words and one bin for all others; ``_counts`` maps words to counts."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    shares = F.transform(
        reference["words"],
        lambda x: F.struct((F.coalesce(F.col("_counts")[x["word"]], F.lit(0)) / n).alias("p"), x["q"].alias("q")),
    )
    return _distance(shares, reference["rest"])


def _reference_row(spark: SparkSession, found: list[dict]) -> DataFrame:
    """One row with ``_references``: the classes, words and rest of each of ``found``."""
    listed = [
        (r["classes"], list(r["words"].items()), max(0.0, 1.0 - sum(r["words"].values()))) for r in found
    ]
    kind = "array<struct<classes:array<double>,words:array<struct<word:string,q:double>>,rest:double>>"
    return spark.createDataFrame([(listed,)], f"_references {kind}")


def _with_common_counts(df: DataFrame, found: list[dict]) -> DataFrame:
    """Adds ``_counts``: how often each reference word stands in ``words``."""
    vocabulary = sorted({w for r in found for w in r["words"]})
    hits = F.sort_array(F.filter("words", lambda w: w.isin(vocabulary)))
    df = df.withColumn("_hits", settled(hits)).withColumn("_keys", F.array_distinct("_hits"))
    df = df.withColumn("_ends", settled(F.transform("_keys", lambda w: F.array_position("_hits", w).cast("int"))))
    counts = F.transform(
        "_ends", lambda p, i: F.coalesce(F.get("_ends", i + 1), F.size("_hits") + 1) - p
    )
    return df.withColumn("_counts", settled(F.map_from_arrays("_keys", counts)))


def with_repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words of ``words`` that lie in a 3-word window found twice or more.

    Windows are compared by a 64-bit hash. They are sorted with their places, neighbours that agree
    give the places that repeat, and one pass over those in order counts the words they cover.
    Texts whose windows all differ skip the sorting.
    """
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    df = df.withColumn("_windows", F.when(F.size("words") >= 3, hashes).otherwise(F.array().cast("array<bigint>")))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    all_differ = F.size(F.array_distinct("_windows")) == F.size("_windows")
    df = df.withColumn("_placed", settled(F.when(~all_differ, placed)))

    def repeats(x: Column, k: Column) -> Column:
        before, after = F.get("_placed", k - 1)["h"], F.get("_placed", k + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    found = F.sort_array(F.transform(F.filter("_placed", repeats), lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(
        found,
        start,
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    return df.drop("_windows", "_placed")


def judged(docs: DataFrame, found: list[dict] | None = None, rules: Rules = Rules()) -> DataFrame:
    """``_row`` and ``doc_id`` of each row of ``docs`` with its counts, ``base_failed``, distances and ``kept``.

    ``found`` is the result of ``references``; it is taken over ``docs`` itself where not given.
    A distance is null where a text is too short for it or there is no reference.
    """
    if found is None:
        found = references(docs, rules)
    df = with_row(docs)
    df = df.withColumn("words", settled(words(F.col("text"))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_lines", lines).withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_symbols": count_chars(F.col("text"), SYMBOLS),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        }
    )
    df = with_repeat_words(df)
    df = df.withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    )
    judged = F.col("n_words") >= rules.min_words
    if found:
        df = with_class_counts(df)
        chars = F.greatest(F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(1))
        df = df.withColumn("_chars", settled(chars))
        df = df.withColumn("_shares", settled(F.transform("classes", lambda n: n / F.col("_chars"))))
        df = _with_common_counts(df.drop("text"), found)
        df = df.crossJoin(F.broadcast(_reference_row(docs.sparkSession, found)))
        char_distance = F.array_min(F.transform("_references", _class_distance))
        word_distance = F.array_min(F.transform("_references", _word_distance))
    else:
        char_distance = word_distance = F.lit(None).cast("double")
    df = df.withColumns(
        {"char_distance": F.when(judged, char_distance), "word_distance": F.when(judged, word_distance)}
    )
    slack = rules.slack / F.sqrt(F.greatest("n_words", F.lit(1)).cast("double"))
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= rules.char_limit + slack) & (
        F.coalesce("word_distance", F.lit(0.0)) <= rules.word_limit + slack
    )
    return df.withColumn("kept", ~F.col("base_failed") & fits)


def quality_rules(docs: DataFrame, found: list[dict] | None = None, rules: Rules = Rules()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts, ``base_failed``, ``kept`` and both distances."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    verdict = ["base_failed", "kept", "char_distance", "word_distance"]
    return judged(docs, found, rules).select("doc_id", *counts, *verdict)


def good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return kept_rows(judged(docs, None, rules), F.col("kept"))
