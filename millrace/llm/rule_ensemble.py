"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of each text are columns. A forest fitted on labelled rows proposes rules: each path from a
tree's root to one of its nodes is a conjunction of comparisons on statistics. A lasso logistic
regression over the rules drops most of them and weighs the rest. Scoring is the weighted sum of the
surviving rules as one Spark expression, without Python.

Nulls, empty and blank texts have statistics of 0 and are scored like any other. Rows that share a
``doc_id`` are scored each by its own text, and learned from once each if they differ. Very long texts are read
whole. Of several labels for one id the largest counts. With no
labelled rows every score is 0.5, with labels of one kind it is their share (0 or 1). Of the input only
``doc_id`` and ``text`` are read, other columns may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import CLASSES, kept_rows, settled, with_class_counts, with_row, words

STATISTICS = [*[f"share_{name}" for name in CLASSES], "share_other", "word_length", "n_words", "distinct", "line_repeats"]

#: One comparison: statistic, whether it must exceed the threshold, threshold.
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class Fit:
    """``max_rows``: labelled rows a fit reads at most, about, chosen by a hash of their id, and where ids have
    more than one row, of id and text; the fit's cost is bounded by it and the score still covers all rows. ``trees``, ``depth``: the forest.
    ``penalty``: of the lasso. ``seed``: of the forest."""

    max_rows: int = 20_000
    trees: int = 24
    depth: int = 3
    penalty: float = 0.002
    seed: int = 7


@dataclass(frozen=True)
class Ensemble:
    """``intercept`` and weighted rules; the score is the logistic of their sum."""

    intercept: float
    rules: list[tuple[float, tuple[Condition, ...]]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for weight, conditions in self.rules:
            total = total + F.when(_holds(conditions), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _holds(conditions: tuple[Condition, ...]) -> Column:
    found = F.lit(True)
    for name, above, threshold in conditions:
        found = found & (F.col(name) > threshold if above else F.col(name) <= threshold)
    return found


def with_statistics(docs: DataFrame) -> DataFrame:
    """``_row`` and ``doc_id`` of each row with the statistics of its whole text, all finite."""
    df = with_row(docs)
    df = with_class_counts(df.withColumn("words", settled(words(F.col("text")))))
    lines = F.filter(F.split("text", "\n"), lambda x: x != "")
    df = df.withColumn("_lines", lines).withColumn("_n", F.size("words").cast("double"))
    chars = F.aggregate("classes", F.lit(0).cast("bigint"), lambda a, b: a + b)
    df = df.withColumn("_chars", F.greatest(chars, F.lit(1)).cast("double"))
    some, n_lines = F.greatest("_n", F.lit(1.0)), F.greatest(F.size("_lines"), F.lit(1)).cast("double")
    blank = F.get("classes", F.lit(list(CLASSES).index("blank")))
    shares = [(F.get("classes", F.lit(i)) / F.col("_chars")).alias(n) for i, n in enumerate(STATISTICS[: len(CLASSES) + 1])]
    return df.select(
        "_row",
        "doc_id",
        *shares,
        ((F.col("_chars") - blank) / some).alias("word_length"),
        F.col("_n").alias("n_words"),
        (F.size(F.array_distinct("words")) / some).alias("distinct"),
        (1.0 - F.size(F.array_distinct("_lines")) / n_lines).alias("line_repeats"),
    )


def rules_of(debug_string: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """Every path from the root to a node of one tree, from Spark's description of it."""
    found, path = [], []
    for line in debug_string.splitlines():
        split = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if split:
            depth = len(split[1])
            path = [step for step in path if step[0] < depth] + [
                (depth, (names[int(split[2])], split[3] == ">", float(split[4])))
            ]
            found.append(tuple(sorted({condition for _, condition in path})))
    return found


def _sampled(labels: DataFrame, how: Fit) -> DataFrame:
    """About ``max_rows`` labelled ids, by a hash that does not depend on the order of rows."""
    total = labels.count()
    if total <= how.max_rows:
        return labels
    return labels.where(F.pmod(F.xxhash64("doc_id", F.lit(how.seed)), F.lit(total)) < how.max_rows)


def drawn(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> DataFrame:
    """The rows a fit reads: ``doc_id``, the statistics and ``label``; rows equal in all of it once."""
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    few = F.broadcast(_sampled(known, how).withColumnRenamed("doc_id", "_labelled"))
    same = F.col("doc_id") == F.col("_labelled")
    texts = docs.select("doc_id", "text").join(few.select("_labelled"), same).drop("_labelled")
    # An id can have any number of rows; only ids are read for this.
    total = docs.select("doc_id").join(few.select("_labelled"), same).count()
    if total > how.max_rows:
        hashed = F.xxhash64("doc_id", "text", F.lit(how.seed))
        texts = texts.where(F.pmod(hashed, F.lit(total)) < how.max_rows)
    stats = with_statistics(texts).select("doc_id", *STATISTICS)
    return stats.join(few, same).drop("_labelled").distinct()


def fit(docs: DataFrame, labels: DataFrame, how: Fit = Fit()) -> Ensemble:
    """Fits on the rows of ``labels`` (``doc_id``, ``label`` 0 or 1) that ``docs`` has a text for."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    spark: SparkSession = docs.sparkSession
    # At most about max_rows rows of a dozen numbers.
    rows = drawn(docs, labels, how).toPandas()
    rows = rows.sort_values(["doc_id", *STATISTICS], kind="stable")
    y = rows["label"].to_numpy(dtype=float)
    if not len(y) or y.min() == y.max():
        return Ensemble(0.0 if not len(y) else (40.0 if y[0] else -40.0), [])
    frame = spark.createDataFrame(rows[[*STATISTICS, "label"]]).withColumn("label", F.col("label").cast("double"))
    data = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(frame.coalesce(1))
    forest = RandomForestClassifier(numTrees=how.trees, maxDepth=how.depth, seed=how.seed, minInstancesPerNode=5)
    trees = forest.fit(data).trees
    rules = sorted({rule for tree in trees for rule in rules_of(tree.toDebugString, STATISTICS)})
    if not rules:
        return Ensemble(float(_logit(y.mean())), [])
    marks = frame.select("label", *[_holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(
        marks.coalesce(1)
    )
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=how.penalty, maxIter=40, tol=1e-4, standardization=False)
    model = lasso.fit(marked.select("label", "features"))
    weighted = zip(model.coefficients.toArray().tolist(), rules)
    return Ensemble(float(model.intercept), [(w, r) for w, r in weighted if w])


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``score`` from 0 to 1 and ``predicted``, 1 from 0.5 up."""
    scored = with_statistics(docs).select("doc_id", ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """The rows of ``docs`` with a score from 0.5 up, with all their columns."""
    return kept_rows(with_statistics(docs), ensemble.score() >= 0.5)


def held_out() -> Column:
    """Rows a fit on labels may not learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
