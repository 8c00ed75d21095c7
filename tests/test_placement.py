"""How rows are dealt to tasks by the work they are."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import facts as f
from millrace.plans.placement import MOST_TASKS, dealt
from millrace.queries.corpus import corpus_facts, sources

MB = 1 << 20


def in_tasks(df, size):
    """Rows and work of each partition."""
    found = df.select(F.spark_partition_id().alias("p"), size.alias("n")).collect()
    rows, work = Counter(), Counter()
    for r in found:
        rows[r.p] += 1
        work[r.p] += r.n or 0
    return rows, work


@pytest.mark.parametrize("cores", ["1", "64"])
def test_a_task_for_every_four_megabytes(spark, conf, cores):
    """Narrow rows that stand for 40 MB: ten tasks, whatever the number of cores, with adaptive execution on."""
    conf("spark.sql.adaptive.enabled", "true")
    conf("spark.sql.shuffle.partitions", cores)
    conf("spark.sql.leafNodeDefaultParallelism", cores)
    rows = spark.range(40_000).withColumn("path", F.concat(F.lit("p"), "id"))
    size = F.lit(MB // 1000)
    df = dealt(rows, "path", size)
    assert df.columns == ["id", "path"]
    counts, _ = in_tasks(df, size)
    assert sum(counts.values()) == 40_000 and len(counts) == 10
    assert max(counts.values()) < 1.1 * 4000


def test_a_long_row_is_alone(spark):
    """Five long files among many short ones, two of them in one group of hashes or not."""
    sizes = [(f"short{i}", 10_000) for i in range(1000)] + [(f"long{i}", 3 * MB + i) for i in range(40)] + [("none", None), (None, 9 * MB)]
    rows = spark.createDataFrame(sizes, "path string, n long")
    counts, work = in_tasks(dealt(rows, "path", F.col("n")), F.col("n"))
    assert sum(counts.values()) == len(sizes)
    alone = [p for p, n in counts.items() if n == 1]
    assert len(alone) == 40 and all(work[p] >= 3 * MB for p in alone)
    assert len(counts) == 40 + 5  # the rest is 19 MB with the row that has no path


def test_repeated_keys_empty_tables_and_many_tasks(spark):
    rows = spark.createDataFrame([("a", 3 * MB), ("a", 3 * MB), ("b", 5)], "path string, n long")
    counts, _ = in_tasks(dealt(rows, "path", F.col("n")), F.col("n"))
    assert sorted(counts.values()) == [1, 2]
    assert dealt(rows.limit(0), "path", F.col("n")).count() == 0
    assert dealt(rows, "path", F.lit(10**12)).rdd.getNumPartitions() <= MOST_TASKS


def test_sources_are_parsed_by_many_tasks(spark):
    """The parse runs where the rows were dealt to, and the rendered texts are as long as was said."""
    sf = "/root/testdata/sf0.1"
    texts = sources(spark, sf)
    whole = texts.agg(F.sum(F.octet_length("source"))).first()[0]
    counts, work = in_tasks(texts, F.octet_length("source"))
    assert 0.7 < len(counts) * 4 * MB / whole < 1.4, (len(counts), whole)
    assert max(work.values()) < 1.4 * 4 * MB
    edges = f.edges(corpus_facts(spark, sf, "chain"))
    assert edges.select(F.spark_partition_id()).distinct().count() == len(counts)
