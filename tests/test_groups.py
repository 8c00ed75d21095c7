"""Lists of groups: repeats, NULLs, and a group with very many rows of few values."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import groups as g


@pytest.mark.parametrize("distinct", [False, True])
def test_lists_equal_plain_lists(spark, distinct):
    rows = [("a", "x"), ("a", "x"), ("a", None), ("a", "b"), (None, "y"), (None, "y"), ("c", None), ("d", ""), ("d", "é")]
    expected = defaultdict(list)
    for key, value in rows:
        expected[key] += [] if value is None else [value]
    df = spark.createDataFrame(rows, "`a key` string, v string")
    found = {r[0]: list(r[1]) for r in g.group_to_list(df, ["a key"], "v", "list", distinct).collect()}
    assert found == {k: sorted(set(v)) if distinct else sorted(v) for k, v in expected.items()}
    assert g.group_to_list(df.limit(0), ["a key"], "v", "list", distinct).count() == 0


def test_names_of_the_input_do_not_clash(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 1, 9)], "_count string, _runs int, value int")
    assert [tuple(r) for r in g.group_to_list(df, ["_count"], "_runs", "value").collect()] == [("a", [1, 1])]


def test_a_hot_group_is_combined_before_the_shuffle(spark):
    """Ten million edges of one node over few values: the exchange has a row for each value and task."""
    edges = spark.range(10_000_000).select(F.lit("p").alias("path"), F.concat(F.lit("t"), F.col("id") % 50).alias("upstream"), F.lit("end").alias("downstream"))
    lists = g.group_to_list(edges, ["path", "downstream"], "upstream", "ups")
    sizes = lists.select(F.size("ups").alias("n"), F.element_at("ups", 1).alias("first"), F.element_at("ups", -1).alias("last"))
    assert [tuple(r) for r in sizes.collect()] == [(10_000_000, "t0", "t9")]
    shown = lists._jdf.queryExecution().executedPlan().toString()
    assert shown.count("collect_list") and shown.rindex("partial_count") > shown.rindex("Exchange hashpartitioning")


def test_dependencies_keep_repeats_and_roots(spark):
    edges = spark.createDataFrame([("p", "a", "b"), ("p", "a", "b"), ("p", "b", "c"), ("q", "a", "a")], "path string, upstream string, downstream string")
    found = {(r.path, r.task): list(r.depends_on) for r in g.depends_on(edges).collect()}
    assert found == {("p", "a"): [], ("p", "b"): ["a", "a"], ("p", "c"): ["b"], ("q", "a"): ["a"]}
