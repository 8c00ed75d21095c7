"""Grouping operators over stages, edges and named values.

Lists are made of counted values, so a group with many rows of few values (a busy chain in an event table) is
combined before the shuffle; the list itself, repeats included, is one value of one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.keyed import free_name
from millrace.operators.reshape import column


def row_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return df.agg(F.count("*").alias("row_count"))


def group_to_list(
    df: DataFrame, by: Sequence[str], value: str, name: str, distinct: bool = False
) -> DataFrame:
    """Per group the sorted list of its values; repeats stay unless ``distinct``. NULL values are left out.

    Values are counted before they become lists, so what one task holds of a group grows with its different
    values: repeats meet as a number, combined before the shuffle, and are written out in the sorted list.
    """
    keys, count, runs = list(map(column, by)), free_name("_count", df), free_name("_runs", df)
    # A group of NULL values only has an empty list: a run of none of them stands for it.
    times = F.count(column(value))
    counted = df.groupBy(*keys, column(value).alias(runs)).agg(times.alias(count))
    run = F.when(column(runs).isNotNull(), F.struct(column(runs).alias("value"), column(count).alias("times")))
    sorted_runs = F.array_sort(F.collect_list(run))
    if distinct:
        values = F.transform(sorted_runs, lambda r: r["value"])
    else:
        values = F.flatten(F.transform(sorted_runs, lambda r: F.array_repeat(r["value"], r["times"].cast("int"))))
    return counted.groupBy(*keys).agg(values.alias(name))


def last_value(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """Per key the row with the highest ``pos``; ``first_pos`` is where the key came up first."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*map(column, keys))
        .agg(
            F.max_by(F.struct(*map(column, rest)), column(pos)).alias("_last"),
            F.min(column(pos)).alias("first_pos"),
        )
        .select(*map(column, keys), "_last.*", "first_pos")
    )


def join_lines(df: DataFrame, by: Sequence[str], order: str, line: Column, name: str) -> DataFrame:
    """Per group one text: its lines in ``order``, newline separated."""
    rows = F.array_sort(F.collect_list(F.struct(column(order).alias("o"), line.alias("l"))))
    return df.groupBy(*map(column, by)).agg(
        F.array_join(F.transform(rows, lambda r: r["l"]), "\n").alias(name)
    )


def node_set(edges: DataFrame, by: Sequence[str] = ("path",)) -> DataFrame:
    """Distinct nodes: every upstream and every downstream end."""
    ends = F.explode(F.array("upstream", "downstream"))
    return edges.select(*map(column, by), ends.alias("task")).distinct()


def depends_on(
    edges: DataFrame, by: Sequence[str] = ("path",), distinct: bool = False
) -> DataFrame:
    """Edges reversed: per node the sorted list of its upstreams, empty for a root.

    Each edge gives a row for its downstream end, and one without an upstream for the other
    end, so a single aggregation finds nodes, lists and roots.
    """
    ends = F.explode(
        F.array(
            F.struct(column("downstream").alias("task"), column("upstream").alias("upstream")),
            F.struct(column("upstream").alias("task"), F.lit(None).alias("upstream")),
        )
    )
    rows = edges.select(*map(column, by), ends.alias("_end")).select(*map(column, by), "_end.*")
    return group_to_list(rows, [*by, "task"], "upstream", "depends_on", distinct)


def with_dependencies(
    tasks: DataFrame, deps: DataFrame, by: Sequence[str] = ("path",), how: str = "left"
) -> DataFrame:
    """Task rows with their ``depends_on``; ``left`` keeps tasks without an edge."""
    joined = tasks.join(deps, [*by, "task"], how)
    none = F.array().cast("array<string>")
    return joined.withColumn("depends_on", F.coalesce("depends_on", none))


def dangling(edges: DataFrame, tasks: DataFrame, by: Sequence[str] = ("path",)) -> DataFrame:
    """Nodes of the edges that no task row defines."""
    known = tasks.select(*map(column, by), "task").distinct()
    return node_set(edges, by).join(known, [*by, "task"], "left_anti")


def stage_edges(
    stages: DataFrame,
    chain: Sequence[str],
    stage: str,
    task: str,
    block: Column | None = None,
) -> DataFrame:
    """Edges from each stage of a chain to the next one the chain has.

    A stage is the set of its tasks, so repeats are combined before the shuffle. Stages are
    ordered in blocks (``block`` must grow with the stage; by default 1,000 stage numbers), and
    only the head of each block is ordered along the whole chain: one long chain is spread
    over many tasks.
    """
    if block is None:
        block = F.floor(column(stage) / F.lit(1000))
    by = list(map(column, chain))
    sets = (
        stages.select(*by, column(stage).alias("stage"), column(task).alias("_t"), block.alias("_b"))
        .groupBy(*by, "_b", "stage")
        .agg(F.array_sort(F.collect_set("_t")).alias("_tasks"))
    )
    heads = sets.groupBy(*by, "_b").agg(F.min_by("_tasks", "stage").alias("_head"))
    after = heads.select(
        *by, "_b", F.lead("_head").over(Window.partitionBy(*by).orderBy("_b")).alias("_after")
    )
    within = F.lead("_tasks").over(Window.partitionBy(*by, "_b").orderBy("stage"))
    return (
        sets.withColumn("_next", within)
        .join(after, [*chain, "_b"], "left")
        .select(*by, "stage", "_tasks", F.coalesce("_next", "_after").alias("_next"))
        .select(*by, "stage", F.explode("_tasks").alias("upstream"), "_next")
        .select(*by, "stage", "upstream", F.explode("_next").alias("downstream"))
    )
