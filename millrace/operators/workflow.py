"""From the fact table to task graphs, workflow specs and rendered task sources.

Every plan here has one parse node: facts of several kinds are brought together by grouping
one tagged table, not by joining two uses of it. A file is one row of the source table, so the
groups built per ``path`` are bounded by the size of a file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import default_to, lookup, replace_all
from millrace.operators.facts import stage_pairs

# How a trigger rule becomes the run condition of a task.
RUN_CONDITIONS = {"none_failed": "ALL_SUCCESS"}
DEFAULT_CONDITION = "ALL_SUCCESS"

# Marker statements in pipeline functions. What they are replaced with is ours.
MARKERS = (
    (
        "print('List The Objects From File System')",
        "files = spark.read.format('binaryFile').load(folder).drop('content')",
    ),
    (
        "print('Move The Files Into Another Path')",
        "spark.read.parquet(source_path).write.mode('append').parquet(archive_path)",
    ),
    (
        "print('Read The Csv Files From The File System And Convert to DF')",
        "df = spark.read.csv(csv_path, header=True, inferSchema=True)",
    ),
    (
        "print('Delete The Objects From File System')",
        "spark.sql(f'TRUNCATE TABLE {stage_table}')",
    ),
    (
        "print('Writing a string to FileSystem')",
        "spark.createDataFrame([(text,)], 'value string').write.mode('overwrite').text(text_path)",
    ),
    (
        "print('Writing df to file system and catalogue table')",
        "cast_strings(df).write.mode('overwrite').saveAsTable(stage_table)",
    ),
)
IMPORTS = "import json\nfrom datetime import datetime\nfrom pyspark.sql import SparkSession\n"
HELPER = "from millrace.operators.reshape import cast_strings, sanitize\n"
HELPER_MARK = "api"
IDLE_TARGET = "print_hello.py"


_NODES = "array<struct<task:string,ups:array<string>,feeds:boolean>>"


def task_graph(facts: DataFrame) -> DataFrame:
    """One row per task name of a file, from its assignments and its chains in one grouping.

    Columns: ``path, task, pos, operator, args, depends_on, in_chain, is_upstream``.
    ``operator`` is NULL for a name that only chains mention; the last assignment counts.
    A stage hands its task list whole to each task of the next stage, so no edge rows are made.
    """
    linked = F.flatten(
        F.transform(
            stage_pairs(F.col("stages")),
            lambda pair: F.concat(
                F.transform(pair["downs"], lambda task: _node(task, ups=pair["ups"], feeds=False)),
                F.transform(pair["ups"], lambda task: _node(task, feeds=True)),
            ),
        )
    )
    is_task = F.col("kind") == "task"
    nodes = F.when(is_task, F.array(_node(F.col("name"))).cast(_NODES)).otherwise(linked.cast(_NODES))
    # What only tasks have stays outside the nodes: a column that is not asked for is neither shuffled nor sorted.
    own = [F.when(is_task, F.col(c)).alias(c) for c in ("pos", "value", "args")]
    return (
        facts.where(F.col("kind").isin("task", "chain"))
        .repartition("path")
        .select("path", *own, F.explode(nodes).alias("_node"))
        .select("path", "pos", "value", "args", "_node.*")
        .groupBy("path", "task")
        .agg(
            F.min("pos").alias("pos"),
            F.max_by("value", "pos").alias("operator"),
            F.max_by("args", "pos").alias("args"),
            F.array_sort(F.flatten(F.collect_list("ups"))).alias("depends_on"),
            (F.count("feeds") > 0).alias("in_chain"),
            F.coalesce(F.max("feeds"), F.lit(False)).alias("is_upstream"),
        )
        .select("path", "task", "pos", "operator", "args", "depends_on", "in_chain", "is_upstream")
    )


def _node(task: Column, ups: Column | None = None, feeds: bool | None = None) -> Column:
    return F.struct(
        task.alias("task"),
        (F.lit(None).cast("array<string>") if ups is None else ups).alias("ups"),
        F.lit(feeds).cast("boolean").alias("feeds"),
    )


def task_records(graph: DataFrame, how: str = "left") -> DataFrame:
    """Tasks with operator, arguments and dependencies; ``inner`` drops those without an edge."""
    rows = graph.where(F.col("operator").isNotNull())
    if how == "inner":
        rows = rows.where("in_chain")
    return rows.select("path", "task", "pos", "operator", "args", "depends_on")


def dangling_tasks(graph: DataFrame) -> DataFrame:
    """Names that edges mention and no assignment of the file defines."""
    return graph.where(F.col("operator").isNull()).select("path", "task")


def argument(name: str, args: str = "args") -> Column:
    """Text of one task argument; NULL if it is not there."""
    return F.get_json_object(F.col(args)[name], "$")


def task_target(base: str = "") -> Column:
    """What a task runs, by its operator; NULL for an operator without a target."""
    kind = F.col("operator")
    return (
        F.when(kind == "PythonOperator", F.concat(F.lit(base), default_to(argument("python_callable"), "")))
        .when(kind == "DummyOperator", F.lit(base + IDLE_TARGET))
        .when(kind == "PostgresOperator", F.concat(F.lit(base), F.col("task"), F.lit(".sql")))
    )


def workflow_spec(
    records: DataFrame,
    base: str = "",
    run_conditions: Mapping[str, str] = RUN_CONDITIONS,
    name: Column | None = None,
) -> DataFrame:
    """One JSON text per file: its tasks in order, with run condition, dependencies, target."""
    condition = lookup(argument("trigger_rule"), run_conditions, DEFAULT_CONDITION)
    task = F.struct(
        "pos",
        F.struct(
            F.col("task").alias("task_key"),
            condition.alias("run_if"),
            F.lit(0).alias("timeout_seconds"),
            F.transform("depends_on", lambda t: F.struct(t.alias("task_key"))).alias("depends_on"),
            task_target(base).alias("target"),
        ).alias("spec"),
    )
    title = F.regexp_extract("path", r"([^/]+?)(\.py)?$", 1) if name is None else name
    return (
        records.groupBy("path")
        .agg(F.array_sort(F.collect_list(task), _by_pos).alias("_tasks"))
        .select(
            "path",
            F.to_json(
                F.struct(
                    title.alias("name"),
                    F.lit(0).alias("timeout_seconds"),
                    F.lit(1).alias("max_concurrent_runs"),
                    F.transform("_tasks", lambda t: t["spec"]).alias("tasks"),
                )
            ).alias("spec_json"),
        )
    )


def _by_pos(left: Column, right: Column) -> Column:
    return (left["pos"] - right["pos"]).cast("int")


def sql_sources(records: DataFrame) -> DataFrame:
    """The SQL of every SQL task, one row per task."""
    return records.where(F.col("operator") == "PostgresOperator").select(
        "path", "task", F.concat(F.lit("%sql\n"), argument("sql")).alias("sql")
    )


def assignment_line(name: Column, value: Column, form: Column) -> Column:
    """``name = 'value'`` as Python reads it back; a dict is loaded from its JSON."""
    quoted = replace_all(
        value, [("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\x00", "\\0")]
    )
    quoted = F.concat(F.lit("'"), quoted, F.lit("'"))
    loaded = F.when(form == "dict", F.concat(F.lit("json.loads("), quoted, F.lit(")")))
    return F.concat(name, F.lit(" = "), loaded.otherwise(quoted))


def rendered_sources(
    facts: DataFrame,
    markers: Sequence[tuple[str, str]] = MARKERS,
    imports: str = IMPORTS,
    helper: str = HELPER,
) -> DataFrame:
    """Every function as a source of its own: imports, the file's assignments, body, call.

    The helper is added for functions with ``api`` in their name. One exchange by ``path``
    serves both groupings.
    """
    is_function = F.col("kind") == "function"
    settled = (
        facts.where(F.col("kind").isin("function", "assign"))
        .repartition("path")
        .groupBy("path", "kind", "name", F.when(is_function, F.col("pos")).alias("_nth"))
        .agg(
            F.min("pos").alias("pos"),
            F.max_by("value", "pos").alias("value"),
            F.max_by("form", "pos").alias("form"),
        )
    )
    line = assignment_line(F.col("name"), F.col("value"), F.col("form"))
    lines = F.collect_list(F.when(~is_function, F.struct("pos", line.alias("line"))))
    bodies = F.collect_list(F.when(is_function, F.struct("pos", "name", "value")))
    per_file = settled.groupBy("path").agg(
        F.array_join(F.transform(F.array_sort(lines), lambda r: F.concat(r["line"], F.lit("\n"))), "").alias("_assigned"),
        bodies.alias("_bodies"),
    )
    body = replace_all(F.col("_f.value"), markers)
    extra = F.when(F.col("_f.name").contains(HELPER_MARK), F.lit(helper)).otherwise("")
    return per_file.select("path", "_assigned", F.explode("_bodies").alias("_f")).select(
        "path",
        F.col("_f.pos").alias("pos"),
        F.col("_f.name").alias("name"),
        F.concat(
            F.lit(imports), extra, "_assigned", body, F.lit("\n"), F.col("_f.name"), F.lit("()")
        ).alias("rendered"),
    )
