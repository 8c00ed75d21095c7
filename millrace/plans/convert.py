"""A folder or table of pipeline sources to tables of facts, graphs, specs and task sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import facts as f
from millrace.operators import workflow as w
from millrace.plans.placement import dealt
from millrace.session import work_path


@dataclass(frozen=True)
class Converted:
    functions: DataFrame
    assignments: DataFrame
    tasks: DataFrame
    edges: DataFrame
    records: DataFrame
    dangling: DataFrame
    specs: DataFrame
    sql: DataFrame
    sources: DataFrame
    errors: DataFrame


def convert(sources: DataFrame, base: str = "", path: str | None = None, placed: bool = False) -> Converted:
    """All results from one parse of ``(path, source)``, dealt to tasks by the length of the files.

    The facts are written once, to ``path`` or below the shared folder, split by kind: every
    result then reads only the kinds it needs, and a lost executor does not repeat the parse.
    Sources that are ``placed`` are parsed where they are, and their texts are not shuffled once more.
    """
    spark = sources.sparkSession
    place = path or work_path(spark, "facts")
    rows = sources if placed else dealt(sources, "path", F.octet_length("source"))
    f.facts(rows).write.mode("overwrite").partitionBy("kind").parquet(place)
    rows = spark.read.schema(f.FACT_SCHEMA).parquet(place)
    graph = w.task_graph(rows)
    records = w.task_records(graph)
    return Converted(
        functions=f.functions(rows),
        assignments=f.assignments(rows),
        tasks=f.tasks(rows),
        edges=f.edges(rows),
        records=records,
        dangling=w.dangling_tasks(graph),
        specs=w.workflow_spec(records, base),
        sql=w.sql_sources(records),
        sources=w.rendered_sources(rows),
        errors=f.errors(rows),
    )
