"""Grouping operators on events: stages of a chain are the days of a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import groups as g
from millrace.queries.registry import query, table


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.row_count(table(spark, sf_dir, "lineitem"))


_STAGES = """
days AS (SELECT DISTINCT user_id, CAST(date_diff('day', DATE '1970-01-01', ts) AS INTEGER) AS day,
         event_type FROM events),
nexts AS (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS after
          FROM (SELECT DISTINCT user_id, day FROM days) AS d),
edges AS (SELECT n.user_id, n.day AS stage, a.event_type AS upstream, b.event_type AS downstream
          FROM nexts n JOIN days a ON a.user_id = n.user_id AND a.day = n.day
          JOIN days b ON b.user_id = n.user_id AND b.day = n.after)"""


def _day_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(
        "user_id", F.unix_date(F.to_date("ts")).alias("day"), "event_type"
    )
    week = F.floor(F.col("day") / 7)
    return g.stage_edges(days, ["user_id"], "day", "event_type", block=week)


@query(f"WITH {_STAGES} SELECT * FROM edges")
def stage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day_edges(spark, sf_dir)


@query(f"""
WITH {_STAGES}
SELECT user_id, task, coalesce(string_agg(up, ',' ORDER BY up), '') AS depends_on FROM (
  SELECT DISTINCT user_id, downstream AS task, upstream AS up FROM edges
  UNION SELECT user_id, upstream, NULL FROM edges) AS e
GROUP BY user_id, task""")
def stage_depends_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = g.depends_on(_day_edges(spark, sf_dir), by=["user_id"], distinct=True)
    return deps.withColumn("depends_on", F.array_join("depends_on", ","))


@query(f"""
WITH {_STAGES}
SELECT user_id, upstream, string_agg(DISTINCT downstream, ',' ORDER BY downstream) AS downstreams
FROM edges GROUP BY user_id, upstream""")
def downstream_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _day_edges(spark, sf_dir)
    lists = g.group_to_list(edges, ["user_id", "upstream"], "downstream", "downstreams", distinct=True)
    return lists.withColumn("downstreams", F.array_join("downstreams", ","))


@query(f"""
WITH {_STAGES}
SELECT user_id, upstream AS task FROM edges UNION SELECT user_id, downstream FROM edges""")
def node_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return g.node_set(_day_edges(spark, sf_dir), by=["user_id"])


_KNOWN = "known AS (SELECT DISTINCT user_id, event_type AS task FROM events WHERE event_type <> 'error')"


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task rows: the event types of a user, without errors."""
    events = table(spark, sf_dir, "events").where("event_type <> 'error'")
    return events.select("user_id", F.col("event_type").alias("task")).distinct()


@query(f"""
WITH {_STAGES}, {_KNOWN}
SELECT k.user_id, k.task, coalesce(d.ups, '') AS depends_on FROM known k LEFT JOIN (
  SELECT user_id, downstream AS task, string_agg(DISTINCT upstream, ',' ORDER BY upstream) AS ups
  FROM edges GROUP BY user_id, downstream) AS d ON d.user_id = k.user_id AND d.task = k.task""")
def joined_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task rows joined with their dependencies, roots with an empty list."""
    deps = g.depends_on(_day_edges(spark, sf_dir), by=["user_id"], distinct=True)
    joined = g.with_dependencies(_known(spark, sf_dir), deps, by=["user_id"])
    return joined.withColumn("depends_on", F.array_join("depends_on", ","))


@query(f"""
WITH {_STAGES}, {_KNOWN},
nodes AS (SELECT user_id, upstream AS task FROM edges UNION SELECT user_id, downstream FROM edges)
SELECT * FROM nodes n WHERE NOT EXISTS (
  SELECT 1 FROM known k WHERE k.user_id = n.user_id AND k.task = n.task)""")
def dangling_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of edges without a task row."""
    return g.dangling(_day_edges(spark, sf_dir), _known(spark, sf_dir), by=["user_id"])


@query("""
SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(props, event_id) AS props,
       max(event_id) AS event_id, min(event_id) AS first_pos
FROM events GROUP BY user_id""")
def last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "props", "event_id")
    return g.last_value(events, ["user_id"], "event_id")
