"""The incremental load: two batches of orders land as files, one run takes each."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.shows import Loaded, load_shows_counted
from millrace.queries.keyed import KEYS, split_orders, tiebreak
from millrace.queries.registry import query, table
from millrace.session import work_path
from millrace.sources.sinks import write_text
from millrace.streaming.landing import Consumed, landed_files, upsert_landed, upsert_landed_buckets, upsert_landed_partitions

_ROWS = "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders"


def _land(spark: SparkSession, sf_dir: str, after: str) -> tuple[str, str]:
    """Table loaded by two runs, and the archive folder."""
    base = work_path(spark, "landing")
    name = f"millrace_landed_{uuid.uuid4().hex[:8]}"
    for rows in split_orders(spark, sf_dir):
        rows.write.mode("append").option("header", True).csv(f"{base}/in")
        stream = landed_files(
            spark, f"{base}/in", rows.schema, after=after,
            archive=f"{base}/done" if after == "archive" else None,
        )
        upsert_landed(
            stream, name, KEYS, f"{base}/checkpoint", tiebreak(), folder=f"{base}/versions"
        )
    return name, f"{base}/done"


LANDED_SQL = f"""
WITH src AS ({_ROWS}),
ranked AS (
  SELECT *, o_orderdate >= '1998-01-01' AS late,
         row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority,
           o_orderdate >= '1998-01-01' ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM src),
winners AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority
           ORDER BY late DESC) AS pick
  FROM ranked WHERE rn = 1)
SELECT * EXCLUDE (late, rn, pick) FROM winners WHERE pick = 1"""


@query(LANDED_SQL)
def landing_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch wins where both have a key."""
    return spark.table(_land(spark, sf_dir, "off")[0])


@query(LANDED_SQL)
def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load into a folder partitioned by priority."""
    base = work_path(spark, "landing")
    for rows in split_orders(spark, sf_dir):
        rows.write.mode("append").option("header", True).csv(f"{base}/in")
        upsert_landed_partitions(
            landed_files(spark, f"{base}/in", rows.schema), f"{base}/table", KEYS,
            ["o_orderpriority"], f"{base}/checkpoint", tiebreak(), unique_target=True,
        )
    return spark.read.schema(rows.schema).parquet(f"{base}/table").select(*rows.columns)


@query(LANDED_SQL)
def landing_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load into a table in buckets of its keys."""
    base, name = work_path(spark, "landing"), f"millrace_landed_{uuid.uuid4().hex[:8]}"
    for rows in split_orders(spark, sf_dir):
        rows.write.mode("append").option("header", True).csv(f"{base}/in")
        upsert_landed_buckets(
            landed_files(spark, f"{base}/in", rows.schema), name, KEYS, f"{base}/table",
            f"{base}/checkpoint", tiebreak(), unique_target=True, buckets=16,
        )
    return spark.table(name)


@query(f"SELECT * FROM ({_ROWS}) AS t WHERE o_orderdate < '1998-01-01'")
def landing_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a finished batch are moved, one batch later: the first batch is in the archive."""
    target, _ = split_orders(spark, sf_dir)
    _, done = _land(spark, sf_dir, "archive")
    archived = spark.read.option("recursiveFileLookup", True).option("header", True)
    return archived.schema(target.schema).csv(done)


@query(f"SELECT * FROM ({_ROWS}) AS t WHERE o_orderdate >= '1998-01-01'")
def landing_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a finished batch are deleted, one batch later: the second batch is still there."""
    target, _ = split_orders(spark, sf_dir)
    _, done = _land(spark, sf_dir, "delete")
    landed = spark.read.option("header", True).schema(target.schema)
    return landed.csv(f"{done.removesuffix('/done')}/in")


@query(f"SELECT * FROM ({_ROWS}) AS t")
def landing_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are moved by the run that loads them: all rows are in the archive, none in the landing folder."""
    base, name = work_path(spark, "landing"), f"millrace_landed_{uuid.uuid4().hex[:8]}"
    for rows in split_orders(spark, sf_dir):
        rows.write.mode("append").option("header", True).csv(f"{base}/in")
        upsert_landed(
            landed_files(spark, f"{base}/in", rows.schema), name, KEYS, f"{base}/checkpoint", tiebreak(),
            folder=f"{base}/versions", consumed=Consumed(f"{base}/in", "archive", f"{base}/done"),
        )
    read = spark.read.option("header", True).schema(rows.schema)
    return read.csv(f"{base}/done").unionByName(read.csv(f"{base}/in"))


_SHOW = """
SELECT CAST(p_size AS VARCHAR) || '.5' AS score, CAST(p_partkey AS VARCHAR) AS show_id,
       unnest(string_split(p_name, ' ')) AS show_genres, {name} AS show_name,
       p_brand AS show_network_officialsite, 'parts/' || p_partkey AS show__links_self_href,
       CAST(NULL AS VARCHAR) AS show_web_channel, p_type AS day, p_size
FROM part"""


@query(f"""
WITH shows AS ({_SHOW.format(name="CASE WHEN p_type = 'LARGE' THEN 'renamed' ELSE p_name END")})
SELECT * EXCLUDE (day, p_size), unnest([day, 'any']) AS show_schedule_days FROM shows WHERE p_size > 5
UNION ALL SELECT * EXCLUDE (day, p_size), NULL FROM shows WHERE p_size <= 5""")
def show_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records landed as JSON, staged, upserted; a second load renames some of them."""
    name, _ = _load_twice(spark, sf_dir)
    return spark.table(name).select(
        "score", "show_id", "show_genres", "show_name", "show_network_officialsite",
        "show__links_self_href", "show_web_channel", "show_schedule_days",
    )


_BECAME = "len(string_split(p_name, ' ')) * CASE WHEN p_size > 5 THEN 2 ELSE 1 END"


@query(f"""
SELECT 1::BIGINT AS nth, count(*) AS rows_in, sum({_BECAME})::BIGINT AS rows_out, max({_BECAME})::BIGINT AS largest, 0::BIGINT AS quarantined FROM part
UNION ALL SELECT 2, count(*), coalesce(sum({_BECAME}), 0)::BIGINT, coalesce(max({_BECAME}), 0)::BIGINT, 0 FROM part WHERE p_type = 'LARGE'""")
def show_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both loads, counted as their stages were written."""
    _, loads = _load_twice(spark, sf_dir)
    rows = [
        (nth, load.counts.rows_in, load.counts.rows_out, load.counts.largest, load.quarantined)
        for nth, load in enumerate(loads, 1)
    ]
    return spark.createDataFrame(rows, "nth bigint, rows_in bigint, rows_out bigint, largest bigint, quarantined bigint")


def _load_twice(spark: SparkSession, sf_dir: str) -> tuple[str, list[Loaded]]:
    """The table, and what the two loads say."""
    loads = []
    base, name = work_path(spark, "shows"), f"millrace_shows_{uuid.uuid4().hex[:8]}"
    parts = table(spark, sf_dir, "part")
    text = F.lit(None).cast("string")
    days = F.when(F.col("p_size") > 5, F.array("p_type", F.lit("any"))).otherwise(F.array().cast("array<string>"))
    for nth, rows, title in (
        (1, parts, F.col("p_name")),
        (2, parts.where("p_type = 'LARGE'"), F.lit("renamed")),
    ):
        show = F.struct(
            F.col("p_partkey").alias("id"),
            title.alias("name"),
            F.split("p_name", " ").alias("genres"),
            F.struct(text.alias("time"), days.alias("days")).alias("schedule"),
            F.struct(F.col("p_brand").alias("officialSite")).alias("network"),
            F.struct(F.struct(F.format_string("parts/%d", "p_partkey").alias("href")).alias("self")).alias("_links"),
        )
        record = F.struct((F.col("p_size") + F.lit(0.5)).alias("score"), show.alias("show"))
        write_text(rows.select(F.to_json(record).alias("line")), "line", f"{base}/in{nth}")
        loads.append(
            load_shows_counted(
                spark, f"{base}/in{nth}", name, null_safe=True, quarantine=f"{base}/bad", folder=f"{base}/tables"
            )
        )
    return name, loads
