"""Scalar functions on part, orders and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.queries.registry import query, table

# Replacements that build on each other, so their order shows.
_SWAPS = [("ring", "cog"), ("cog", "wheel"), ("red ", "dark red "), ("blue", "navy")]


@query("""
SELECT p_partkey,
       CASE WHEN p_size > 25 THEN replace(p_name, ' ', '_') ELSE 'Function name not found' END AS func,
       replace(replace(replace(replace(p_name, 'ring', 'cog'), 'cog', 'wheel'), 'red ', 'dark red '),
               'blue', 'navy') AS swapped,
       'x = "datetime(2024, 1, ' || p_size || ')"' AS quoted,
       p_brand || '/' || p_type || '.csv' AS file,
       ends_with(p_name, 'ring') AS is_ring, contains(p_name, 'ed') AS has_ed,
       CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'LARGE' THEN 'L' ELSE 'other' END AS size_code,
       coalesce(nullif(p_type, 'PROMO'), 'none') AS kind,
       CASE WHEN p_size > 10 THEN p_name END AS cleaned
FROM part""")
def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    name, size = F.col("p_name"), F.col("p_size")
    code = F.when(size > 25, F.concat(F.lit("def "), F.replace(name, F.lit(" "), F.lit("_")), F.lit("():")))
    call = F.format_string("x = datetime(2024, 1, %d)", size)
    dirty = F.when(size > 10, name).when(size > 5, "nan").when(size > 2, "None").otherwise("")
    return parts.select(
        "p_partkey",
        t.first_group(code.otherwise(name), r"def (\w+)", "Function name not found").alias("func"),
        t.replace_all(name, _SWAPS).alias("swapped"),
        t.quote_datetimes(call).alias("quoted"),
        t.path_join(F.col("p_brand"), F.concat("p_type", F.lit(".csv"))).alias("file"),
        name.endswith("ring").alias("is_ring"),
        name.contains("ed").alias("has_ed"),
        t.lookup(F.col("p_type"), {"SMALL": "S", "LARGE": "L"}, "other").alias("size_code"),
        t.default_to(F.nullif("p_type", F.lit("PROMO")), "none").alias("kind"),
        t.null_tokens(dirty).alias("cleaned"),
    )


@query("SELECT doc_id, base64(encode(text)) AS encoded FROM documents")
def base64_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    return documents.select("doc_id", t.base64_text(F.col("text")).alias("encoded"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day,
       strftime(o_orderdate + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS hour,
       CAST(NULL AS VARCHAR) AS none
FROM orders""")
def datetime_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").repartition("o_orderkey")
    date = F.col("o_orderdate")
    parts = [F.year(date), F.month(date), F.dayofmonth(date)]

    def shown(text: Column) -> Column:
        return F.date_format(t.datetime_value(text), "yyyy-MM-dd HH:mm:ss")

    return orders.select(
        "o_orderkey",
        shown(F.format_string("datetime(%d, %d, %d)", *parts)).alias("day"),
        shown(F.format_string("{'start': datetime(%d,%d,%d, 5)}", *parts)).alias("hour"),
        shown(F.format_string("datetime(%d, 13, %d)", parts[0], parts[2])).alias("none"),
    )


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"event_id":' || event_id || ',"type":"' || event_type || '","tags":[]}' AS as_json
FROM events""")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON read and written; NULL fields are left out, empty lists stay."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(
            F.struct(
                "event_id",
                F.col("event_type").alias("type"),
                F.lit(None).cast("string").alias("gone"),
                F.array().cast("array<string>").alias("tags"),
            )
        ).alias("as_json"),
    )
