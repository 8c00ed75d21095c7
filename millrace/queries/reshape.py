"""Projection, schema and list operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.literals import list_literal
from millrace.operators import reshape as r
from millrace.plans.steps import run_steps
from millrace.queries.registry import query, table


@query("""
SELECT event_id, user_id AS actor_id, event_type AS actor_did_type, value AS actor_did__value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS props_k
FROM events""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    nested = events.select(
        "event_id",
        F.struct(
            F.col("user_id").alias("id"),
            F.struct(F.col("event_type").alias("type"), F.col("value").alias("_value")).alias("did"),
        ).alias("actor"),
        F.from_json("props", "struct<k:bigint>").alias("props"),
    )
    return r.flatten(nested)


@query("""
SELECT event_id, user_id AS actor_id, CAST(NULL AS VARCHAR) AS actor_did,
       event_type AS actor_did_type
FROM events""")
def json_flatten_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    did = F.struct(F.col("event_type").alias("type"))
    actor = F.struct(F.col("user_id").alias("id"), did.alias("did"))
    return r.flatten(events.select("event_id", actor.alias("actor")), emit_null_parents=True)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'None') AS c_mktsegment,
       '["' || c_name || '","' || c_mktsegment || '"]' AS tags
FROM customer""")
def cast_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.array("c_name", "c_mktsegment").alias("tags"),
    )
    return r.cast_strings(customers, null_token="None")


@query("""
SELECT p_partkey, '[' || replace(p_name, ' ', ', ') || ', null]' AS words,
       CAST(NULL AS VARCHAR) AS nothing, p_size
FROM part""")
def sanitize_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.concat(F.split("p_name", " "), F.array(F.lit(None).cast("string")))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", words.alias("words"), F.lit(None).alias("nothing"), "p_size"
    )
    return r.sanitize(parts)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS "NAME", CAST(NULL AS BIGINT) AS credit
FROM customer""")
def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_name").alias("Name"), F.col("c_custkey").alias("ID")
    )
    target = spark.createDataFrame([], "id string, NAME string, credit bigint").schema
    return r.align(customers, target)


@query("""
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return r.union_by_name(customers, suppliers)


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two list columns held as text: their lines, and language and source."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    documents = documents.repartition("doc_id")
    tags = F.when(F.col("source") != "src7", F.array("lang", "source")).when(
        F.col("lang") != "en", F.array().cast("array<string>")
    )
    return documents.select(
        "doc_id",
        list_literal(F.split("text", "\n")).alias("lines"),
        list_literal(tags).alias("tags"),
    )


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS lines, lang, source FROM documents"


@query(f"""
SELECT d.doc_id, d.lines, CASE WHEN d.source <> 'src7' THEN t.tag END AS tags
FROM ({_LINES}) AS d
CROSS JOIN (SELECT 1 AS nth UNION ALL SELECT 2) AS n
CROSS JOIN LATERAL (SELECT CASE n.nth WHEN 1 THEN d.lang ELSE d.source END AS tag) AS t
WHERE d.source <> 'src7' OR n.nth = 1""")
def explode_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List text parsed, then both lists exploded; an empty or missing list keeps its row."""
    return run_steps(
        _listed(spark, sf_dir),
        lambda df: r.parse_lists(df, "lines", "tags"),
        lambda df: r.explode_lists(df, "lines", "tags"),
    )


@query("""
SELECT doc_id, CASE WHEN source <> 'src7' THEN unnest([lang, source]) END AS tag
FROM documents WHERE source <> 'src7'
UNION ALL SELECT doc_id, NULL FROM documents WHERE source = 'src7'""")
def explode_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listed(spark, sf_dir).select("doc_id", F.col("tags").alias("tag"))
    return r.explode_lists(r.parse_lists(rows, "tag"), "tag")


@query("""
SELECT page_id, CAST(len(string_split(html, chr(10))) AS INTEGER) AS n_lines,
       string_split(html, chr(10))[1] AS first_line,
       string_split(html, chr(10))[len(string_split(html, chr(10)))] AS last_line
FROM pages""")
def parse_list_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List text with quotes and backslashes inside its elements: whole web pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html").repartition("page_id")
    texts = pages.select("page_id", list_literal(F.split("html", "\n")).alias("lines"))
    return r.parse_lists(texts, "lines").select(
        "page_id",
        F.size("lines").alias("n_lines"),
        F.element_at("lines", 1).alias("first_line"),
        F.element_at("lines", -1).alias("last_line"),
    )


@query("""
SELECT p_partkey, split_part(p_name, ' ', 1) AS first, CAST(NULL AS VARCHAR) AS second, 2 AS n
FROM part WHERE p_size > 25
UNION ALL
SELECT p_partkey, 'caf' || chr(233), p_name, 2 FROM part WHERE p_size <= 25""")
def parse_list_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List text only a Python literal reader takes: ``None`` elements, ``\\x`` escapes, tuples."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size").repartition("p_partkey")
    holed = F.format_string("['%s', None]", F.split_part("p_name", F.lit(" "), F.lit(1)))
    escaped = F.format_string("('caf\\xe9', '%s')", "p_name")
    text = F.when(F.col("p_size") > 25, holed).otherwise(escaped)
    parsed = r.parse_lists(parts.select("p_partkey", text.alias("items")), "items", exact=True)
    return parsed.select(
        "p_partkey",
        F.get("items", F.lit(0)).alias("first"),
        F.get("items", F.lit(1)).alias("second"),
        F.size("items").alias("n"),
    )
