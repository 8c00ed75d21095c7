"""Sources and sinks: table data written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators import facts as f
from millrace.operators import keyed as k
from millrace.operators import reshape as r
from millrace.plans import buckets, partitions
from millrace.plans.convert import convert
from millrace.queries.corpus import sources
from millrace.queries.keyed import KEYS, UPSERT_SQL, split_orders, tiebreak
from millrace.queries.registry import query, table
from millrace.session import work_path
from millrace.sources import csv, files, records, sinks


def _table_name(stem: str) -> str:
    return f"millrace_{stem}_{uuid.uuid4().hex[:8]}"


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to the same folder: the second write replaces the first."""
    path = work_path(spark, "parquet")
    sinks.write_parquet(table(spark, sf_dir, "customer"), path)
    sinks.write_parquet(table(spark, sf_dir, "supplier"), path)
    return spark.read.parquet(path).select("s_suppkey", "s_name", "s_acctbal")


@query("SELECT CAST(page_id AS INTEGER) AS page_id, url, html FROM pages")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with quotes, commas and line breaks; types inferred."""
    path = work_path(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "pages"), path)
    return csv.scan_csv(spark, path)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name,
       CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS segment, CAST(NULL AS VARCHAR) AS nation
FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier""")
def csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two headers, with their columns in different order, and files that are none of it."""
    path = work_path(spark, "csv-folder")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).otherwise("nan").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    for part in (customers, suppliers):
        part.write.mode("append").option("header", True).csv(path)
    sinks.write_csv(customers, f"{path}/transformed")
    table(spark, sf_dir, "region").select("r_name").write.mode("append").text(path)
    return csv.scan_csv_folder(spark, path)


@query("SELECT DISTINCT 'lang=' || lang AS folder, true AS has_bytes FROM documents")
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "listing")
    sinks.write_text_by(table(spark, sf_dir, "documents"), "text", ["lang"], path)
    listed = files.file_listing(spark, f"{path}/lang=*", "*.txt")
    return listed.groupBy(F.regexp_extract("path", "(lang=[^/]+)/", 1).alias("folder")).agg(
        (F.min("length") > 0).alias("has_bytes")
    )


@query("""
SELECT n_name AS name, 'def load_' || lower(n_name) || '():' || chr(10) || '    return '
       || sum(c.n) AS source
FROM nation JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) AS c
  ON c_nationkey = n_nationkey
GROUP BY n_name""")
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source texts written as one file per nation, read back whole and parsed."""
    path = work_path(spark, "sources")
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nations = table(spark, sf_dir, "nation").join(counts, F.col("n_nationkey") == F.col("c_nationkey"))
    code = F.format_string("def load_%s():\n  return %d  # rows", F.lower("n_name"), "n")
    sinks.write_text_by(nations.select("n_name", code.alias("code")), "code", ["n_name"], path)
    found = f.functions(f.facts(files.source_files(spark, f"{path}/n_name=*", "*.txt")))
    return found.select(F.regexp_extract("path", "n_name=([^/]+)/", 1).alias("name"), "source")


@query("SELECT doc_id, lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS lines FROM documents) AS t")
def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents through a text folder."""
    path = work_path(spark, "text")
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("lines"))
    tagged = lines.select(F.format_string("%d\t%s", "doc_id", "lines").alias("tagged"))
    sinks.write_text(tagged, "tagged", path)
    parts = F.split("value", "\t", 2)
    return spark.read.text(path).select(parts[0].cast("bigint").alias("doc_id"), parts[1].alias("lines"))


_RECORD = (
    "score double, show struct<id:bigint, status:string, schedule:struct<day:string, tags:array<string>>>"
)


@query("""
SELECT o_totalprice AS score, o_orderkey AS show_id, o_orderstatus AS show_status,
       strftime(o_orderdate, '%Y-%m-%d') AS show_schedule_day, o_orderpriority AS show_schedule_tags
FROM orders
UNION ALL SELECT NULL, o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d'), NULL FROM orders""")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of nested objects, flattened and exploded."""
    path = work_path(spark, "json")
    orders = table(spark, sf_dir, "orders")

    def record(score: Column, tags: Column) -> Column:
        day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
        show = F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.struct(day, tags.alias("tags")).alias("schedule"),
        )
        return F.struct(score.alias("score"), show.alias("show"))

    empty = F.array().cast("array<string>")
    pair = F.array(
        record(F.col("o_totalprice"), F.array("o_orderpriority")),
        record(F.lit(None).cast("double"), empty),
    )
    sinks.write_text(orders.select(F.to_json(pair).alias("list")), "list", path)
    flat = r.flatten(records.scan_json(spark, path, _RECORD))
    return r.explode_lists(flat, "show_schedule_tags")


_BAD_PAGES = "url LIKE 'https://m.%'"


@query(f"""
SELECT page_id, url, html, NULL AS raw FROM pages WHERE NOT {_BAD_PAGES}
UNION ALL SELECT NULL, NULL, NULL, 'broken ' || url FROM pages WHERE {_BAD_PAGES}""")
def json_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that can be read, and the raw text of those that cannot."""
    path = work_path(spark, "gate")
    pages = table(spark, sf_dir, "pages")
    good = F.to_json(F.struct("page_id", "url", "html"))
    line = F.when(F.expr(_BAD_PAGES), F.concat(F.lit("broken "), "url")).otherwise(good)
    sinks.write_text(pages.select(line.alias("line")), "line", path)
    kept, quarantined = records.scan_json_gated(spark, path, pages.schema)
    return r.union_by_name(kept, quarantined.select("raw"))


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS id, o_totalprice AS score, CAST(NULL AS VARCHAR) AS show_schedule,
       CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS show_schedule_day,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS BIGINT) END AS show_schedule_slot_nr,
       o_orderstatus AS show_status
FROM orders""")
def json_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records read without a declared schema: two to a document, some with a null parent."""
    path = work_path(spark, "discovered")
    slot = F.struct(F.col("o_custkey").alias("nr"))
    schedule = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), slot.alias("slot"))
    show = F.struct(F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderstatus") != "F", schedule).alias("schedule"))
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"), show.alias("show"))
    texts = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 2).alias("document"), F.to_json(record, {"ignoreNullFields": "false"}).alias("text")
    )
    listed = texts.groupBy("document").agg(F.array_join(F.collect_list("text"), ",").alias("texts"))
    sinks.write_text(listed.select(F.concat(F.lit("["), "texts", F.lit("]")).alias("list")), "list", path)
    found = records.discover(spark, path)
    return r.flatten(records.scan_json(spark, path, found.schema), emit_null_parents=found.null_parents)


@query("""
SELECT CAST(c_custkey AS BIGINT) AS id, c_acctbal AS balance, CAST(NULL AS INTEGER) AS pos, CAST(NULL AS VARCHAR) AS raw
FROM customer WHERE c_custkey % 10 <> 3
UNION ALL SELECT NULL, NULL, CAST((c_custkey - 1) % 100 AS INTEGER),
  '{"id":' || c_custkey || ',"balance":"owes ' || c_mktsegment || '"}' FROM customer WHERE c_custkey % 10 = 3""")
def json_document_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are lists of 100 records: only the records that do not fit are put aside."""
    path = work_path(spark, "documents")
    customers = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey").cast("bigint"))
    good = F.to_json(F.struct("id", F.col("c_acctbal").alias("balance")))
    bad = F.to_json(F.struct("id", F.concat(F.lit("owes "), "c_mktsegment").alias("balance")))
    texts = customers.select("id", F.when(F.col("id") % 10 == 3, bad).otherwise(good).alias("text"))
    pairs = F.sort_array(F.collect_list(F.struct("id", "text")))
    listed = texts.groupBy(F.floor((F.col("id") - 1) / 100)).agg(F.array_join(pairs["text"], ", ").alias("texts"))
    sinks.write_text(listed.select(F.concat(F.lit("["), "texts", F.lit("]")).alias("list")), "list", path)
    kept, quarantined = records.scan_records_gated(spark, path, "id bigint, balance double")
    return r.union_by_name(kept, quarantined.select("pos", "raw"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def staging_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage replaced by a new load; a load without rows leaves it as it is."""
    name, path = _table_name("stage"), work_path(spark, "stage")
    customers = table(spark, sf_dir, "customer")
    sinks.replace_stage_if_any(customers.select("c_custkey"), name, path)
    sinks.replace_stage_if_any(customers.select("c_custkey", "c_name", "c_mktsegment"), name, path)
    sinks.replace_stage_if_any(customers.where("c_custkey < 0"), name, path)
    return spark.table(name)


@query(UPSERT_SQL)
def publish_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert published as the next version of the table it reads."""
    name, folder = _table_name("orders"), work_path(spark, "published")
    target, batch = split_orders(spark, sf_dir)
    sinks.publish(target, name, folder=folder)
    sinks.publish(k.upsert(spark.table(name), batch, KEYS, tiebreak()), name, folder=folder)
    return spark.table(name)


@query(UPSERT_SQL)
def upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a folder partitioned by one of the keys."""
    path = work_path(spark, "partitioned")
    target, batch = split_orders(spark, sf_dir)
    sinks.overwrite_partitions(target, path, ["o_orderpriority"])
    partitions.upsert_partitions(spark, path, batch, KEYS, ["o_orderpriority"], tiebreak())
    return spark.read.schema(target.schema).parquet(path).select(*target.columns)


@query(UPSERT_SQL)
def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a table in buckets of its keys: the others keep their files."""
    name, folder = _table_name("buckets"), work_path(spark, "buckets")
    target, batch = split_orders(spark, sf_dir)
    buckets.create_buckets(target, name, KEYS, folder, buckets=32)
    # The batch in two parts that share no key, each of which leaves buckets as they are.
    for half in (0, 1):
        part = F.pmod(F.xxhash64(*KEYS), F.lit(32)) % 2 == half
        buckets.upsert_buckets(batch.where(part), name, KEYS, folder, tiebreak())
    return spark.table(name)


@query("""
SELECT 'parts/' || p_partkey || '.py' AS path, CAST(p_size + 4 AS BIGINT) AS n_tasks, p_brand = 'Brand#13' AS is_broken
FROM part WHERE p_brand <> 'Brand#13'
UNION ALL SELECT 'parts/' || p_partkey || '.py', NULL, true FROM part WHERE p_brand = 'Brand#13'""")
def convert_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole conversion, parsed once: tasks per spec, and the files that failed."""
    result = convert(sources(spark, sf_dir), placed=True)
    spec = F.from_json("spec_json", StructType.fromDDL("tasks array<struct<task_key:string>>"))
    specs = result.specs.select(
        "path", F.size(spec["tasks"]).cast("bigint").alias("n_tasks"), F.lit(False).alias("is_broken")
    )
    failed = result.errors.where("pos IS NULL").select("path", F.lit(True).alias("is_broken"))
    return r.union_by_name(specs, failed)
