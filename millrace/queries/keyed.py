"""Keyed operators on orders and lineitem.

The target is what was there before a date, the batch is everything from that date on, so the
two hold the whole table between them; both have several rows for many keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import keyed as k
from millrace.queries.registry import query, table

KEYS = ["o_custkey", "o_orderstatus", "o_orderpriority"]
LINE_KEYS = ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber"]

_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_KEYS = ", ".join(KEYS)
_SPLIT = """
src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
         strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, {priority} AS o_orderpriority
  FROM orders),
target AS (SELECT * FROM src WHERE o_orderdate < '1998-01-01'),
batch AS (SELECT * FROM src WHERE o_orderdate >= '1998-01-01'),
staged AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {keys} ORDER BY o_totalprice DESC, o_orderkey) AS rn
    FROM batch) AS r
  WHERE rn = 1)"""
_SAME = " AND ".join(f"s.{c} = t.{c}" for c in KEYS)
_SAFE = " AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in KEYS)
_UPDATED = """
SELECT s.* FROM target t JOIN staged s ON {same}
UNION ALL
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE {same})"""
_FRESH = "SELECT s.* FROM staged s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {same})"


def _sql(body: str, same: str = _SAME, priority: str = "o_orderpriority") -> str:
    return f"WITH {_SPLIT.format(keys=_KEYS, priority=priority)}\n{body.format(same=same)}"


UPSERT_SQL = _sql(f"{_UPDATED} UNION ALL {_FRESH}")
_MISSING = "nullif(o_orderpriority, '5-LOW')"


def tiebreak() -> list[Column]:
    return [F.desc("o_totalprice"), F.asc("o_orderkey")]


def split_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target and batch."""
    rows = table(spark, sf_dir, "orders")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before, after = rows.where(F.col("o_orderdate") < cut), rows.where(F.col("o_orderdate") >= cut)
    return _dated(before), _dated(after)


def _dated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def _keyless(rows: DataFrame) -> DataFrame:
    return rows.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


@query(
    f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
    row_number() OVER (PARTITION BY {_KEYS} ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) AS r
WHERE rn = 1"""
)
def dedup_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.keep_one(_dated(table(spark, sf_dir, "orders")), KEYS, tiebreak())


@query(_sql("SELECT s.* FROM batch s WHERE EXISTS (SELECT 1 FROM target t WHERE {same})"))
def matched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = split_orders(spark, sf_dir)
    return k.matched_rows(batch, target, KEYS)


@query(_sql("SELECT s.* FROM batch s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE {same})"))
def new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = split_orders(spark, sf_dir)
    return k.new_rows(batch, target, KEYS)


@query(_sql(_UPDATED))
def update_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = split_orders(spark, sf_dir)
    return k.update_from(target, k.keep_one(batch, KEYS, tiebreak()), KEYS)


@query(_sql(f"SELECT * FROM target UNION ALL {_FRESH}"))
def insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = split_orders(spark, sf_dir)
    return k.insert_new(target, k.keep_one(batch, KEYS, tiebreak()), KEYS)


@query(UPSERT_SQL)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return k.upsert(*split_orders(spark, sf_dir), KEYS, tiebreak())


@query(_sql(f"{_UPDATED} UNION ALL {_FRESH}", priority=_MISSING))
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key column is NULL in a fifth of the rows: those never match and are inserted."""
    target, batch = split_orders(spark, sf_dir)
    return k.upsert(_keyless(target), _keyless(batch), KEYS, tiebreak())


@query(_sql(f"{_UPDATED} UNION ALL {_FRESH}", same=_SAFE, priority=_MISSING))
def upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = split_orders(spark, sf_dir)
    return k.upsert(_keyless(target), _keyless(batch), KEYS, tiebreak(), null_safe=True)


_ONE_EACH = """
SELECT * FROM staged UNION ALL
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM target) AS t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM staged s WHERE {{same}})"""


@query(_sql(_ONE_EACH.format(keys=_KEYS)))
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a target with one row per key."""
    target, batch = split_orders(spark, sf_dir)
    return k.replace_by_key(k.keep_one(target, KEYS, tiebreak()), batch, KEYS, tiebreak())


_LINE_SAME = " AND ".join(f"s.{c} = t.{c}" for c in LINE_KEYS)


@query(f"""
WITH src AS (
  SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem),
target AS (SELECT * FROM src WHERE l_shipdate < '1998-06-01'),
staged AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(LINE_KEYS)}
      ORDER BY l_shipdate DESC, l_orderkey, l_partkey, l_tax DESC, l_quantity DESC,
               l_extendedprice DESC, l_discount DESC) AS rn
    FROM src WHERE l_shipdate >= '1998-06-01') AS r
  WHERE rn = 1)
{_UPDATED.format(same=_LINE_SAME)} UNION ALL {_FRESH.format(same=_LINE_SAME)}""")
def upsert_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four key columns, many rows per key on both sides."""
    rows = table(spark, sf_dir, "lineitem")
    cut = F.lit("1998-06-01").cast("timestamp_ntz")
    first = [F.desc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_partkey")]
    order = [*first, *map(F.desc, ("l_tax", "l_quantity", "l_extendedprice", "l_discount"))]
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    target = rows.where(F.col("l_shipdate") < cut).withColumn("l_shipdate", text)
    batch = rows.where(F.col("l_shipdate") >= cut).withColumn("l_shipdate", text)
    return k.upsert(target, batch, LINE_KEYS, order)


def _mixed_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target keyed by bigint and timestamp, batch by int and date."""
    rows = table(spark, sf_dir, "orders")
    day = F.date_trunc("day", F.col("o_orderdate").cast("timestamp"))
    target = rows.where("o_orderkey % 3 <> 1").select(
        "o_orderkey", day.alias("o_day"), F.col("o_totalprice").alias("price")
    )
    batch = rows.where("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        F.col("o_orderdate").cast("date").alias("o_day"),
        (F.col("o_totalprice") + 1).alias("price"),
    )
    return target, batch


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("o_day", F.date_format("o_day", "yyyy-MM-dd"))


_MIXED = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_day,
  CASE WHEN o_orderkey % 3 {staged} THEN o_totalprice + 1 ELSE o_totalprice END AS price
FROM orders"""


@query(_MIXED.format(staged="<> 0"))
def upsert_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _mixed_orders(spark, sf_dir)
    return _with_day(k.upsert(target, batch, ["o_orderkey", "o_day"]))


@query(_MIXED.format(staged="= 1"))
def insert_new_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _mixed_orders(spark, sf_dir)
    return _with_day(k.insert_new(target, batch, ["o_orderkey", "o_day"]))
