"""Bucketed upserts: what is read and written, NULL keys, conflicts, batches that run again."""

import re
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import keyed as k
from millrace.plans import buckets as b
from millrace.session import work_path
from millrace.sources.sinks import Conflict, current, properties_of, publish, versions
from millrace.streaming.landing import Batch, landed_files, upsert_landed, upsert_landed_buckets

SCHEMA = "id long, part string, value int"


@pytest.fixture
def place(spark):
    """A table name and a folder of its own."""
    return f"t_{uuid.uuid4().hex[:8]}", work_path(spark, "test-buckets")


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def files_of(spark, table):
    return set(spark.table(table).inputFiles())


def test_a_batch_of_one_bucket_reads_and_writes_one(spark, place):
    name, folder = place
    target = spark.range(20_000).selectExpr("id", "'p' AS part", "0 AS value")
    first = b.create_buckets(target, name, ["id", "part"], folder, buckets=100)
    before = files_of(spark, first)
    number = F.pmod(F.xxhash64("id", "part"), F.lit(100))
    batch = target.where(number == 7).withColumn("value", F.lit(1))
    batch = batch.union(spark.range(50_000, 60_000).selectExpr("id", "'p' AS part", "2 AS value").where(number == 7))
    second = b.upsert_buckets(batch, name, ["id", "part"], folder)
    after = files_of(spark, second)
    gone, new = before - after, after - before
    assert len(before & after) == len(before) - len(gone) and len(gone) <= 0.02 * len(before)
    assert all("/_bucket=7/" in f for f in gone | new)
    # What the merge reads is cut to the bucket before any file is opened.
    shown = spark.table(first).where(F.col(b.BUCKET).isin([7]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Location: \w+\(1 paths\)", shown)
    assert rows_of(spark.table(name)) == rows_of(k.upsert(target, batch, ["id", "part"]))
    assert spark.table(name).columns == ["id", "part", "value"]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("unique", [False, True])
def test_equals_the_plain_upsert(spark, place, null_safe, unique):
    name, folder = place
    batches = [
        [(1, "a", 1), (2, "a", 1), (None, "a", 1), (3, None, 1)],
        [(2, "a", 2), (2, "a", 5), (None, "a", 2), (4, "b", 2), (None, None, 2)],
        [(None, "a", 3), (4, "b", 3)],
    ]
    whole = None
    for rows in batches:
        batch = spark.createDataFrame(rows, SCHEMA)
        tie = [F.desc("value")]
        merge = k.replace_by_key if unique else k.upsert
        whole = k.keep_one(batch, ["id", "part"], tie) if whole is None else merge(whole, batch, ["id", "part"], tie, null_safe)
        b.upsert_buckets(batch, name, ["id", "part"], folder, tie, null_safe, unique, buckets=4)
        assert rows_of(spark.table(name)) == rows_of(whole)
    assert b.upsert_buckets(batch.limit(0), name, ["id", "part"], folder) is None


def test_rows_without_a_key_are_never_rewritten(spark, place):
    name, folder = place
    batch = spark.createDataFrame([(None, "a", 1)], SCHEMA)
    seen = set()
    for n in range(1, 4):
        table = b.upsert_buckets(batch, name, ["id", "part"], folder, buckets=4)
        assert seen < files_of(spark, table)
        seen = files_of(spark, table)
        assert spark.table(name).count() == n


def test_columns_and_types_follow_the_target(spark, place):
    name, folder = place
    b.create_buckets(spark.createDataFrame([(1, "a", 1)], "id long, `odd name` string, value int"), name, ["id"], folder)
    b.upsert_buckets(spark.createDataFrame([(1, 9), (2, 8)], "id int, VALUE int"), name, ["id"], folder)
    assert rows_of(spark.table(name)) == Counter([(1, None, 9), (2, None, 8)])
    with pytest.raises(ValueError, match="null_safe"):
        b.upsert_buckets(spark.table(name), name, ["id"], folder, null_safe=True)
    with pytest.raises(ValueError, match="_bucket"):
        b.create_buckets(spark.range(1).withColumn("_bucket", F.lit(1)), "x", ["id"], folder)
    with pytest.raises(ValueError, match="collation"):
        b.create_buckets(spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS id"), "x", ["id"], folder)


def test_an_empty_table_can_be_filled(spark, place):
    name, folder = place
    b.create_buckets(spark.createDataFrame([], SCHEMA), name, ["id"], folder)
    assert spark.table(name).count() == 0
    b.upsert_buckets(spark.createDataFrame([(1, "a", 1)], SCHEMA), name, ["id"], folder)
    assert spark.table(name).count() == 1


def test_folders_that_no_kept_version_uses_are_deleted(spark, place):
    name, folder = place
    for n in range(5):
        b.upsert_buckets(spark.range(40).selectExpr("id", "'p' AS part", f"{n} AS value").where(f"id = 0 or {n} = 0"), name, ["id"], folder, buckets=8)
    assert len(versions(spark, name)) == 2
    used = set().union(*[files_of(spark, t) for t in versions(spark, name)])
    there = {f"file:{p}" for p in Path(folder).rglob("_bucket=*/*.parquet")}
    assert {re.sub("^file:/+", "file:/", u) for u in used} == there
    assert len(list(Path(folder).glob(f"*{b.LISTED}"))) == 2
    assert rows_of(spark.table(name)) == Counter({(i, "p", 4 if i == 0 else 0): 1 for i in range(40)})


def test_two_writers_from_one_version_conflict(spark, place):
    name, folder = place
    publish(spark.range(1).toDF("id"), name, folder=folder, base=None)
    base = current(spark, name)
    mine, theirs = spark.table(base).union(spark.range(1, 2)), spark.table(base).union(spark.range(2, 3))
    publish(mine, name, folder=folder, base=base)
    with pytest.raises(Conflict):
        publish(theirs, name, folder=folder, base=base)
    assert rows_of(spark.table(name)) == Counter([(0,), (1,)])
    # From the version that is current now it goes through, and no table of the failed one is left.
    publish(spark.table(name).union(spark.range(2, 3)), name, folder=folder, base=current(spark, name))
    assert spark.table(name).count() == 3 and len(versions(spark, name)) == 2
    with pytest.raises(Conflict):
        publish(mine, name, base=None)


def test_a_bucketed_writer_that_was_overtaken_changes_nothing(spark, place, monkeypatch):
    name, folder = place
    batch = spark.createDataFrame([(1, "a", 1), (2, "a", 1)], SCHEMA)
    b.upsert_buckets(batch, name, ["id"], folder, buckets=4)
    plain_swap, other = b.swap, batch.withColumn("value", F.lit(7))

    def overtaken(*args):
        monkeypatch.setattr(b, "swap", plain_swap)
        b.upsert_buckets(other, name, ["id"], folder)
        plain_swap(*args)

    monkeypatch.setattr(b, "swap", overtaken)
    with pytest.raises(Conflict):
        b.upsert_buckets(batch.withColumn("value", F.lit(9)), name, ["id"], folder)
    assert {r.value for r in spark.table(name).collect()} == {7}


@pytest.mark.parametrize("bucketed", [False, True])
def test_a_batch_that_was_published_is_not_taken_again(spark, place, bucketed):
    """The run dies after it has published and before the checkpoint says so: rows without a key stay single."""
    name, folder = place
    source, checkpoint = f"{folder}/in", f"{folder}/checkpoint"

    def load():
        stream = landed_files(spark, source, SCHEMA)
        if bucketed:
            upsert_landed_buckets(stream, name, ["id"], f"{folder}/table", checkpoint, buckets=4)
        else:
            upsert_landed(stream, name, ["id"], checkpoint, folder=f"{folder}/table")

    def forget(number):
        for path in Path(checkpoint, "commits").glob(f"*{number}*"):
            path.unlink()

    for number, rows in enumerate([[(1, "a", 1), (None, "b", 1)], [(1, "a", 2), (None, "c", 2)]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(source)
        load()
        expected = rows_of(spark.table(name))
        forget(number)
        version = current(spark, name)
        load()
        assert current(spark, name) == version and rows_of(spark.table(name)) == expected
    assert expected == Counter([(None, "b", 1), (1, "a", 2), (None, "c", 2)])
    assert [v for p, v in properties_of(spark, version).items() if ".batch." in p] == ["1"]


def test_batches_of_other_streams_do_not_count(spark, place):
    name, folder = place
    first = publish(spark.range(1), name, folder=folder, properties=Batch("one", 5).properties())
    second = publish(spark.range(2), name, folder=folder, base=first, properties=Batch("two", 0).properties())
    assert Batch("one", 5).published(spark, second) and not Batch("one", 6).published(spark, second)
    assert Batch("two", 0).published(spark, second) and not Batch("three", 0).published(spark, second)
    assert not Batch("one", 0).published(spark, None)
