"""Sources, sinks, publishing, the show load and the incremental loads."""

import json
import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators import keyed as k
from millrace.operators import reshape
from millrace.plans import shows
from millrace.plans.partitions import upsert_partitions
from millrace.session import shared_dir
from millrace.sources import csv, files, records, sinks
from millrace.streaming import landing
from millrace.streaming.landing import landed_files, upsert_landed, upsert_landed_partitions


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_csv_folder_of_mixed_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,x,"say ""hi"", you\nthere"\n2,nan,\n')
    (tmp_path / "b.csv").write_text("\ufeffname,extra,id\ny,None,3\n")
    (tmp_path / "c d+[1]%20é.csv").write_text("id,name,note\n4,z,n\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "skip.txt").write_text("id,name,note\n9,no,no\n")
    (tmp_path / "transformed").mkdir()
    (tmp_path / "transformed" / "d.csv").write_text("id,name,note\n8,no,no\n")
    df = csv.scan_csv_folder(spark, str(tmp_path))
    assert rows(df.select("id", "name", "note", "extra")) == Counter(
        [("1", "x", 'say "hi", you\nthere', None), ("2", None, None, None), ("3", "y", None, None), ("4", "z", "n", None)]
    )
    (tmp_path / "twice.csv").write_text("id,name,ID\n")
    with pytest.raises(ValueError, match="twice"):
        csv.scan_csv_folder(spark, str(tmp_path))
    assert rows(csv.scan_csv_folder(spark, str(tmp_path), glob="none*.csv")) == Counter()


def test_csv_scan_infers_or_takes_a_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,when\n1,x\n")
    path = str(tmp_path / "a.csv")
    assert dict(csv.scan_csv(spark, path).dtypes)["id"] == "int"
    assert dict(csv.scan_csv(spark, path, infer=False).dtypes)["id"] == "string"
    assert dict(csv.scan_csv(spark, path, schema="id bigint, when string").dtypes)["id"] == "bigint"


def test_csv_keeps_spaces_at_the_ends(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.createDataFrame([("  a ", "\ttab")], "v string, w string"), path)
    assert tuple(csv.scan_csv(spark, path).first()) == ("  a ", "\ttab")


def test_listing_and_whole_files(spark, tmp_path):
    (tmp_path / "one é+%20.py").write_text("a = 'x'\n\nb = 'y'\n")
    (tmp_path / "two.txt").write_text("12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "three.py").write_text("no")
    listed = {Path(r.path).name: r.length for r in files.file_listing(spark, str(tmp_path)).collect()}
    assert listed == {"one é+%20.py": 17, "two.txt": 5}
    found = files.source_files(spark, str(tmp_path)).collect()
    assert [(Path(r.path).name, r.source) for r in found] == [("one é+%20.py", "a = 'x'\n\nb = 'y'\n")]


def test_gate_counts_and_pruned_reads(spark, tmp_path):
    lines = ['{"a": 1, "b": "x"}', "not json", '[{"a": 2}, {"a": 3}]', '{"a": "text"}', "{}"]
    (tmp_path / "x.json").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "a int, b string").schema
    good, bad = records.scan_json_gated(spark, str(tmp_path), schema)
    assert rows(good.select("a")) == Counter([(1,), (2,), (3,), (None,)])
    assert (good.count(), bad.count()) == (4, 2)
    assert {r.raw for r in bad.select("raw").collect()} == {"not json", '{"a": "text"}'}


def test_multi_line_document(spark, tmp_path):
    (tmp_path / "x.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert rows(records.scan_json(spark, str(tmp_path), "a int", multi_line=True)) == Counter([(1,), (2,)])


def test_publish_moves_readers_only_after_the_write(spark):
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.publish(first, "pub_t")
    broken = spark.table("pub_t").withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.publish(broken, "pub_t")
    assert rows(spark.table("pub_t")) == Counter([(1, "a")])
    for n in range(2, 5):
        sinks.publish(spark.table("pub_t").withColumn("id", F.lit(n)), "pub_t")
    assert rows(spark.table("pub_t")) == Counter([(4, "a")])
    kept = [t.name for t in spark.catalog.listTables() if t.name.startswith("pub_t__v")]
    assert len(kept) == 2


def test_empty_load_leaves_the_stage(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert sinks.replace_stage_if_any(df, "stage_t")
    assert not sinks.replace_stage_if_any(df.where("id > 5"), "stage_t")
    assert rows(spark.table("stage_t")) == Counter([(1,)])


def test_failed_load_leaves_the_stage(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    sinks.replace_stage(df, "stage_f")
    broken = df.select(F.when(F.col("id") == 2, F.raise_error(F.lit("stop")).cast("int")).otherwise(7).alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.replace_stage(broken, "stage_f")
    assert rows(spark.table("stage_f")) == Counter([(1,), (2,)])
    sinks.replace_stage(df.where("id = 2"), "stage_f")
    assert rows(spark.table("stage_f")) == Counter([(2,)])


def test_upsert_partitions_rewrites_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.createDataFrame([("d1", 1, "a"), ("d2", 1, "b"), (None, 1, "n")], "day string, id int, v string")
    keys = ["day", "id"]
    upsert_partitions(spark, path, target, keys, ["day"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=d2/*.parquet")}
    staged = spark.createDataFrame([("d1", 1, "A"), ("d3", 1, "new")], target.schema)
    upsert_partitions(spark, path, staged, keys, ["day"])
    found = spark.read.schema(target.schema).parquet(path).select("day", "id", "v")
    assert rows(found) == Counter([("d1", 1, "A"), ("d2", 1, "b"), ("d3", 1, "new"), (None, 1, "n")])
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("day=d2/*.parquet")}
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, staged, ["id"], ["day"])


SHOWS = [
    {
        "score": 0.9,
        "show": {
            "id": 1, "name": "Kid's", "genres": ["Drama", "Kid's"], "averageRuntime": 60,
            "schedule": {"time": "20:00", "days": ["Monday", "Friday"]}, "rating": {"average": 7.5},
            "network": {"id": 5, "name": "N", "country": {"name": "C", "code": "CC", "timezone": "T"}, "officialSite": "s"},
            "webChannel": None, "summary": 'a "quote", a comma\nand a line', "_links": {"self": {"href": "h"}},
        },
    },
    {"score": 0.5, "show": {"id": 2, "genres": [], "schedule": {"time": "", "days": None}, "network": None}},
]


def land(folder, name, items, extra=""):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(map(json.dumps, items)) + "\n" + extra)


def test_upsert_partitions_keeps_columns_and_null_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    have = [(1, "a", 10, "x"), (2, None, 20, "y"), (3, "b", 30, "z")]
    spark.createDataFrame(have, "k int, p string, v int, e string").write.partitionBy("p").parquet(path)
    batch = spark.createDataFrame([(1, "a", 11), (4, "", 40), (5, "a", 50)], "k int, p string, v int")
    upsert_partitions(spark, path, batch, ["k", "p"], ["p"], null_safe=True)
    found = {(r.k, r.p, r.v, r.e) for r in spark.read.parquet(path).collect()}
    assert found == {(1, "a", 11, None), (5, "a", 50, None), (2, None, 20, "y"), (4, None, 40, None), (3, "b", 30, "z")}


def test_touched_partitions_are_a_join_not_a_list(spark, tmp_path):
    """Thousands of partition values make no larger plan."""
    from millrace.plans.partitions import _touched

    path = str(tmp_path / "t")
    spark.range(20).selectExpr("id k", "cast(id as string) p").write.partitionBy("p").parquet(path)
    target = spark.read.schema("k long, p string").parquet(path)
    batch = spark.range(5000).selectExpr("id k", "cast(id + 5 as string) p")
    assert _touched(target, batch, ["p"]).count() == 15


def test_show_load(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "a.json", SHOWS, "not json at all")
    quarantine = str(tmp_path / "bad")
    load = dict(quarantine=quarantine, folder=str(tmp_path / "tables"), null_safe=True)
    assert shows.load_shows(spark, str(landing), "shows_t", **load)
    table = spark.table("shows_t")
    assert tuple(table.columns) == shows.COLUMNS and len(shows.COLUMNS) == 57
    assert {kind for _, kind in table.dtypes} == {"string"}
    first = rows(table.select(*shows.KEYS, "show_averageruntime", "show__links_self_href", "show_network_officialsite"))
    assert first == Counter(
        [("0.9", "1", genre, day, "60", "h", "s") for genre in ("Drama", "Kid's") for day in ("Monday", "Friday")]
        + [("0.5", "2", None, None, None, None, None)]
    )
    assert spark.read.parquet(quarantine).select("raw").collect() == [("not json at all",)]
    before = rows(table)
    shows.load_shows(spark, str(landing), "shows_t", **load)
    assert rows(spark.table("shows_t")) == before
    changed = [{"score": 0.9, "show": {**SHOWS[0]["show"], "name": None, "genres": ["Drama", "News"]}}]
    land(tmp_path / "next", "b.json", changed)
    shows.load_shows(spark, str(tmp_path / "next"), "shows_t", **load)
    after = spark.table("shows_t")
    assert after.count() == 7
    assert after.where("show_genres = 'Drama' and show_name is null").count() == 2


@pytest.mark.parametrize("unique_target", [False, True])
@pytest.mark.parametrize("null_safe", [False, True])
def test_a_large_show_load_sends_no_rows_to_every_task(spark, tmp_path, monkeypatch, unique_target, null_safe):
    """Rows that fill small files, as they resemble each other, are still many: no join collects them in the driver."""
    score, show = F.lit(0.5).alias("score"), F.struct("id", F.array(F.lit("Drama")).alias("genres")).alias("show")
    spark.range(60_000).select(F.to_json(F.struct(score, show)).alias("line")).write.text(str(tmp_path / "in"))
    shown, publish = [], shows.publish

    def publish_shown(df, *args, **options):
        shown.append(df._jdf.queryExecution().executedPlan().toString())
        return publish(df, *args, **options)

    monkeypatch.setattr(shows, "publish", publish_shown)
    name = f"shows_large_{null_safe}_{unique_target}".lower()
    load = dict(null_safe=null_safe, unique_target=unique_target, folder=str(tmp_path / "tables"))
    assert shows.load_shows(spark, str(tmp_path / "in"), name, **load)
    assert "SortMergeJoin" in shown[-1] and "BroadcastHashJoin" not in shown[-1]
    assert spark.table(name).count() == 60_000


def test_show_load_without_a_readable_record(spark, tmp_path):
    land(tmp_path / "in", "a.json", SHOWS)
    folder = str(tmp_path / "tables")
    shows.load_shows(spark, str(tmp_path / "in"), "shows_u", folder=folder)
    before = rows(spark.table("shows_u"))
    land(tmp_path / "broken", "b.json", [], "nothing here")
    assert shows.load_shows(spark, str(tmp_path / "broken"), "shows_u", folder=folder) is None
    assert rows(spark.table("shows_u")) == before == rows(spark.table("shows_u_stage"))


SCHEMA = "id int, day string, v string"
BATCHES = [[(1, "d1", "a"), (2, "d1", "b")], [(1, "d1", "A"), (3, "d2", "c")], [(2, "d1", "B")]]


def land_csv(folder, n, items):
    folder.mkdir(exist_ok=True)
    lines = ["id,day,v", *(",".join(map(str, item)) for item in items)]
    (folder / f"{n}.csv").write_text("\n".join(lines) + "\n")


def test_runs_equal_the_batches_in_order(spark, tmp_path):
    want = None
    for n, items in enumerate(BATCHES):
        land_csv(tmp_path / "in", n, items)
        stream = landed_files(spark, str(tmp_path / "in"), SCHEMA)
        upsert_landed(stream, "landed_t", ["id", "day"], str(tmp_path / "ck"), folder=str(tmp_path / "v"))
        upsert_landed_partitions(stream, str(tmp_path / "p"), ["id", "day"], ["day"], str(tmp_path / "ck2"))
        batch = spark.createDataFrame(items, SCHEMA)
        want = batch if want is None else k.upsert(want, batch, ["id", "day"])
    assert rows(spark.table("landed_t")) == rows(want)
    parts = spark.read.schema(SCHEMA).parquet(str(tmp_path / "p")).select("id", "day", "v")
    assert rows(parts) == rows(want)
    # nothing landed since: a run changes nothing; a lost checkpoint replays, with the same end
    upsert_landed(landed_files(spark, str(tmp_path / "in"), SCHEMA), "landed_t", ["id", "day"], str(tmp_path / "ck"))
    assert rows(spark.table("landed_t")) == rows(want)


@pytest.mark.parametrize("after", ["archive", "delete"])
def test_consumed_files_are_cleaned(spark, tmp_path, after):
    for n, items in enumerate(BATCHES):
        land_csv(tmp_path / "in", n, items)
        stream = landed_files(
            spark, str(tmp_path / "in"), SCHEMA, after=after,
            archive=str(tmp_path / "done") if after == "archive" else None,
        )
        upsert_landed(stream, f"clean_{after}", ["id", "day"], str(tmp_path / "ck"), folder=str(tmp_path / "v"))
    left = sorted(p.name for p in (tmp_path / "in").glob("*.csv"))
    archived = sorted(p.name for p in tmp_path.glob("done/**/*.csv"))
    assert left == ["2.csv"]  # the last file stays until the next run
    assert archived == (["0.csv", "1.csv"] if after == "archive" else [])
    assert spark.table(f"clean_{after}").count() == 3


def test_archive_needs_a_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="archive"):
        landed_files(spark, str(tmp_path), SCHEMA, after="archive")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_each_record_of_a_document_is_judged(spark, tmp_path):
    items = [{"id": i, "v": "x"} for i in range(1000)]
    items[3], items[500], items[999] = {"id": "three"}, [{"id": 7}], None
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(items, indent=1))
    (tmp_path / "in" / "b.json").write_text('{"id": 1000}')
    (tmp_path / "in" / "c.json").write_text('[{"id": 1},')
    (tmp_path / "in" / "d.json").write_text(" \n")
    good, bad = records.scan_records_gated(spark, str(tmp_path / "in"), "id bigint, v string", multi_line=True)
    assert sorted(r.id for r in good.select("id").collect()) == [i for i in range(1001) if i not in (3, 500, 999)]
    found = {(r.path.rsplit("/", 1)[1], r.pos, r.raw, r.salvaged) for r in bad.collect()}
    assert found == {
        ("a.json", 3, '{"id":"three"}', "{}"), ("a.json", 500, '[{"id":7}]', None), ("a.json", 999, "null", None),
        ("c.json", None, '[{"id": 1},', None),
    }
    assert good.count() == 998 and bad.count() == 4


def test_schema_and_null_parents_are_found(spark, tmp_path):
    lines = [
        {"a b": {"x": 1, "`q.r": None}, "l": [1, 2], "n": None, "both": 1, "twice": {"in": {"y": 1}}},
        [{"a b": {"x": 2.5, "`q.r": {"z": "s"}}, "both": "s"}, {"a b": {}, "twice": {"in": None}}],
        [],
        "no record",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*map(json.dumps, lines), "{broken", ""]))
    found = records.discover(spark, str(tmp_path / "in"))
    assert found.null_parents == {("a b", "`q.r"), ("twice", "in")}
    flat = reshape.flatten(records.scan_json(spark, str(tmp_path / "in"), found.schema), ".", found.null_parents)
    assert dict(flat.dtypes) == {
        "a b.`q.r": "string", "a b.`q.r.z": "string", "a b.x": "double", "both": "string", "l": "array<bigint>",
        "n": "string", "twice.in": "string", "twice.in.y": "bigint",
    }
    assert {r["both"] for r in flat.collect()} == {"1", "s", None}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text("7\n")
    assert records.discover(spark, str(tmp_path / "none")) == records.Discovered(StructType(), frozenset())


@pytest.mark.parametrize("after", ["archive", "delete"])
def test_no_consumed_file_stays(spark, tmp_path, monkeypatch, after):
    folder, done = tmp_path / "in +%20x", tmp_path / "done"
    where = landing.Consumed(str(folder), after, str(done))

    def run():
        stream = landed_files(spark, str(folder), SCHEMA)
        upsert_landed(stream, f"gone_{after}", ["id", "day"], str(tmp_path / "ck"), folder=str(tmp_path / "v"), consumed=where)

    land_csv(folder, "0 +%41", BATCHES[0])
    land_csv(folder, "empty", [])
    run()
    assert not list(folder.glob("*.csv"))
    # stopped after the batch was published and before its files were moved; the next run makes up for it
    land_csv(folder, "1", BATCHES[1])
    with monkeypatch.context() as broken:
        broken.setattr(landing, "clear_consumed", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            run()
    assert [p.name for p in folder.glob("*.csv")] == ["1.csv"]
    land_csv(folder, "2", BATCHES[2])
    run()
    assert not list(folder.glob("*.csv"))
    assert spark.table(f"gone_{after}").count() == 3
    # a file that landed under the name of one loaded before is not taken for it
    land_csv(folder, "2", [(9, "d9", "new")])
    os.utime(folder / "2.csv", (2e9, 2e9))
    assert landing.clear_consumed(spark, str(tmp_path / "ck"), where) == 0
    assert [p.name for p in folder.glob("*.csv")] == ["2.csv"]
    if after == "archive":
        assert sorted(p.name for p in done.glob("*.csv")) == ["0 +%41.csv", "1.csv", "2.csv", "empty.csv"]


def test_load_says_how_many_rows(spark, tmp_path):
    records_of = [
        {"score": 1.0, "show": {"id": 1, "genres": ["a", "b", "c"], "schedule": {"days": ["x", "y"]}}},
        {"score": 1.0, "show": {"id": 2, "genres": [], "schedule": {"days": ["x"]}}},
        {"score": 1.0, "show": {"id": 3, "genres": None}},
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([*map(json.dumps, records_of), "broken", "{"]))
    where = {"quarantine": str(tmp_path / "bad"), "folder": str(tmp_path / "t")}
    loaded = shows.load_shows_counted(spark, str(tmp_path / "in"), "shows_n", **where)
    assert loaded.counts == reshape.FanOut(3, 8, 6) and loaded.quarantined == 2
    assert spark.table("shows_n").count() == spark.table("shows_n_stage").count() == 8
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.json").write_text("broken")
    nothing = shows.load_shows_counted(spark, str(tmp_path / "none"), "shows_n", **where)
    assert nothing == shows.Loaded(None, reshape.FanOut(0, 0, 0), 1)
    assert spark.table("shows_n_stage").count() == 8 and sinks.current(spark, "shows_n") == loaded.version
