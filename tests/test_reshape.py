"""Projection, schema and list operators on edge cases."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import literals
from millrace.functions import text as t
from millrace.operators import groups as g
from millrace.operators import reshape as r
from millrace.plans.steps import run_steps


def test_flatten_joins_names_and_keeps_lists(spark):
    df = spark.createDataFrame(
        [((1, ("h",), ["a"]), None)], "show struct<id:int,_links:struct<href:string>,days:array<string>>, x int"
    )
    flat = r.flatten(df)
    assert flat.columns == ["show_id", "show__links_href", "show_days", "x"]
    assert flat.collect() == [(1, "h", ["a"], None)]
    assert r.flatten(df, sep=".").columns[1] == "show._links.href"


def test_flatten_of_a_null_parent(spark):
    df = spark.createDataFrame([((None, 1),), (None,)], "show struct<net:struct<id:int>,n:int>")
    assert [tuple(x) for x in r.flatten(df).collect()] == [(None, 1), (None, None)]
    assert r.flatten(df, emit_null_parents=True).columns == ["show_net", "show_net_id", "show_n"]


def test_flatten_refuses_names_that_clash(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<B:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        r.flatten(df)


def test_cast_strings(spark):
    df = spark.createDataFrame([(60, None, ["a", None], (1,))], "i int, gap int, l array<string>, s struct<x:int>")
    assert tuple(r.cast_strings(df).first()) == ("60", None, '["a",null]', '{"x":1}')
    assert r.cast_strings(df, null_token="nan").first().gap == "nan"
    assert {k for _, k in r.cast_strings(df).dtypes} == {"string"}


def test_sanitize_touches_void_and_lists_only(spark):
    df = spark.sql("SELECT null AS v, array('a', 'b', null) AS l, 1 AS i, named_struct('x', 1) AS s")
    clean = r.sanitize(df)
    assert dict(clean.dtypes) == {"v": "string", "l": "string", "i": "int", "s": "struct<x:int>"}
    assert clean.first().l == "[a, b, null]"


def test_align(spark):
    df = spark.createDataFrame([("1", "x")], "ID string, other string")
    target = spark.createDataFrame([], "id bigint, missing string").schema
    assert r.align(df, target).collect() == [(1, None)]


def test_explode_keeps_rows_without_elements(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ["x", "y"]), (2, [], ["x"]), (3, None, None)], "id int, l array<string>, m array<string>"
    )
    found = sorted(map(tuple, r.explode_lists(df, "l", "m").collect()), key=str)
    assert found == [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (1, "b", "y"), (2, None, "x"), (3, None, None)]


def test_names_are_resolved_and_unknown_ones_refused(spark):
    df = spark.sql("select 1 k, array('a', 'b') L, \"['x']\" t")
    assert r.explode_lists(df, "l").count() == 2
    assert r.parse_lists(df, "T").first().t == ["x"]
    for call in (r.explode_lists, r.parse_lists):
        with pytest.raises(ValueError):
            call(df, "nope")


@pytest.mark.parametrize("text", ["['a'] junk", "[]x", "['A'];DROP", "['a'", "x['a']", "['a']['b']"])
def test_text_after_a_list_makes_it_none(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(literals.parse_list(F.col("t"), exact=True).alias("l")).first().l is None
    assert df.select(literals.parse_list(F.col("t")).alias("l")).first().l is None


def test_decimals_and_nested_lists_are_lists(spark):
    texts = {"[1.5, 2]": ["1.5", "2"], "[[1, 2], [3]]": ["[1,2]", "[3]"], '[{"a": [1]}, "x]"]': ['{"a":[1]}', "x]"]}
    texts |= {"[[1], [2]] junk": None, "[1.5] x": None, "[[1]": None, "[[1]], [2]": None, '[[1]], "x"]': None, "[[1]]]": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {x.t: x.l for x in df.select("t", literals.parse_list(F.col("t")).alias("l")).collect()} == texts
    found = r.explode_lists(r.parse_lists(df.where("t = '[1.5, 2]'"), "t"), "t").collect()
    assert [x.t for x in found] == ["1.5", "2"]


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "id int, x string")
    right = spark.createDataFrame([("b", 2)], "y string, id int")
    assert sorted(map(tuple, r.union_by_name(left, right).collect())) == [(1, "a", None), (2, None, "b")]


# text, what the built-in reader gives, what the exact reader gives
LITERALS = [
    ("['Drama', 'Comedy']", ["Drama", "Comedy"], ["Drama", "Comedy"]),
    ("""["Kid's", 'B']""", ["Kid's", "B"], ["Kid's", "B"]),
    (r"['it\'s']", ["it's"], ["it's"]),
    ("[]", [], []),
    ("[1, 2]", ["1", "2"], ["1", "2"]),
    ("None", None, None),
    ("nan", None, None),
    ("Monday", None, None),
    ("", None, None),
    (None, None, None),
    ("['a', None]", None, ["a", None]),
    (r"['caf\xe9']", None, ["café"]),
    ("('a', 'b')", None, ["a", "b"]),
    ("[1.5, True]", None, ["1.5", "True"]),
]


def test_parse_list(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _, _) in enumerate(LITERALS)], "i int, text string")
    for exact, column in ((False, 1), (True, 2)):
        found = df.select("i", literals.parse_list(F.col("text"), exact).alias("l")).orderBy("i").collect()
        assert [row.l for row in found] == [case[column] for case in LITERALS]


def test_list_literal_is_read_back(spark):
    items = ["a", "it's", 'say "x"', "back\\slash", "line\nbreak", "tab\t", "", "caf\u00e9 \U0001f600"]
    df = spark.createDataFrame([(items,), ([],), (None,)], "l array<string>")
    text = df.select("l", literals.list_literal(F.col("l")).alias("t"))
    for exact in (False, True):
        for row in text.select("l", literals.parse_list(F.col("t"), exact).alias("back")).collect():
            assert row.l == row.back
    assert all(row.t is None or eval(row.t) == row.l for row in text.collect())


def test_scalars(spark):
    df = spark.createDataFrame([("x = datetime(2024, 2, 3, 4, 5, 6, 700000)", "é" * 80)], "d string, s string")
    row = df.select(
        t.datetime_value(F.col("d")).cast("string").alias("full"),
        t.datetime_value(F.lit("datetime(2024, 13, 1)")).alias("bad"),
        t.datetime_value(F.lit("datetime(2024, 1)")).alias("short"),
        t.base64_text(F.col("s")).alias("b64"),
        t.first_group(F.lit("class X"), r"def (\w+)", "none").alias("none"),
        t.replace_all(F.lit("aab"), [("a", "b"), ("bb", "c")]).alias("order"),
        t.null_tokens(F.lit("None")).alias("missing"),
        t.lookup(F.lit(None).cast("string"), {"a": "b"}, "d").alias("looked"),
        t.quote_datetimes(F.col("d")).alias("quoted"),
    ).first()
    import base64

    assert row.full == "2024-02-03 04:05:06.7"
    assert row.bad is None and row.short is None and row.missing is None
    assert row.b64 == base64.b64encode(("é" * 80).encode()).decode()
    assert (row.none, row.order, row.looked) == ("none", "cb", "d")
    assert row.quoted == 'x = "datetime(2024, 2, 3, 4, 5, 6, 700000)"'


def test_run_steps(spark):
    df = run_steps(spark.range(3), lambda d: d.where("id > 0"), lambda d: d.withColumn("x", F.col("id") + 1))
    assert sorted(map(tuple, df.collect())) == [(1, 2), (2, 3)]


def test_group_to_list_keeps_repeats_unless_distinct(spark):
    df = spark.createDataFrame([("p", "a", "z"), ("p", "b", "z"), ("p", "a", "z")], "path string, upstream string, downstream string")
    assert g.group_to_list(df, ["downstream"], "upstream", "l").first().l == ["a", "a", "b"]
    assert g.group_to_list(df, ["downstream"], "upstream", "l", distinct=True).first().l == ["a", "b"]
    assert g.row_count(df).collect() == [(3,)]


def test_reversing_edges_twice_gives_them_back(spark):
    data = [("p", "a", "b"), ("p", "a", "c"), ("p", "b", "d"), ("p", "c", "d"), ("q", "a", "b")]
    edges = spark.createDataFrame(data, "path string, upstream string, downstream string")
    deps = g.depends_on(edges)
    back = deps.select("path", F.explode("depends_on").alias("upstream"), F.col("task").alias("downstream"))
    assert sorted(map(tuple, back.collect())) == sorted(data)
    assert {r.task for r in deps.where("size(depends_on) = 0").collect()} == {"a"}


@pytest.mark.parametrize("per_block", [1, 2, 1000])
def test_stage_edges_do_not_depend_on_the_blocks(spark, per_block):
    data = [("c", 1, "a"), ("c", 1, "a"), ("c", 3, "b"), ("c", 3, "x"), ("c", 4, "d"), ("c", 9, "a"), ("o", 2, "q")]
    stages = spark.createDataFrame(data, "chain string, stage int, task string")
    edges = g.stage_edges(stages, ["chain"], "stage", "task", block=F.floor(F.col("stage") / per_block))
    assert sorted(map(tuple, edges.collect())) == [
        ("c", 1, "a", "b"), ("c", 1, "a", "x"), ("c", 3, "b", "d"), ("c", 3, "x", "d"), ("c", 4, "d", "a"),
    ]


def test_dependencies_joined_and_dangling(spark):
    tasks = spark.createDataFrame([("p", "a"), ("p", "b"), ("p", "lone")], "path string, task string")
    edges = spark.createDataFrame([("p", "a", "b"), ("p", "ghost", "b")], "path string, upstream string, downstream string")
    deps = g.depends_on(edges)
    left = {r.task: r.depends_on for r in g.with_dependencies(tasks, deps).collect()}
    assert left == {"a": [], "b": ["a", "ghost"], "lone": []}
    assert {r.task for r in g.with_dependencies(tasks, deps, how="inner").collect()} == {"a", "b"}
    assert g.dangling(edges, tasks).collect() == [("p", "ghost")]
