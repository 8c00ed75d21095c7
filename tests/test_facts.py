"""Source facts, task graphs, specs and rendered sources."""

import json

import pytest

from millrace.operators import facts as f
from millrace.operators import groups as g
from millrace.operators import workflow as w
from millrace.plans.convert import convert

SAMPLE = '''
from datetime import datetime
import requests

station_url = "http://example.org/readings?since=1"
out_dir = '/srv/weather/'
settings = {
    'team': 'climate',
    'first_day': datetime(2023, 6, 1),
    'tries': 3,
}

def read_station_api():
    answer = requests.get(station_url)
    if answer.ok:
        print('Writing df to file system and catalogue table')

def daily_means():
    out_dir = '/srv/means/'

def warn():
    return out_dir

fetched = PythonOperator(task_id='fetch', python_callable=read_station_api)
means = PythonOperator(task_id='means', python_callable=daily_means)
trimmed = PostgresOperator(task_id='trim', sql="""
  DELETE FROM readings WHERE celsius IS NULL;
""")
warned = PythonOperator(task_id='warn', python_callable=warn)
finished = DummyOperator(task_id='finished')

fetched >> [means, trimmed]
means >> warned
[trimmed, warned] >> finished
'''


def facts_of(spark, *sources, **options):
    rows = [(f"p{i}.py", source) for i, source in enumerate(sources)]
    return f.facts(spark.createDataFrame(rows, "path string, source string"), **options).cache()


def edge_list(facts):
    return sorted((r.upstream, r.downstream) for r in f.edges(facts).collect())


def test_sample(spark):
    facts = facts_of(spark, SAMPLE)
    assert [r.name for r in f.functions(facts).orderBy("pos").collect()] == ["read_station_api", "daily_means", "warn"]
    last = g.last_value(f.assignments(facts), ["path", "name"], "pos").orderBy("first_pos").collect()
    assert [r.name for r in last] == ["station_url", "out_dir", "settings"]
    values = {r.name: r.value for r in last}
    assert values["out_dir"] == "/srv/means/"
    assert json.loads(values["settings"]) == {"team": "climate", "first_day": "datetime(2023, 6, 1)", "tries": 3}
    tasks = [r.task for r in f.tasks(facts).orderBy("pos").collect()]
    assert tasks == ["fetched", "means", "trimmed", "warned", "finished"]
    graph = w.task_graph(facts)
    deps = {r.task: sorted(r.depends_on) for r in graph.collect()}
    assert deps == {
        "fetched": [], "means": ["fetched"], "trimmed": ["fetched"], "warned": ["means"], "finished": ["trimmed", "warned"],
    }
    spec = json.loads(w.workflow_spec(w.task_records(graph), base="/jobs/").first().spec_json)
    assert (spec["name"], spec["max_concurrent_runs"]) == ("p0", 1)
    assert [task["task_key"] for task in spec["tasks"]] == tasks
    assert {task["run_if"] for task in spec["tasks"]} == {"ALL_SUCCESS"}
    assert [task["target"] for task in spec["tasks"]] == [
        "/jobs/read_station_api", "/jobs/daily_means", "/jobs/trimmed.sql", "/jobs/warn", "/jobs/print_hello.py",
    ]
    assert spec["tasks"][3]["depends_on"] == [{"task_key": "means"}]
    sql = w.sql_sources(w.task_records(graph)).collect()
    assert [(r.task, r.sql) for r in sql] == [("trimmed", "%sql\n\n  DELETE FROM readings WHERE celsius IS NULL;\n")]


def test_rendered_sources_run_as_python(spark):
    rendered = {r.name: r.rendered for r in w.rendered_sources(facts_of(spark, SAMPLE)).collect()}
    assert set(rendered) == {"read_station_api", "daily_means", "warn"}
    for name, text in rendered.items():
        compile(text, name, "exec")
        assert text.endswith(f"\n{name}()")
        assert "out_dir = '/srv/means/'\n" in text
    assert w.HELPER in rendered["read_station_api"] and w.HELPER not in rendered["daily_means"]
    assert "saveAsTable(stage_table)" in rendered["read_station_api"]
    assert "print('Writing df" not in rendered["read_station_api"]


@pytest.mark.parametrize(
    "chain, edges",
    [
        ("a >> b >> c", [("a", "b"), ("b", "c")]),
        ("a >> [b, c] >> d", [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]),
        ("[a, b] >> [c, d]", [("a", "c"), ("a", "d"), ("b", "c"), ("b", "d")]),
        ("a >> b\na >> b", [("a", "b"), ("a", "b")]),
        ("with dag:\n    a >> b\n    with x:\n        b >> c", [("a", "b"), ("b", "c")]),
        ("a << b", []),
        ("if x:\n    a >> b", []),
        ("def g():\n    a >> b", []),
        ("a >> []", []),
        ("x = a >> b", []),
    ],
)
def test_chains(spark, chain, edges):
    facts = facts_of(spark, chain)
    assert edge_list(facts) == edges
    assert f.errors(facts).count() == 0
    linked = w.task_graph(facts).select("task", "depends_on").collect()
    assert sorted((up, r.task) for r in linked for up in r.depends_on) == edges


def test_chains_in_with_bodies_can_be_left_out(spark):
    assert edge_list(facts_of(spark, "with dag:\n    a >> b", with_bodies=False)) == []


@pytest.mark.parametrize("chain", ["a << b >> c", "a >> (b >> c)", "a >> f()", "a >> b.c", "a >> [b, f()]"])
def test_chains_that_cannot_be_read(spark, chain):
    facts = facts_of(spark, f"x >> y\n{chain}")
    assert [r.error for r in f.errors(facts).collect()] == ["unreadable chain in line 2"]
    assert edge_list(facts) == [("x", "y")]


def test_files_that_do_not_parse(spark):
    facts = facts_of(spark, "def (", "", "x = '\\0'\n", "a\x00b", "(" * 500, None, "ok = 'yes'")
    failed = {r.path for r in f.errors(facts).collect()}
    assert failed == {"p0.py", "p3.py", "p4.py"}
    assert {(r.path, r.name) for r in f.assignments(facts).collect()} == {("p2.py", "x"), ("p6.py", "ok")}


def test_functions_in_order_with_nested_ones(spark):
    source = (
        "class C:\n    def m(self):\n        def inner():\n            pass\n"
        "async def skipped():\n    def kept():\n        pass\n"
        "try:\n    pass\nexcept E:\n    def handler():\n        pass\nfinally:\n    def last():\n        pass\n"
    )
    rows = f.functions(facts_of(spark, source)).orderBy("pos").collect()
    assert [r.name for r in rows] == ["m", "inner", "kept", "handler", "last"]


def test_last_assignment_follows_the_breadth_first_walk(spark):
    source = "def g():\n    x = 'inner'\nif c:\n    x = 'if'\nx = 'outer'\n"
    facts = facts_of(spark, source)
    last = g.last_value(f.assignments(facts), ["path", "name"], "pos").first()
    assert last.value == "if"  # one level down, after the function's own statement
    top = f.assignments(facts, module_only=True).orderBy("pos").collect()
    assert [r.value for r in top] == ["outer", "if"]


def test_same_task_twice_keeps_place_and_takes_last_operator(spark):
    facts = facts_of(spark, "a = DummyOperator()\nb = DummyOperator()\na = PythonOperator(python_callable=g)\n")
    records = w.task_records(w.task_graph(facts)).orderBy("pos").collect()
    assert [(r.task, r.operator) for r in records] == [("a", "PythonOperator"), ("b", "DummyOperator")]


def test_arguments(spark):
    source = (
        "t = XOperator(1, s='x', i=3, r=1.5, b=True, n=None, name=fn, neg=-1, call=g(), att=a.b,"
        " lst=[1, 'a', [2]], tup=(1, 2), d={'k': [v]}, ds=DATA_SETS['key'], f=f'{x}', **more)\n"
        "u, v = XOperator(), YOperator()\nw = x = ZOperator()\ny = mod.QOperator()\n"
    )
    rows = f.tasks(facts_of(spark, source)).collect()
    assert [r.task for r in rows] == ["t"]
    assert rows[0].args == {
        "s": '"x"', "i": "3", "r": "1.5", "b": None, "n": None, "name": '"fn"', "neg": None, "call": None,
        "att": None, "lst": '[1, "a", [2]]', "tup": "[1, 2]", "d": '{"k": ["v"]}',
        "ds": '"{DATA_SETS[\'key\']}"', "f": None,
    }


def test_values_that_need_escapes(spark):
    nasty = "it's \\ a\nline\ttab \"q\" é \U0001f600 \r end"
    facts = facts_of(spark, f"x = {nasty!r}\ny = '\\ud800'\nd = {{'k': {nasty!r}, 'flag': True}}\ndef g():\n    pass\n")
    values = {r.name: r.value for r in f.assignments(facts).collect()}
    assert values["x"] == nasty and values["y"] == "\\ud800"
    scope = {}
    text = w.rendered_sources(facts, imports="import json\n").first().rendered
    exec(text, scope)
    assert scope["x"] == nasty and scope["d"] == {"k": nasty, "flag": True}


def test_long_fact_lists_span_batches(spark):
    source = "".join(f"t{i} = DummyOperator(task_id='t{i}')\n" for i in range(6000))
    source += " >> ".join(f"t{i}" for i in range(600))
    facts = facts_of(spark, source)
    assert f.tasks(facts).count() == 6000
    assert f.edges(facts).count() == 599


def test_run_condition_table(spark):
    facts = facts_of(spark, "a = DummyOperator(trigger_rule='all_done')\nb = CustomOperator(trigger_rule='none_failed')")
    spec = json.loads(w.workflow_spec(w.task_records(w.task_graph(facts)), run_conditions={"all_done": "ALL_DONE"}).first().spec_json)
    assert [t["run_if"] for t in spec["tasks"]] == ["ALL_DONE", "ALL_SUCCESS"]
    assert "target" not in spec["tasks"][1]


def test_convert_reads_stored_facts(spark, tmp_path):
    sources = spark.createDataFrame([("s.py", SAMPLE), ("bad.py", "def (")], "path string, source string")
    result = convert(sources, path=str(tmp_path / "facts"))
    assert result.tasks.count() == 5 and result.edges.count() == 5
    assert result.specs.count() == 1 and result.errors.count() == 1
    assert result.sources.count() == 3 and result.dangling.count() == 0
    shown = result.edges._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in shown and "PartitionFilters: [isnotnull(kind" in shown


def test_only_what_is_asked_for_is_rendered(monkeypatch):
    """Tasks that are merely counted need no argument texts; statements that hold none are not walked."""
    source = "x = 'a'\n" + "t = XOperator(a='text', b=name, c=[1])\nprint(t)\n" * 50 + "y = 'b'\n"
    read, walked = [], []
    argument, inner = f._argument, f._inner_statements
    monkeypatch.setattr(f, "_argument", lambda node: read.append(node) or argument(node))
    monkeypatch.setattr(f, "_inner_statements", lambda node: walked.append(node) or inner(node))
    assert [fact[1:4] for fact in f._file_facts(source, frozenset({"assign"}), True)] == [(0, "x", "a"), (51, "y", "b")]
    assert len(read) == 50 and len(walked) == 1  # of each task the list only
    assert len(f._file_facts(source, frozenset({"task"}), True)) == 50
    assert len(read) == 50 + 150 and len(walked) == 2


def test_an_argument_that_json_cannot_hold_fails_the_file_for_every_kind(spark):
    long = "0x" + "f" * 6000
    for value in (long, f"[{long}]", f"{{'k': {long}}}"):
        facts = facts_of(spark, f"t = XOperator(n={value})\nx = 'a'\n", kinds=["assign"])
        assert [(r.kind, r.pos) for r in facts.collect()] == [("error", None)]


def test_a_graph_without_arguments_does_not_move_them(spark, tmp_path):
    place = str(tmp_path / "facts")
    facts_of(spark, SAMPLE).write.parquet(place)
    graph = w.task_graph(spark.read.schema(f.FACT_SCHEMA).parquet(place))
    for rows in (w.task_records(graph).drop("args"), w.dangling_tasks(graph)):
        scan = next(line for line in plan(rows).splitlines() if "FileScan" in line)
        assert "args" not in scan.split("ReadSchema")[1]
    assert "args" in plan(w.task_records(graph)).split("ReadSchema")[1]


def test_placed_sources_are_parsed_where_they_are(spark, tmp_path, monkeypatch):
    sources = spark.createDataFrame([("s.py", SAMPLE), ("bad.py", "def (")], "path string, source string")
    shown, facts = [], f.facts
    monkeypatch.setattr(f, "facts", lambda rows: shown.append(plan(rows)) or facts(rows))
    for placed in (True, False):
        result = convert(sources, path=str(tmp_path / str(placed)), placed=placed)
        assert result.tasks.count() == 5 and result.errors.count() == 1
    assert "Exchange" not in shown[0] and "Exchange" in shown[1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
