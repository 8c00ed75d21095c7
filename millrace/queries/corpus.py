"""Pipeline sources, one file per part, with a chain shape for each part type.

A file has the tasks start, fetch, load_1 .. load_<size>, alone, end. Parts of one brand
give a file that does not parse. Each file is rendered from its own row, so the corpus grows with
the table and no file grows with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import facts as f
from millrace.operators import groups as g
from millrace.operators import workflow as w
from millrace.plans.placement import dealt
from millrace.queries.registry import query, table

_HEAD = """from datetime import datetime
owner = '%1$s'
note = '%2$s'
default_args = {'owner': owner, 'start_date': datetime(2024, 1, 1), 'retries': %3$d, 'late': None}
dag = DAG('part', default_args=default_args)

def call_api():
    note = 'local'
    print('Writing df to file system and catalogue table')

class Loader:

    def load_data(self):
        return '%1$s'

start = DummyOperator(task_id='start', trigger_rule='none_failed')
fetch = PythonOperator(task_id='fetch_task', python_callable=call_api, dag=dag, retries=%3$d)
"""
_LOAD = ("load_", " = PostgresOperator(task_id='load', sql=\"select '", "'\"\n    \"\\nfrom t\", depth=-", ")\n")
_TAIL = """alone = CustomOperator(task_id='alone', params={'size': %1$d, 'tags': ['a', 1]}, key=DATA_SETS['k'])
end = DummyOperator(task_id='end', flag=True)
"""
_BROKEN = "Brand#13"


def _source() -> Column:
    numbers = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: i.cast("string"))
    named, selects, depth, end = map(F.lit, _LOAD)
    selects = F.concat(selects, F.coalesce("p_type", F.lit("null")), depth)
    loads = F.transform(numbers, lambda i: F.concat(named, i, selects, i, end))
    names = F.transform(numbers, lambda i: F.concat(F.lit("load_"), i))
    listed = F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))
    kind = F.col("p_type")
    chain = (
        F.when(kind == "ECONOMY", F.concat(F.lit("start >> fetch >> "), F.array_join(names, " >> "), F.lit(" >> end")))
        .when(kind == "STANDARD", F.concat(F.lit("start >> fetch >> "), listed, F.lit(" >> end")))
        .when(kind == "PROMO", F.concat(F.lit("start >> fetch >> "), listed, F.lit(" >> end\nstart >> fetch")))
        .when(kind == "LARGE", F.concat(F.lit("start >> [fetch, alone] >> "), listed, F.lit(" >> end")))
        .when(kind == "SMALL", F.lit("with dag:\n    start >> fetch >> end"))
        .otherwise(F.lit("start >> fetch >> ghost >> end\nend << start\nstart << end >> fetch"))
    )
    return F.concat(
        F.when(F.col("p_brand") == _BROKEN, F.lit("def (:\n")).otherwise(""),
        F.format_string(_HEAD, "p_brand", "p_name", "p_size"),
        F.array_join(loads, ""),
        F.format_string(_TAIL, "p_size"),
        chain,
        F.lit("\n"),
    )


def _length() -> Column:
    """About how long a source is, from its row alone."""
    return F.lit(len(_HEAD) + len(_TAIL) + 60) + F.col("p_size") * (sum(map(len, _LOAD)) + 32)


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, source)``. The narrow part rows are dealt out by the length of the texts made from them."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    path = F.format_string("parts/%d.py", "p_partkey")
    return dealt(parts, "p_partkey", _length()).select(path.alias("path"), _source().alias("source"))


def corpus_facts(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return f.facts(sources(spark, sf_dir), kinds or f.KINDS)


_FILES = f"""
files AS (SELECT 'parts/' || p_partkey || '.py' AS path, * FROM part WHERE p_brand <> '{_BROKEN}'),
loads AS (SELECT path, p_type, p_size, CAST(unnest(generate_series(1, p_size)) AS INTEGER) AS i FROM files)"""
_EDGES = """
edges AS (
  SELECT path, 0 AS chain, 0 AS stage, 'start' AS upstream, 'fetch' AS downstream FROM files
  UNION ALL SELECT path, 1, 0, 'start', 'fetch' FROM files WHERE p_type = 'PROMO'
  UNION ALL SELECT path, 0, 0, 'start', 'alone' FROM files WHERE p_type = 'LARGE'
  UNION ALL SELECT path, 0, 1, 'fetch', 'load_' || i FROM loads
    WHERE p_type IN ('STANDARD', 'PROMO', 'LARGE') OR p_type = 'ECONOMY' AND i = 1
  UNION ALL SELECT path, 0, 1, 'alone', 'load_' || i FROM loads WHERE p_type = 'LARGE'
  UNION ALL SELECT path, 0, 2, 'load_' || i, 'end' FROM loads
    WHERE p_type IN ('STANDARD', 'PROMO', 'LARGE')
  UNION ALL SELECT path, 0, i + 1, 'load_' || i,
      CASE WHEN i = p_size THEN 'end' ELSE 'load_' || (i + 1) END
    FROM loads WHERE p_type = 'ECONOMY'
  UNION ALL SELECT path, 0, 1, 'fetch', 'end' FROM files WHERE p_type = 'SMALL'
  UNION ALL SELECT path, 0, 1, 'fetch', 'ghost' FROM files WHERE p_type = 'MEDIUM'
  UNION ALL SELECT path, 0, 2, 'ghost', 'end' FROM files WHERE p_type = 'MEDIUM')"""
_TASKS = """
tasks AS (
  SELECT path, 3 AS pos, 'start' AS task, 'DummyOperator' AS operator, p_type FROM files
  UNION ALL SELECT path, 4, 'fetch', 'PythonOperator', p_type FROM files
  UNION ALL SELECT path, 4 + i, 'load_' || i, 'PostgresOperator', p_type FROM loads
  UNION ALL SELECT path, 5 + p_size, 'alone', 'CustomOperator', p_type FROM files
  UNION ALL SELECT path, 6 + p_size, 'end', 'DummyOperator', p_type FROM files)"""
_DEPS = """
ends AS (
  SELECT path, downstream AS task, upstream AS up FROM edges
  UNION ALL SELECT path, upstream, NULL FROM edges),
deps AS (
  SELECT path, task, coalesce(string_agg(up, ',' ORDER BY up), '') AS depends_on
  FROM ends GROUP BY path, task)"""
_CALL_BODY = "def call_api():\n    note = 'local'\n    print('Writing df to file system and catalogue table')"


def _text(value: str) -> str:
    """SQL literal of a text with line breaks."""
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in value.split("\n"))


@query(f"""
WITH {_FILES}
SELECT path, 0 AS pos, 'call_api' AS name, {_text(_CALL_BODY)} AS source FROM files
UNION ALL
SELECT path, 1, 'load_data', 'def load_data(self):' || chr(10) || '    return ''' || p_brand || ''''
FROM files""")
def corpus_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.functions(corpus_facts(spark, sf_dir, "function"))


_DEFAULTS = """'{"owner": "owner", "start_date": "datetime(2024, 1, 1)", "retries": ' || p_size || ', "late": null}'"""


@query(f"""
WITH {_FILES}
SELECT path, 'owner' AS name, p_brand AS value, 'str' AS kind, '<module>' AS scope, 0 AS pos, 0 AS first_pos
FROM files
UNION ALL SELECT path, 'note', 'local', 'str', 'call_api', 7 + p_size, 1 FROM files
UNION ALL SELECT path, 'default_args', {_DEFAULTS}, 'dict', '<module>', 2, 2 FROM files""")
def corpus_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last assignment of each name counts: here one inside a function."""
    return g.last_value(f.assignments(corpus_facts(spark, sf_dir, "assign")), ["path", "name"], "pos")


@query(f"WITH {_FILES}, {_TASKS} SELECT path, pos, task, operator FROM tasks")
def corpus_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.tasks(corpus_facts(spark, sf_dir, "task")).select("path", "pos", "task", "operator")


@query(f"""
WITH {_FILES}
SELECT path, 'start' AS task, unnest(['task_id', 'trigger_rule']) AS name,
       unnest(['"start"', '"none_failed"']) AS value FROM files
UNION ALL SELECT path, 'fetch', unnest(['task_id', 'python_callable', 'dag', 'retries']),
       unnest(['"fetch_task"', '"call_api"', '"dag"', CAST(p_size AS VARCHAR)]) FROM files
UNION ALL SELECT path, 'load_' || i, unnest(['task_id', 'sql', 'depth']),
       unnest(['"load"', '"select ''' || p_type || '''\\nfrom t"', NULL]) FROM loads
UNION ALL SELECT path, 'alone', unnest(['task_id', 'params', 'key']),
       unnest(['"alone"', '{{"size": ' || p_size || ', "tags": ["a", 1]}}', '"{{DATA_SETS[''k'']}}"']) FROM files
UNION ALL SELECT path, 'end', unnest(['task_id', 'flag']), unnest(['"end"', NULL]) FROM files""")
def corpus_args(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved arguments as JSON text; NULL for expressions that are no literal."""
    rows = f.tasks(corpus_facts(spark, sf_dir, "task"))
    return rows.select("path", "task", F.explode("args").alias("name", "value"))


@query(f"WITH {_FILES}, {_EDGES} SELECT * FROM edges")
def corpus_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f.edges(corpus_facts(spark, sf_dir, "chain"))


@query(f"""
WITH {_FILES}
SELECT 'parts/' || p_partkey || '.py' AS path, CAST(NULL AS INTEGER) AS pos, 'SyntaxError' AS problem
FROM part WHERE p_brand = '{_BROKEN}'
UNION ALL SELECT path, 1, 'unreadable chain in line ' || (p_size * 2 + 22) FROM files
WHERE p_type = 'MEDIUM'""")
def corpus_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that do not parse, and chains that cannot be read, as rows."""
    problem = F.split_part("error", F.lit(":"), F.lit(1)).alias("problem")
    return f.errors(corpus_facts(spark, sf_dir, "chain")).select("path", "pos", problem)


@query(f"WITH {_FILES}, {_EDGES}, {_DEPS} SELECT * FROM deps")
def depends_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    deps = g.depends_on(f.edges(corpus_facts(spark, sf_dir, "chain")))
    return deps.withColumn("depends_on", F.array_join("depends_on", ","))


_RECORDS = """
SELECT t.path, t.task, t.pos, t.operator, coalesce(d.depends_on, '') AS depends_on
FROM tasks t {how} JOIN deps d ON d.path = t.path AND d.task = t.task"""


def _records(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    rows = w.task_records(w.task_graph(corpus_facts(spark, sf_dir, "task", "chain")), how)
    return rows.drop("args").withColumn("depends_on", F.array_join("depends_on", ","))


@query(f"WITH {_FILES}, {_EDGES}, {_DEPS}, {_TASKS} {_RECORDS.format(how='LEFT')}")
def task_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "left")


@query(f"WITH {_FILES}, {_EDGES}, {_DEPS}, {_TASKS} {_RECORDS.format(how='INNER')}")
def task_records_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, "inner")


@query(f"WITH {_FILES} SELECT path, 'ghost' AS task FROM files WHERE p_type = 'MEDIUM'")
def dangling_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.dangling_tasks(w.task_graph(corpus_facts(spark, sf_dir, "task", "chain")))


_TARGET = """CASE t.operator WHEN 'PythonOperator' THEN ',"target":"jobs/call_api"'
    WHEN 'DummyOperator' THEN ',"target":"jobs/print_hello.py"'
    WHEN 'PostgresOperator' THEN ',"target":"jobs/' || t.task || '.sql"' ELSE '' END"""


@query(f"""
WITH {_FILES}, {_EDGES}, {_DEPS}, {_TASKS}, records AS ({_RECORDS.format(how="LEFT")}),
parts AS (
  SELECT t.path, t.pos,
         '{{"task_key":"' || t.task || '","run_if":"ALL_SUCCESS","timeout_seconds":0,"depends_on":['
         || CASE WHEN t.depends_on = '' THEN '' ELSE
              '{{"task_key":"' || replace(t.depends_on, ',', '"}},{{"task_key":"') || '"}}' END
         || ']' || {_TARGET} || '}}' AS js
  FROM records t)
SELECT path, '{{"name":"' || replace(replace(path, 'parts/', ''), '.py', '')
       || '","timeout_seconds":0,"max_concurrent_runs":1,"tasks":['
       || string_agg(js, ',' ORDER BY pos) || ']}}' AS spec_json
FROM parts GROUP BY path""")
def workflow_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = w.task_graph(corpus_facts(spark, sf_dir, "task", "chain"))
    return w.workflow_spec(w.task_records(graph), base="jobs/")


_ASSIGNED = (
    "'owner = ''' || p_brand || '''' || chr(10) || 'note = ''local''' || chr(10) || "
    f"'default_args = json.loads(''' || {_DEFAULTS} || ''')' || chr(10)"
)


@query(f"""
WITH {_FILES}
SELECT path, 0 AS pos, 'call_api' AS name,
       {_text(w.IMPORTS)} || {_text(w.HELPER)} || {_ASSIGNED}
       || {_text(_CALL_BODY.replace(*w.MARKERS[-1]))} || chr(10) || 'call_api()' AS rendered
FROM files
UNION ALL
SELECT path, 1, 'load_data', {_text(w.IMPORTS)} || {_ASSIGNED}
       || 'def load_data(self):' || chr(10) || '    return ''' || p_brand || '''' || chr(10) || 'load_data()'
FROM files""")
def rendered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.rendered_sources(corpus_facts(spark, sf_dir, "function", "assign"))


@query(f"""
WITH {_FILES}
SELECT path, 'owner = ''' || p_brand || '''' || chr(10) || 'note = ''' || p_name || '''' AS lines
FROM files""")
def assignment_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Module-level texts of a file as lines."""
    rows = f.assignments(corpus_facts(spark, sf_dir, "assign"), module_only=True).where("kind = 'str'")
    line = w.assignment_line(F.col("name"), F.col("value"), F.col("kind"))
    return g.join_lines(rows, ["path"], "pos", line, "lines")


@query("""
SELECT 'documents/' || doc_id AS path, 'run' AS task, '%sql' || chr(10) || text AS sql FROM documents
UNION ALL SELECT 'pages/' || page_id, 'run', '%sql' || chr(10) || html FROM pages""")
def sql_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL of SQL tasks; whole documents and web pages stand in for it."""

    def files(name: str, key: str, text: str) -> DataFrame:
        rows = dealt(table(spark, sf_dir, name).select(key, text), key, F.octet_length(text))
        code = w.assignment_line(F.lit("sql"), F.col(text), F.lit("str"))
        return rows.select(
            F.concat(F.lit(f"{name}/"), F.col(key).cast("string")).alias("path"),
            F.concat(F.lit("run = PostgresOperator(task_id='run', "), code, F.lit(")")).alias("source"),
        )

    both = files("documents", "doc_id", "text").unionByName(files("pages", "page_id", "html"))
    return w.sql_sources(w.task_records(w.task_graph(f.facts(both, ["task"]))))
