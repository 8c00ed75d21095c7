"""Pipeline source files as a table of facts.

Input is a table ``(path, source)`` with one Python file per row. `facts` reads every file
once, in Arrow batches; all that follows is relational. A file that does not parse, or a chain
that cannot be read, becomes an ``error`` row.

    kind        pos                 name       value                 other columns
    function    pre-order           name       text                  -
    assign      breadth-first       name       text, or JSON         form (str, dict), scope
    task        breadth-first       variable   operator              args
    chain       statement order     -          -                     stages
    error       -                   -          message               -
"""

from __future__ import annotations

import ast
import json
import math
import sys
import warnings
from collections import deque
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("function", "assign", "task", "chain")
FACT_SCHEMA = (
    "path string, kind string, pos int, name string, value string, form string, scope string, "
    "args map<string,string>, stages array<array<string>>"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("kind", pa.string()),
        ("pos", pa.int32()),
        ("name", pa.string()),
        ("value", pa.string()),
        ("form", pa.string()),
        ("scope", pa.string()),
        ("args", pa.map_(pa.string(), pa.string())),
        ("stages", pa.list_(pa.list_(pa.string()))),
    ]
)
_BATCH_ROWS, _BATCH_CHARS = 4096, 8 << 20
_BLOCKS = ("body", "handlers", "orelse", "finalbody", "cases")
#: The blocks of each kind of node that has some; expressions hold no statements.
_BLOCKS_OF = {
    kind: held
    for kind in vars(ast).values()
    if isinstance(kind, type) and issubclass(kind, (ast.mod, ast.stmt, ast.excepthandler, ast.match_case))
    if (held := tuple(part for part in _BLOCKS if part in kind._fields))
}
_SCOPES = frozenset({ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef})
_COMPOSED = frozenset({ast.Dict, ast.List, ast.Tuple, ast.Subscript})
_encode = json.JSONEncoder(ensure_ascii=False).encode
_encode_text = json.encoder.encode_basestring
#: A fact without its file: kind, pos, name, value, form, scope, args, stages.
Fact = tuple[str, int | None, str | None, str | None, str | None, str | None, list | None, list | None]
_UNREADABLE = (SyntaxError, ValueError, RecursionError, MemoryError)

MODULE = "<module>"

# Workers get the parse functions with the task and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def facts(
    sources: DataFrame,
    kinds: Collection[str] = KINDS,
    with_bodies: bool = True,
) -> DataFrame:
    """One fact row per function, assignment, task, chain and error of every file.

    Only the ``kinds`` asked for are made, and errors. ``with_bodies`` also reads chains inside
    ``with`` blocks. Files are parsed where the scan puts them.
    """
    wanted = frozenset(kinds)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        chars = 0
        for batch in batches:
            for path, source in zip(batch.column(0), batch.column(1), strict=True):
                file = path.as_py()
                for fact in _file_facts(source.as_py() or "", wanted, with_bodies):
                    rows.append((file, *fact))
                    chars += _chars(fact)
                    if len(rows) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
                        yield _batch(rows)
                        rows, chars = [], 0
        if rows:
            yield _batch(rows)

    return sources.select("path", "source").mapInArrow(parse, FACT_SCHEMA)


def functions(facts: DataFrame) -> DataFrame:
    return facts.where("kind = 'function'").select(
        "path", "pos", "name", F.col("value").alias("source")
    )


def assignments(facts: DataFrame, module_only: bool = False) -> DataFrame:
    """Every text or dict assignment; `last_value` keeps the one that counts."""
    rows = facts.where("kind = 'assign'")
    if module_only:
        rows = rows.where(F.col("scope") == MODULE)
    return rows.select("path", "pos", "name", "value", F.col("form").alias("kind"), "scope")


def tasks(facts: DataFrame) -> DataFrame:
    """Every task assignment; ``args`` maps argument names to JSON text."""
    return facts.where("kind = 'task'").select(
        "path", "pos", F.col("name").alias("task"), F.col("value").alias("operator"), "args"
    )


def edges(facts: DataFrame) -> DataFrame:
    """Edges of all chains: every task of a stage to every task of the next, repeats kept.

    A chain sits in one row, so this needs no shuffle.
    """
    pair = F.explode("_pairs").alias("_pair")
    return (
        facts.where("kind = 'chain'")
        .select("path", F.col("pos").alias("chain"), stage_pairs(F.col("stages")).alias("_pairs"))
        .select("path", "chain", pair)
        .select("path", "chain", "_pair.stage", "_pair.downs", F.explode("_pair.ups").alias("upstream"))
        .select("path", "chain", "stage", "upstream", F.explode("downs").alias("downstream"))
    )


def stage_pairs(stages: Column) -> Column:
    """Each stage of a chain with the one after it."""
    return F.transform(
        F.slice(stages, 1, F.size(stages) - 1),
        lambda ups, i: F.struct(
            i.alias("stage"), ups.alias("ups"), F.get(stages, i + 1).alias("downs")
        ),
    )


def errors(facts: DataFrame) -> DataFrame:
    return facts.where("kind = 'error'").select("path", "pos", F.col("value").alias("error"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _chars(fact: Fact) -> int:
    """About as many characters as the fact's texts have, those of its arguments and stages too."""
    _, _, name, value, _, _, args, stages = fact
    chars = 64 + len(name or "") + len(value or "")
    for word, text in args or ():
        chars += 16 + len(word) + len(text or "")
    for stage in stages or ():
        chars += 8 * len(stage) + sum(map(len, stage))
    return chars


def _file_facts(source: str, kinds: frozenset[str], with_bodies: bool) -> list[Fact]:
    found: list[Fact] = []
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(source)
        if "function" in kinds:
            found.extend(_function_facts(tree))
        if "assign" in kinds or "task" in kinds:
            found.extend(_assignment_facts(tree, kinds))
        if "chain" in kinds:
            found.extend(_chain_facts(tree.body, with_bodies))
    except _UNREADABLE as problem:
        return [_error(None, _text(f"{type(problem).__name__}: {problem}"))]
    return found


def _error(pos: int | None, message: str) -> Fact:
    return "error", pos, None, message, None, None, None, None


def _inner_statements(node: ast.AST) -> list[ast.AST]:
    """Statements right below a node, in source order; expressions hold none."""
    return [inner for part in _BLOCKS_OF.get(type(node), ()) for inner in getattr(node, part)]


def _function_facts(tree: ast.Module) -> Iterator[Fact]:
    waiting = _inner_statements(tree)[::-1]
    pos = 0
    while waiting:
        node = waiting.pop()
        if type(node) not in _BLOCKS_OF:
            continue
        if isinstance(node, ast.FunctionDef):
            yield "function", pos, node.name, _text(ast.unparse(node)), None, None, None, None
            pos += 1
        waiting.extend(_inner_statements(node)[::-1])


def _assignment_facts(tree: ast.Module, kinds: frozenset[str]) -> Iterator[Fact]:
    """Assignments in breadth-first order, each with the scope that holds it. Those of other kinds count too."""
    waiting = deque([(tree, MODULE)])
    pos = 0
    while waiting:
        node, scope = waiting.popleft()
        if type(node) is ast.Assign:
            for fact in _one_assignment(node, scope, pos, "task" in kinds):
                if fact[0] in kinds:
                    yield fact
                pos += 1
            continue
        if type(node) in _SCOPES:
            scope = node.name
        for inner in _inner_statements(node):
            if type(inner) is ast.Assign or type(inner) in _BLOCKS_OF:
                waiting.append((inner, scope))


def _one_assignment(node: ast.Assign, scope: str, pos: int, with_args: bool) -> list[Fact]:
    """The facts of one statement, from ``pos``. A task that is only counted needs no argument that is sure to be read."""
    value = node.value
    kind = type(value)
    if kind is ast.Call:
        if type(value.func) is not ast.Name or not value.func.id.endswith("Operator"):
            return []
        if len(node.targets) != 1 or type(node.targets[0]) is not ast.Name:
            return []
        args = [
            (word.arg, _argument(word.value))
            for word in value.keywords
            if word.arg is not None and (with_args or _may_fail(word.value))
        ]
        return [("task", pos, node.targets[0].id, value.func.id, None, scope, args, None)]
    if kind is ast.Constant and type(value.value) is str:
        text, form = _text(value.value), "str"
    elif kind is ast.Dict:
        text, form = _json(_literal(value, _source_text)), "dict"
    else:
        return []
    names = [target.id for target in node.targets if type(target) is ast.Name]
    return [("assign", nth, name, text, form, scope, None, None) for nth, name in enumerate(names, pos)]


def _argument(node: ast.expr) -> str | None:
    """JSON text of an argument; None for an expression that is no literal."""
    kind = type(node)
    if kind is ast.Constant and type(node.value) is str:
        return _text(_encode_text(node.value))
    if kind is ast.Name:
        return _text(_encode_text(node.id))
    if kind is ast.Constant or kind in _COMPOSED:
        return _json(_literal(node, lambda _: None))
    return None


def _may_fail(node: ast.expr) -> bool:
    """Whether `_argument` could meet what JSON cannot hold."""
    kind = type(node)
    return kind in _COMPOSED or kind is ast.Constant and type(node.value) is int


def _chain_facts(body: list[ast.stmt], with_bodies: bool) -> Iterator[Fact]:
    waiting = body[::-1]
    pos = 0
    while waiting:
        statement = waiting.pop()
        if with_bodies and isinstance(statement, (ast.With, ast.AsyncWith)):
            waiting.extend(statement.body[::-1])
        if not (isinstance(statement, ast.Expr) and isinstance(statement.value, ast.BinOp)):
            continue
        if not isinstance(statement.value.op, ast.RShift):
            continue
        stages = _chain_stages(statement.value)
        if stages is None:
            yield _error(pos, f"unreadable chain in line {statement.lineno}")
        else:
            yield "chain", pos, None, None, None, None, None, stages
        pos += 1


def _chain_stages(node: ast.expr) -> list[list[str]] | None:
    """Stages of ``a >> [b, c] >> d`` from left to right; None if an operand is no task list."""
    operands: list[ast.expr] = []
    while isinstance(node, ast.BinOp) and isinstance(node.op, ast.RShift):
        operands.append(node.right)
        node = node.left
    operands.append(node)
    stages = []
    for operand in reversed(operands):
        items = operand.elts if isinstance(operand, ast.List) else [operand]
        if not all(isinstance(item, ast.Name) for item in items):
            return None
        stages.append([item.id for item in items])
    return stages


def _literal(node: ast.expr | None, otherwise: Callable[[ast.expr | None], object]) -> object:
    """JSON value of a literal; ``otherwise`` decides on every other expression."""
    match node:
        case ast.Constant(value=value):
            plain = isinstance(value, (str, int)) and not isinstance(value, bool)
            finite = isinstance(value, float) and math.isfinite(value)
            return value if plain or finite else otherwise(node)
        case ast.Name(id=name):
            return name
        case ast.Dict(keys=keys, values=values):
            pairs = zip(keys, values, strict=True)
            return {_key(_literal(k, otherwise)): _literal(v, otherwise) for k, v in pairs}
        case ast.List(elts=items) | ast.Tuple(elts=items):
            return [_literal(item, otherwise) for item in items]
        case ast.Subscript(value=ast.Name(id="DATA_SETS"), slice=ast.Constant(value=str() as key)):
            return f"{{DATA_SETS['{key}']}}"
        case _:
            return otherwise(node)


def _source_text(node: ast.expr | None) -> object:
    """Truth values and None as themselves, any other expression as its source text."""
    if node is None:
        return None
    if isinstance(node, ast.Constant) and (node.value is None or isinstance(node.value, bool)):
        return node.value
    return ast.unparse(node)


def _key(value: object) -> str:
    return value if isinstance(value, str) else json.dumps(value)


def _json(value: object) -> str | None:
    return None if value is None else _text(_encode(value))


def _text(text: str) -> str:
    """Text that UTF-8 can hold: lone surrogates as escapes."""
    return text if text.isascii() else text.encode("utf-8", "backslashreplace").decode("utf-8")
