"""The conversation prefix trie against plain Python over all prefixes."""

import hashlib
import random
import zlib

import pytest

from millrace.llm import prefix_trie as module
from millrace.llm.prefix_trie import ordered_turns, prefix_trie, running
from millrace.llm.queries import rebuilt_turns

SCHEMA = "conv_id long, turn long, role string, text string, place int, chars string, depth int"


def plain(convs):
    """Sorted nodes of conversations, given as id to turns."""
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        if node:
            children.setdefault(node[:-1], []).append(node)
        under = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in under) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[x] for x in under)
    rows = []
    for node, ids in members.items():
        ended = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ended.encode()).hexdigest()
        rows.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), leaves[node], saved[node], sha))
    return sorted(rows, key=str)


def in_order(rows):
    """Turns of each conversation; of rows that share a turn any order will do, so tests have equal ones there."""
    found = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        found.setdefault(conv, []).append((role or "", text or ""))
    return found


def rebuilt(convs):
    found = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        found[c] = convs.get(base, [])[:h] + turns[h:]
    return found


def ours(spark, rows, change=False):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    turns = ordered_turns(table)
    convs = turns.select("conv_id").distinct()
    nodes = prefix_trie(rebuilt_turns(turns, convs) if change else turns, convs).drop("p1", "p2")
    assert nodes.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, nodes.collect()), key=str)


def branching(seed, n, longest, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n * 4), n):
        for t in range(rng.choice([1, 2, 3, 5, 9, longest])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,longest,words", [(1, 60, 20, ["a", "bb"]), (2, 300, 6, ["é𝄞", "", "ccc"]), (3, 40, 70, ["x"])])
def test_equals_plain_tries(spark, seed, n, longest, words):
    rows = branching(seed, n, longest, words)
    assert ours(spark, rows) == plain(in_order(rows))
    assert ours(spark, rows, change=True) == plain(rebuilt(in_order(rows)))


def test_copies_hot_turns_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(200) for t in range(7)]
    rows += [(1000 + c, t, "user", f"same {t}" if t < 3 else f"own {c} {t}") for c in range(150) for t in range(5)]
    rows += [(5000, t, "user", f"turn {t}") for t in range(3000)] + [(5100, t, "user", f"turn {t}") for t in range(2500)]
    assert ours(spark, rows) == plain(in_order(rows))
    assert ours(spark, rows, change=True) == plain(rebuilt(in_order(rows)))


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 2, None, "x"), (1, 2, None, "x"), (2, None, "", ""), (2, 5, "user", None),
            (None, 1, "user", "lost"), (-5, 0, "user", "below"), (-105, 0, "user", "further"), (-100, 1, "a", "b"), (-100, 2, "a", "b")]
    assert ours(spark, rows) == plain(in_order(rows))
    assert ours(spark, rows, change=True) == plain(rebuilt(in_order(rows)))
    assert ours(spark, []) == [] and ours(spark, rows[6:7]) == []


def test_a_conversation_without_turns_is_at_the_root(spark):
    turns = ordered_turns(spark.createDataFrame([(7, 0, "u", "t", 1, "", 2)], SCHEMA))
    convs = spark.createDataFrame([(7,), (8,), (9,)], "conv_id long")
    rows = {(r.depth, r.conv_id): r for r in prefix_trie(turns, convs).collect()}
    assert (rows[0, 7].n_convs, rows[0, 7].n_children, rows[0, 7].n_leaves) == (3, 1, 1)
    assert rows[0, 7].ends_sha256 == hashlib.sha256(b"8,9").hexdigest()
    (root,) = prefix_trie(turns.limit(0), convs).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves) == (7, 0, None, 3, 0, 1)


def test_running_sums_reach_over_ranges(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(c, t, (c * 7 + t * 13) % 11) for c in (1, 2, 2**40) for t in range(900 if c == 2 else 3)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, v long")
    found = {(r.conv_id, r.turn): r for r in running(table, ["turn"], {"total": ("sum", "v"), "mix": ("xor", "v")}, "t").collect()}
    assert len(found) == len(rows)
    for c in (1, 2, 2**40):
        total = mix = 0
        for _, t, v in sorted(r for r in rows if r[0] == c):
            total, mix = total + v, mix ^ v
            assert (found[c, t].total, found[c, t].mix) == (total, mix)


def test_ids_in_many_pieces(spark):
    rows = [(i, i % 3, i % 3, i % 3) for i in range(3000)]
    ends = spark.createDataFrame(rows, "conv_id long, depth long, p1 long, p2 long").repartition(5)
    found = {r.depth: r.sha for r in module.ends_sha256(ends).collect()}
    for d in range(3):
        assert found[d] == hashlib.sha256(",".join(str(i) for i in range(3000) if i % 3 == d).encode()).hexdigest()
