"""What the join moves and leaves behind: sketches by size, scratch storage, features settled by one group."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import part_enum
from millrace.session import shared_dir


def texts(n: int, changed: list[int]) -> dict[int, str]:
    """Texts of ``n`` words; each differs from the first in as many as said, in places of its own."""
    base = [f"w{i}" for i in range(n)]
    found = {}
    for k, most in enumerate(changed):
        words = list(base)
        for i in range(most):
            words[(i * n) // max(most, 1)] = f"v{k}x{i}"
        found[k] = " ".join(words)
    return found


@pytest.mark.parametrize("n", [0, 1, 1024, 1025, 5000, 200_000])
def test_sketches_bound_the_distance(n):
    draw = np.random.default_rng(n)
    x = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
    y = np.unique(np.concatenate([x[: n // 2], draw.integers(0, 1 << 63, n // 3, dtype=np.uint64)]))
    a, b = part_enum.sketch(x), part_enum.sketch(y)
    assert 1024 <= 64 * len(a) <= 1 << 16
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    apart = len(np.setxor1d(x, y))
    assert int(np.bitwise_count((a ^ b).view(np.uint64)).sum()) <= apart


def test_large_sets_that_differ_are_told_apart_by_sketches(spark, monkeypatch):
    """A sketch of 1024 bits lets all pairs of these through."""
    close = []
    plain = part_enum._stored

    def seen(df, name):
        found = plain(df, name)
        if name == "part-enum-close":
            close.extend((r.x, r.p) for r in found.collect())
        return found

    monkeypatch.setattr(part_enum, "_stored", seen)
    rows = texts(4000, [0, 20, 600, 600, 600, 600])
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in part_enum.grouped(docs, part_enum.Join()).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5}
    rows = docs.select("doc_id", "text")
    sets = part_enum._sets(rows, part_enum.Join()).withColumn("cid", F.col("doc_id"))
    pairs = spark.createDataFrame([(0, i) for i in range(1, 6)], "x long, p long")
    assert [(r.x, r.p) for r in part_enum._close(pairs, sets, part_enum.Join()).collect()] == [(0, 1)]
    assert len(set(close)) <= 1


def test_sets_around_a_longer_sketch_link(spark):
    words = [f"w{i}" for i in range(1200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:1010])), (3, " ".join(words[:700]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in part_enum.grouped(docs, part_enum.Join()).collect()}
    assert found == {1: 1, 2: 1, 3: 3}


def test_sketches_more_than_one_length_apart_prove_nothing(spark):
    how = part_enum.Join(percent=10)
    words = [f"w{i}" for i in range(9000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:1100]))], "doc_id long, text string")
    sets = part_enum._sets(docs, how).withColumn("cid", F.col("doc_id"))
    pairs = spark.createDataFrame([(1, 2)], "x long, p long")
    assert part_enum._close(pairs, sets, how).count() == part_enum._links(pairs, sets, how).count() == 1


@pytest.mark.parametrize("few", [500_000, 1])
def test_nothing_but_the_groups_stays(spark, few):
    place = f"{shared_dir(spark).removeprefix('file:')}/millrace"
    before = set(os.listdir(place)) if os.path.isdir(place) else set()
    rows = list(texts(60, [0, 0, 1, 30, 31]).items()) + [(9, None), (1, texts(60, [0])[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    how = part_enum.Join(broadcast_rows=few)
    assert {(r.doc_id, r.component_id) for r in part_enum.grouped(docs, how).collect()} == {
        (0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (9, 9),
    }
    assert sorted(r.doc_id for r in part_enum.one_of_each(docs, how).collect()) == [0, 3, 4, 9]
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(place)) - before}
    assert left == {"part-enum-groups", "part-enum-special"}
