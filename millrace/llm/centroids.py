"""Centroid clustering over integer vectors with heap-ordered bounds.

Every vector carries an upper bound of the distance to its centroid and a lower bound of that to all others;
their gap, lower minus upper, says how far centroids may move before it could change sides. Each cluster keeps
a heap of its vectors by gap. As centroids move, the cluster's offset grows by its own drift and the largest of
the others', and gaps are stored with the offset of their time added: an entry expires once the offset has
reached it, and no other entry needs a look. Only vectors that expire are popped and compared with all
centroids again; they go back in with a new gap, and their moves change the exact sums of clusters.

A heap is a set of runs, one from each round, written in the order of cluster and gap and never changed. What
expires in a round is a range of each run: gaps from the cluster's offset before the round to that after it.
Readers skip the rest of a run by its statistics, and an entry needs no mark that it is gone, since it expires
in one round only. Nothing of the size of the data is held by the driver or sent to every task: there are
``k`` centroids, offsets and sums.

Squared distances and sums are exact integers. Bounds are floating-point numbers with a margin wider than their
rounding, and equal distances always expire, so the nearest centroid with the smallest number is found in all
cases.

Vectors of another length, and those with a null, infinite or missing component, are left out. Repeated rows
are a vector each. A null ``vec_id`` is hashed as empty decimals; among equal hashes the smaller vector is the
earlier centroid. With fewer vectors than ``k`` there are as many centroids as vectors. An empty table gives
no rows. Integers beyond ``LARGEST`` would not leave room for a distance and raise an error. Of the input only
``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package
from millrace.session import work_path

#: Most that a component's integer may be, so that squared distances of 4096 components fit in a long.
LARGEST = 1 << 24
#: Up to here sums of squares are exact in floating-point numbers.
EXACT = 1 << 52
MEASURED = "vec_id bigint, cluster int, distance bigint"
ENTRIES = "vec_id bigint, vec array<int>, old int, cluster int, gap double"
#: Share of a bound that covers all rounding in it.
MARGIN = 1e-9
#: Vectors compared with all centroids at once.
BLOCK = 8192


@dataclass(frozen=True)
class Clustering:
    """``k`` centroids, moved ``rounds`` times, over vectors of ``dims`` components taken ``scale`` fold."""

    k: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256
    seed: int = 2


@dataclass(frozen=True)
class State:
    """Centroids of a round, their offsets and, for the next ones, the sums and sizes of clusters."""

    centroids: np.ndarray
    offsets: np.ndarray
    sums: list[list[int]]
    sizes: list[int]


def vectors(table: DataFrame, how: Clustering) -> DataFrame:
    """``vec_id`` and ``vec``, the integers of the vectors that count."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(how.scale) * x.cast("double")))
    whole = (F.size("embedding") == how.dims) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    fits = F.forall("vec", lambda x: F.abs(x) <= LARGEST)
    checked = F.when(fits, F.col("vec").cast("array<int>")).otherwise(F.raise_error(F.lit("component out of range")))
    kept = table.select(F.col("vec_id").cast("bigint"), "embedding").where(whole)
    return kept.select("vec_id", scaled.alias("vec")).select("vec_id", checked.alias("vec"))


def first_centroids(found: DataFrame, how: Clustering) -> np.ndarray:
    """The vectors with the smallest hashes of their ids."""
    name = F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = found.orderBy(F.sha2(name.cast("binary"), 256), "vec").limit(how.k).select("vec").collect()
    return np.array([r.vec for r in rows], dtype=np.int64).reshape(len(rows), how.dims)


def squared_distances(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector and centroid."""
    most = max(int(np.abs(vecs).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    if 4 * most * most * vecs.shape[1] < EXACT:
        v, c = vecs.astype(np.float64), centroids.astype(np.float64)
        found = (v * v).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (v @ c.T)
        return found.astype(np.int64)
    return np.stack([((vecs - c) ** 2).sum(1) for c in centroids], axis=1)


def nearest(vecs: np.ndarray, state: State) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smallest of equals, and the gap to store for it."""
    squared = squared_distances(vecs, state.centroids)
    cluster = squared.argmin(1)
    rows = np.arange(len(vecs))
    upper = np.sqrt(squared[rows, cluster].astype(np.float64))
    squared[rows, cluster] = np.iinfo(np.int64).max
    lower = np.sqrt(squared.min(1).astype(np.float64))
    offset = state.offsets[cluster]
    # Rounded down by more than all the rounding in it, so an entry never stays too long.
    return cluster.astype(np.int32), lower - upper - MARGIN * (1 + lower + upper + offset) + offset


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _run(found: DataFrame, state: State, how: Clustering, old: str, path: str) -> DataFrame:
    """Compares the vectors of ``found`` with all centroids and writes them as a run."""
    spark = found.sparkSession

    def scan(batches: Iterator) -> Iterator:
        from millrace.llm.centroids import BLOCK, nearest

        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK):
                part = batch.slice(first, BLOCK)
                cluster, gap = nearest(_matrix(part.column("vec"), how.dims), state)
                columns = [part.column("vec_id"), part.column("vec"), part.column("old"), pa.array(cluster), pa.array(gap)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "vec", "old", "cluster", "gap"])

    ship_package(spark)
    scanned = found.select("vec_id", "vec", F.expr(old).cast("int").alias("old")).mapInArrow(scan, ENTRIES)
    scanned.sortWithinPartitions("cluster", "gap").write.parquet(path)
    return spark.read.schema(ENTRIES).parquet(path)


def _moved(run: DataFrame, state: State, how: Clustering) -> State:
    """The state with the sums and sizes that the moves of a run leave."""
    schema = "cluster int, place int, amount bigint"

    def add_up(batches: Iterator) -> Iterator:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            vecs = _matrix(batch.column("vec"), how.dims)
            # One component more counts the vectors.
            vecs = np.concatenate([vecs, np.ones((len(vecs), 1), np.int64)], axis=1)
            for name, sign in (("cluster", 1), ("old", -1)):
                clusters = batch.column(name).fill_null(-1).to_numpy(zero_copy_only=False)
                for cluster in np.unique(clusters[clusters >= 0]).tolist():
                    total = sums.setdefault(cluster, np.zeros(how.dims + 1, np.int64))
                    total += sign * vecs[clusters == cluster].sum(0)
        for cluster, total in sums.items():
            arrays = [np.full(len(total), cluster, np.int32), np.arange(len(total), dtype=np.int32), total]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["cluster", "place", "amount"])

    changed = run.where("old is null or old <> cluster").mapInArrow(add_up, schema)
    # At most k times dims + 1 rows.
    amounts = changed.groupBy("cluster", "place").agg(F.sum("amount").alias("amount")).collect()
    sums, sizes = [list(x) for x in state.sums], list(state.sizes)
    for r in amounts:
        if r.place == how.dims:
            sizes[r.cluster] += r.amount
        else:
            sums[r.cluster][r.place] += r.amount
    return State(state.centroids, state.offsets, sums, sizes)


def _next(state: State) -> State:
    """Centroids at the floor of their means, and offsets grown by the bounds' loss."""
    rows = zip(state.sums, state.sizes, state.centroids.tolist())
    centroids = np.array([[x // n for x in total] if n else c for total, n, c in rows], dtype=np.int64)
    drift = np.sqrt(((centroids - state.centroids) ** 2).sum(1).astype(np.float64))
    others = np.array([np.delete(drift, j).max(initial=0.0) for j in range(len(drift))])
    return State(centroids, state.offsets + (drift + others) * (1 + MARGIN), state.sums, state.sizes)


def _expired(run: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The entries of a run whose gaps the offsets have passed since ``before``."""
    ranges = [
        (F.col("cluster") == j) & (F.col("gap") >= F.lit(float(a))) & (F.col("gap") < F.lit(float(b)))
        for j, (a, b) in enumerate(zip(before, after))
        if a < b
    ]
    return run.where(_any(ranges))


def _any(conditions: list[Column]) -> Column:
    while len(conditions) > 1:
        conditions = [a | b for a, b in zip(conditions[::2], [*conditions[1::2], F.lit(False)])]
    return conditions[0] if conditions else F.lit(False)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def assignments(table: DataFrame, how: Clustering = Clustering()) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` (squared) of each vector that counts, and the final centroids."""
    spark: SparkSession = table.sparkSession
    found = vectors(table, how)
    first = first_centroids(found, how)
    k = len(first)
    if not k:
        return spark.createDataFrame([], MEASURED), first
    folder = work_path(spark, "centroids")
    state = State(first, np.zeros(k), [[0] * how.dims for _ in range(k)], [0] * k)
    runs = [_run(found, state, how, "null", f"{folder}/0")]
    for number in range(1, how.rounds + 1):
        # A new run may hold gaps below its own offset; those expire first.
        befores = [state.offsets] * (number - 1) + [np.full(k, -np.inf)]
        state = _next(_moved(runs[-1], state, how))
        popped = _union([_expired(run, before, state.offsets) for run, before in zip(runs, befores)])
        runs.append(_run(popped, state, how, "cluster", f"{folder}/{number}"))
    ends = [state.offsets] * how.rounds + [np.full(k, -np.inf)]
    left = _union([_expired(run, end, np.full(k, np.inf)) for run, end in zip(runs, ends)])
    _measured(left, state, how).write.parquet(f"{folder}/measured")
    return spark.read.schema(MEASURED).parquet(f"{folder}/measured"), state.centroids


def _measured(entries: DataFrame, state: State, how: Clustering) -> DataFrame:
    """Each vector's squared distance to the centroid of its cluster."""

    def measure(batches: Iterator) -> Iterator:
        for batch in batches:
            clusters = batch.column("cluster").to_numpy()
            found = ((_matrix(batch.column("vec"), how.dims) - state.centroids[clusters]) ** 2).sum(1)
            columns = [batch.column("vec_id"), batch.column("cluster"), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    ship_package(entries.sparkSession)
    return entries.select("vec_id", "vec", "cluster").mapInArrow(measure, MEASURED)


def clustered(table: DataFrame, how: Clustering = Clustering()) -> DataFrame:
    """Per vector that counts: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia``
    (distances summed over its cluster and over all) and ``centroid_sha256``, of its centroid's decimals."""
    spark = table.sparkSession
    found, centroids = assignments(table, how)
    # One row per centroid.
    sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(j, sums.get(j, 0), sum(sums.values()), sha) for j, sha in enumerate(shas)]
    names = "_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    by_cluster = F.broadcast(spark.createDataFrame(rows, names))
    return found.join(by_cluster, F.col("cluster") == F.col("_cluster")).drop("_cluster")
