"""N-gram Jaccard join by PartEnum signatures, and the groups its links make.

Sets of word shingles link when their Jaccard similarity reaches ``percent``. That is a bound on their
Hamming distance: ``|x ^ y| * (100 + percent) <= (100 - percent) * (|x| + |y|)``. Within a band of
sizes the bound is a number k, and PartEnum turns it into equality: the feature domain is cut into n1
parts by a hash, so some part differs in at most k2 = 1 places; each part is cut again into n2, and of
those some n2 - 1 agree whole. Sets project on every such choice; one projection they share is certain.
A projection without any feature says nothing and is left out. n1 is a little larger than needed, so several
parts agree, and one of them has a projection that both sets have, unless both are thin: have as many parts with
an empty projection as agree.

A signature's sets are not compared pair by pair: each is compared with the signature's pivot, the set with
most copies. Most of those comparisons end early: by the two sizes, or by a parity sketch, which differs in no
more bits than the sets do in features. A sketch has 1024 bits or, for larger sets, as many as features: fewer
would tell nothing where the distance allowed comes near them. The rest is exact. That joins most groups. A pair can be
missing only if both sets are thin, or if it shares a signature, and so a pivot, with a third set, and the sets
that share that pivot are not one group yet. Those go by the least parts there are, single features: of sets that link, the first few in
any one order have one in common (`largest_partners`). The order is by how often a feature occurs among them, counted in a
table of fixed size, so sets of one template that differ too much have features of their own first and do not
meet. Of the sets that have a first feature in common each is compared with a pivot drawn from them, and then the
pairs that still lie in different groups are, where sizes and places allow. No link between groups is lost.

Equal sets are one class from the start, by a 128-bit sum of hashes of the set, and only classes are joined.
Shingles are compared by a 64-bit hash. Sets are made once and stored; what is stored on the way goes when the
groups are stored.

Null, empty and blank texts have no set and link with nothing. Rows that share a ``doc_id`` and differ in
text are a document each, linked by its own text, and named by the same id. Repeated rows are kept.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.arrow import batches_of
from millrace.llm.components import components
from millrace.llm.ship import ship_package
from millrace.llm.text import lower_ascii, settled, text_key, without_texts, words
from millrace.session import delete_path, work_path

#: Seeds of the hashes that cut the feature domain, and of those of shingles, sets and sketches.
FIRST, SHINGLE, SET, SKETCH = 11, 51, 61, 71
#: Least and most bits of a parity sketch; buckets in which features are counted.
BITS, MOST_BITS, BUCKETS = 1024, 1 << 16, 1 << 18
#: Bytes of words or features that a Python task gets at once. Executors hold several such batches for each task, outside their heap.
BATCH_BYTES = 4 << 20
SETS = (
    "doc_id bigint, text1 bigint, text2 bigint, n bigint, key1 bigint, key2 bigint, features array<bigint>, sketch array<bigint>, thin boolean"
)


#: The folder of `_scratch`.
_WITHIN: ContextVar[str | None] = ContextVar("part-enum", default=None)


@dataclass(frozen=True)
class Join:
    """``shingle`` words make a feature; sets link from ``percent`` up. ``cuts`` is n2. Bands of set
    sizes begin at powers of ``band``; the largest set in use has ``band ** bands`` features.
    ``broadcast_rows``: most rows of ids that go to every task, up to 32 bytes each. ``late_rounds``: how often
    pivots are drawn anew for sets that may still lack a link, before those left meet pair by pair."""

    shingle: int = 5
    percent: int = 80
    cuts: int = 2
    band: float = 1.5
    bands: int = 64
    broadcast_rows: int = 500_000
    late_rounds: int = 1

    def starts(self) -> list[int]:
        """Smallest size of each band."""
        starts = [1]
        while len(starts) < self.bands:
            starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * self.band)))
        return starts

    def distance(self, sizes: int) -> int:
        """How many features sets that link may differ in, for the sum of their sizes."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def parts(self) -> list[tuple[int, int]]:
        """n1 of each band, and how many parts at least differ in one place at most between sets that
        link; 0 where only equal sets can link."""
        ends = [start - 1 for start in self.starts()[1:]]
        most = [self.distance(2 * end) for end in ends]
        return [(k // 2 + 1 + k // 16, 1 + k // 16) if k else (0, 0) for k in most] + [(0, 0)]


def shingle_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each ``size`` consecutive values, in order."""
    n = len(hashes) - size + 1
    found = np.full(max(n, 0), SHINGLE + seed, dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        found = _mix(found ^ hashes[k : k + n], SHINGLE + k)
    return found


def _sets(docs: DataFrame, how: Join) -> DataFrame:
    """Per row of ``docs`` its set, its size, key and sketch, and a ``number``; stored."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.part_enum import SET, _mix, is_thin, shingle_hashes, sketch

        # A few texts at a time, so that what numpy holds beside a batch stays small.
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            column = batch.column("words")
            flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).tolist()
            whole = shingle_hashes(flat, how.shingle)
            sets, keys, sketches = [], [], []
            for a, b in zip(ends, ends[1:]):
                few = b - a < how.shingle
                # A text of fewer words is one shingle, another than any of full length.
                found = shingle_hashes(flat[a:b], b - a, b - a) if few and b > a else whole[a : max(a, b - how.shingle + 1)]
                found = np.unique(found)
                sets.append(found)
                keys.append([_mix(found, SET + k).sum(dtype=np.uint64) for k in (0, 1)])
                sketches.append(sketch(found))
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
            places = np.concatenate([[0], np.cumsum([len(x) for x in sketches])]).astype(np.int32)
            bits = np.concatenate([np.zeros(0, np.int64), *sketches])
            key_columns = np.array(keys, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "text1", "text2")),
                    pa.array(sizes),
                    *(pa.array(np.ascontiguousarray(key_columns[:, k])) for k in (0, 1)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(bits)),
                    pa.array([is_thin(x, how) for x in sets], pa.bool_()),
                ],
                names=["doc_id", "text1", "text2", "n", "key1", "key2", "features", "sketch", "thin"],
            )

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), *text_key(), "text")
    split = settled(words(lower_ascii(F.coalesce("text", F.lit("")))))
    hashed = rows.withColumn("words", split).drop("text")
    hashed = hashed.withColumn("words", F.transform("words", lambda w: F.xxhash64(w)))
    found = hashed.mapInArrow(run, SETS).withColumn("number", F.monotonically_increasing_id())
    return _stored(found, "part-enum-sets")


def sketch(features: np.ndarray) -> np.ndarray:
    """The parity sketch of a set: a power of two of bits. Its halves laid over each other are the next shorter one."""
    bits = min(MOST_BITS, max(BITS, 1 << max(len(features) - 1, 0).bit_length()))
    odd = np.bincount((_mix(features, SKETCH) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _mix(x: np.ndarray | int, seed: int) -> np.ndarray:
    """A 64-bit hash of 64-bit values."""
    x = np.asarray(x, dtype=np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _projections(features: np.ndarray, parts: int, cuts: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each part and cut left out of it, and whether the projection has no feature.

    A projection's hash is a sum over its features: that of the part less that of the cut.
    """
    place = (_mix(features, seed) % np.uint64(parts * cuts)).astype(np.int64)
    counts = np.bincount(place, minlength=parts * cuts).reshape(parts, cuts)
    order = np.argsort(place, kind="stable")
    # All unsigned: next to signed numbers numpy would go on in floating point and round.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(features, seed + 1)[order], dtype=np.uint64)])
    ends = np.concatenate([[0], np.cumsum(counts.ravel())])
    by_cut = (sums[ends[1:]] - sums[ends[:-1]]).reshape(parts, cuts)
    rest = by_cut.sum(axis=1, dtype=np.uint64)[:, None] - by_cut
    empty = counts.sum(axis=1)[:, None] == counts
    tags = _mix(np.arange(parts * cuts), seed + 2)
    return _mix(rest.ravel() ^ tags, seed + 3), empty.ravel()


def _bands(n: int, how: Join) -> list[int]:
    """The band of a set of n features, and the one above if it may hold partners."""
    starts = how.starts()
    own = max((i for i, start in enumerate(starts) if start <= n), default=None)
    if own is None:
        return []
    above = own + 1 < len(starts) and starts[own + 1] <= n * 100 // how.percent
    return [own, own + 1] if above else [own]


def signatures(features: np.ndarray, how: Join) -> tuple[np.ndarray, bool]:
    """The signatures of a set, none if only an equal set can link with it, and whether it is too thin for its cut:
    as many parts as agree with a set that links may have an empty projection, which is no signature."""
    found, thin = [], False
    features = features.astype(np.uint64)
    for band in _bands(len(features), how):
        parts, alike = how.parts()[band]
        if not parts:
            continue
        hashes, empty = _projections(features, parts, how.cuts, FIRST)
        thin = thin or bool(empty.reshape(parts, how.cuts).any(axis=1).sum() >= alike)
        found.append(_mix(hashes[~empty], 100 + band))
    return (np.unique(np.concatenate(found)).astype(np.int64) if found else np.zeros(0, np.int64)), thin


def is_thin(features: np.ndarray, how: Join) -> bool:
    """Whether a set is too thin for its cut, see `signatures`."""
    for band in _bands(len(features), how):
        parts, alike = how.parts()[band]
        cells = parts * how.cuts
        # A projection on all cells of a part but one is empty if the part has features in that cell only.
        counts = np.bincount((_mix(features, FIRST) % np.uint64(max(cells, 1))).astype(np.int64), minlength=cells)
        counts = counts.reshape(parts, how.cuts) if parts else counts
        if parts and (counts.sum(axis=1)[:, None] == counts).any(axis=1).sum() >= alike:
            return True
    return False


def with_signatures(sets: DataFrame, how: Join) -> DataFrame:
    """``cid`` and ``signature``, one row for each, of ``sets`` (``cid``, ``features``)."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.part_enum import signatures

        for batch in batches:
            cids, column = batch.column("cid").to_numpy(), batch.column("features")
            # A few sets at a time, so what goes back is no larger than what came.
            for first in range(0, batch.num_rows, 200):
                lists = [signatures(x.values.to_numpy(zero_copy_only=False), how)[0] for x in column[first : first + 200]]
                repeated = np.repeat(cids[first : first + 200], [len(x) for x in lists])
                flat = np.concatenate([np.zeros(0, np.int64), *lists])
                yield pa.RecordBatch.from_arrays([pa.array(repeated), pa.array(flat)], names=["cid", "signature"])

    ship_package(sets.sparkSession)
    return sets.select("cid", "features").mapInArrow(run, "cid bigint, signature bigint")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder, within that of `_scratch`, and read again."""
    spark: SparkSession = df.sparkSession
    path = f"{within}/{name}-{uuid.uuid4().hex}" if (within := _WITHIN.get()) else work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored beside the folder of `_scratch`, to stay."""
    before = _WITHIN.set(None)
    try:
        return _stored(df, name)
    finally:
        _WITHIN.reset(before)


@contextmanager
def _scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored meanwhile goes at the end; sets meet Python in small batches."""
    folder = work_path(spark, "part-enum")
    before = _WITHIN.set(folder)
    try:
        with batches_of(spark, BATCH_BYTES):
            yield
    finally:
        _WITHIN.reset(before)
        delete_path(spark, folder)


def _small(df: DataFrame, how: Join) -> DataFrame:
    """``df``, to be sent to every task if a count shows that it may be."""
    return F.broadcast(df) if df.limit(how.broadcast_rows + 1).count() <= how.broadcast_rows else df


def _classes(sets: DataFrame) -> DataFrame:
    """One row per distinct set: ``cid``, ``first`` (its smallest ``doc_id`` and the text it has there), ``number``
    of a row with that text, ``n`` and the key.

    ``cid`` falls with the number of copies, by powers of two, so the smallest of some classes is one
    with many copies.
    """
    # Rows without an id come last, so a class has one of them as its first only if all are such.
    text = [F.col("doc_id").isNull().alias("none"), "doc_id", "text1", "text2"]
    least = F.min(F.struct(*text, "number")).alias("least")
    merged = sets.where("n > 0").groupBy("key1", "key2", "n").agg(least, F.count("*").alias("copies"))
    rank = (63 - F.floor(F.log2("copies"))).cast("bigint")
    cid = F.shiftleft(rank, 57) + F.monotonically_increasing_id()
    first = F.struct(*[F.col(f"least.{c}").alias(c) for c in ("none", "doc_id", "text1", "text2")])
    return merged.select(cid.alias("cid"), first.alias("first"), "least.number", "n", "key1", "key2")


def _to_pivots(dealt: DataFrame) -> DataFrame:
    """Pairs of a class ``x`` and the pivot ``p`` of a signature that it has, and whether ``more`` classes have one
    such signature."""
    # The filters that the join implies, so that both uses read one exchange; signatures are the most rows there are.
    dealt = dealt.where("signature is not null and cid is not null").repartition("signature")
    groups = dealt.groupBy("signature").agg(F.min("cid").alias("p"), F.count("*").alias("size"))
    pivots = groups.where("size > 1").select("signature", "p", (F.col("size") > 2).alias("more"))
    met = dealt.join(pivots.hint("merge"), "signature").where("cid <> p")
    return met.groupBy(F.col("cid").alias("x"), "p").agg(F.max("more").alias("more"))


def _possible(a: str, b: str, how: Join) -> Column:
    """Whether different sets of these sizes can link."""
    common = F.least(a, b) - (F.col(a) == F.col(b)).cast("bigint")
    return common * 100 >= (F.col(a) + F.col(b) - common) * how.percent


def _near(sizes: Column, distance: Column, how: Join) -> Column:
    return distance * (100 + how.percent) <= sizes * (100 - how.percent)


def _folded(bits: Column, other: Column) -> Column:
    """A sketch as long as ``other``, if that is shorter: sizes that can link are less than twice each other."""
    half = F.size(other)
    folded = F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(bits) == 2 * half, folded).otherwise(bits)


def _close(pairs: DataFrame, sets: DataFrame, how: Join) -> DataFrame:
    """The ``pairs`` (``x`` and ``p``) that sizes and sketches allow to link."""
    sx = sets.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
    sp = sets.select(F.col("cid").alias("p"), F.col("n").alias("np"), F.col("sketch").alias("sp"))
    both = pairs.select("x", "p").join(sx, "x").join(sp, "p").where(_possible("nx", "np", how))
    folded = [_folded(F.col("sx"), F.col("sp")), _folded(F.col("sp"), F.col("sx"))]
    both = both.select("x", "p", "nx", "np", *[settled(f).alias(name) for f, name in zip(folded, ("sx", "sp"))])
    differ = F.zip_with("sx", "sp", lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("bigint"))
    least = F.aggregate(differ, F.lit(0).cast("bigint"), lambda total, n: total + n)
    # Unknown for sketches of other lengths, which only a low ``percent`` lets meet.
    return both.where(F.coalesce(_near(F.col("nx") + F.col("np"), least, how), F.lit(True))).select("x", "p")


def _links(pairs: DataFrame, sets: DataFrame, how: Join) -> DataFrame:
    """Those of ``pairs`` that link, by sizes, sketches and then the exact size of their overlap."""
    close = _stored(_close(pairs, sets.select("cid", "n", "sketch"), how), "part-enum-close")
    # The features of x are dealt out once, to those of p.
    x = sets.select(F.col("cid").alias("x"), F.col("features").alias("fx")).join(_small(close, how), "x")
    p = sets.select(F.col("cid").alias("p"), F.col("features").alias("fp"))
    p = p.join(_small(close.select("p").distinct(), how), "p", "left_semi")
    sizes = (F.size("fx") + F.size("fp")).cast("bigint")
    distance = sizes - 2 * F.size(F.array_intersect("fx", "fp"))
    return _stored(x.join(p, "p").where(_near(sizes, distance, how)).select("x", "p"), "part-enum-links")


def largest_partners(n: int, how: Join) -> np.ndarray:
    """Of a set's n features in any one order, for each of the first ones the largest set that it can link with if
    this is their first feature in common; as long as that is a size it can link with at all.

    Sets of n and m features that link have at least ``percent * (n + m) / (100 + percent)`` in common, all from
    the first common one on.
    """
    left = np.arange(n, 0, -1, dtype=np.int64)
    most = (100 + how.percent) * left // how.percent - n
    return most[100 * most >= how.percent * n]


def _feature_counts(sets: DataFrame) -> np.ndarray:
    """How often features fall in each bucket: a table of fixed size."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.part_enum import BUCKETS

        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            counts += np.bincount((flat % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        buckets = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(counts[buckets])], names=["bucket", "n"])

    rows = sets.select("features").mapInArrow(run, "bucket bigint, n bigint")
    table = np.zeros(BUCKETS, dtype=np.int64)
    # At most one row for each bucket.
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return np.minimum(table, np.iinfo(np.int32).max).astype(np.int32)


def _firsts(sets: DataFrame, how: Join) -> DataFrame:
    """The first features of ``sets`` (``cid``, ``n``, ``features``) in order of rarity, with the size of partners that
    each is good for, ``most``."""
    ship_package(sets.sparkSession)
    counts = sets.sparkSession.sparkContext.broadcast(_feature_counts(sets))

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.part_enum import BUCKETS, largest_partners

        table = counts.value
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            found = []
            for cid, n, column in zip(batch.column("cid").to_pylist(), batch.column("n").to_pylist(), batch.column("features")):
                features = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
                order = np.lexsort((features, table[(features % np.uint64(BUCKETS)).astype(np.int64)]))
                most = largest_partners(n, how)
                first = features[order[: len(most)]].view(np.int64)
                found.append([np.full(len(first), cid), np.full(len(first), n), most, first])
            if found:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(columns, names=["cid", "n", "most", "feature"])

    found = sets.select("cid", "n", "features").mapInArrow(run, "cid bigint, n bigint, most bigint, feature bigint")
    return _stored(found, "part-enum-firsts")


def _apart(firsts: DataFrame, roots: DataFrame, how: Join) -> DataFrame:
    """``firsts`` with the ``root`` of each set, where sets of several groups have the feature and some may link."""
    rooted = firsts.join(_small(roots, how), "cid").where("feature is not null").repartition("feature")
    # From all columns, so that both uses read one exchange.
    least = [F.min(name).alias(f"least_{name}") for name in ("root", "cid", "n")]
    largest = [F.max(name).alias(f"largest_{name}") for name in ("root", "cid", "most")]
    spans = rooted.groupBy("feature").agg(*least, *largest)
    spans = spans.where("least_root < largest_root and least_cid < largest_cid and least_n <= largest_most")
    return rooted.join(spans.select("feature").hint("merge"), "feature")


def _late_pivots(apart: DataFrame, nth: int) -> DataFrame:
    """Distinct pairs of a set and the pivot of a first feature that it has, another one each time."""
    drawn = F.min(F.struct(F.xxhash64("cid", "feature", F.lit(nth)).alias("draw"), F.col("cid").alias("p"), F.col("root").alias("rp")))
    pivots = apart.groupBy("feature").agg(drawn.alias("drawn")).select("feature", "drawn.p", "drawn.rp")
    met = apart.join(pivots, "feature").where("root <> rp")
    return met.select(F.least("cid", "p").alias("x"), F.greatest("cid", "p").alias("p")).distinct()


def _meetings(apart: DataFrame, how: Join) -> DataFrame:
    """Distinct pairs ``x`` and ``p`` of sets of different groups with one of their first features in common, at
    places in their orders after which enough can follow for their sizes to link."""
    a = apart.select("feature", F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("root").alias("rx"), F.col("most").alias("mx"))
    b = apart.select("feature", F.col("cid").alias("p"), F.col("n").alias("np"), F.col("root").alias("rp"), F.col("most").alias("mp"))
    pairs = a.join(b, "feature").where("(nx < np or nx = np and x < p) and rx <> rp and np <= mx and nx <= mp")
    return pairs.where(_possible("nx", "np", how)).select("x", "p").distinct()


def _grouped(docs: DataFrame, how: Join) -> DataFrame:
    sets = _sets(docs, how)
    classes = _stored(_classes(sets), "part-enum-classes")
    numbers = _small(classes.select("number", "cid"), how)
    whole = sets.select("number", "n", "features", "sketch", "thin").join(numbers, "number").drop("number")
    edges = _stored(_to_pivots(with_signatures(whole, how)), "part-enum-edges")
    links = _named(_links(edges, whole, how))
    groups = components(links)
    thin = whole.where("thin").select("cid")
    among = _stored(_unsure(edges, groups, how).union(thin).distinct(), "part-enum-among")
    if among.isEmpty():
        return _labelled(sets, classes, groups)
    late = whole.join(_small(among, how), "cid", "left_semi")
    firsts = _firsts(late, how)
    # Pivots again join most of what belongs together, and only what is still apart meets pair by pair.
    for nth in range(how.late_rounds + 1):
        # Groups only grow, so features that one group has are settled.
        firsts = _stored(_apart(firsts.drop("root"), _rooted(among, groups), how), "part-enum-apart")
        pairs = _late_pivots(firsts, nth) if nth < how.late_rounds else _meetings(firsts, how)
        found = _links(_stored(pairs, "part-enum-meetings"), late, how)
        if not found.isEmpty():
            links = links.union(_named(found))
            groups = components(links)
    return _labelled(sets, classes, groups)


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("a"), F.col("p").alias("b"))


def _rooted(classes: DataFrame, groups: DataFrame) -> DataFrame:
    """``cid`` and ``root`` of ``classes``; one without a link is a group of its own."""
    joined = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    return joined.select("cid", F.coalesce("root", "cid").alias("root"))


def _unsure(edges: DataFrame, groups: DataFrame, how: Join) -> DataFrame:
    """``cid`` of the classes that share a pivot with one of another group, which only the pivot was compared with."""
    shared = edges.where("more").select(F.col("x").alias("cid"), "p")
    shared = shared.join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    shared = _stored(shared, "part-enum-shared")
    spans = shared.groupBy("p").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    pivots = _small(_stored(spans.select("p"), "part-enum-unsure-pivots"), how)
    return shared.join(pivots, "p", "left_semi").select("cid")


def _labelled(sets: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Per row of ``sets``: ``doc_id``, ``n``, the key of the text, ``component_id`` and ``chosen``, the text of
    the group's smallest ``doc_id``; null without a set."""
    found = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    found = found.withColumn("root", F.coalesce("root", "cid"))
    smallest = found.groupBy("root").agg(F.min("first").alias("chosen"))
    by_class = found.join(smallest, "root").select("key1", "key2", F.col("n").alias("_n"), "chosen")
    same = ["key1", "key2"]
    labelled = sets.join(by_class, same, "left").where("_n is null or n = _n")
    component = F.coalesce("chosen.doc_id", "doc_id").alias("component_id")
    return labelled.select("doc_id", "n", "text1", "text2", component, "chosen")


def grouped(docs: DataFrame, how: Join = Join()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id`` that
    links reach, its own included."""
    with _scratch(docs.sparkSession):
        found = _grouped(docs, how).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        return _kept(found, "part-enum-groups")


def one_of_each(docs: DataFrame, how: Join = Join()) -> DataFrame:
    """The rows of ``docs`` that hold the first text of their group, with all their columns: that of its
    smallest ``doc_id``, and of texts that share it, or have none, the one of the smallest hash. Of rows that
    repeat a ``doc_id`` with the same text one stays; empty texts stay."""
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text1", "text2")
    gone = F.col("chosen").isNotNull() & ~own.eqNullSafe(F.col("chosen"))
    keys = ["doc_id", "text1", "text2"]
    with _scratch(docs.sparkSession):
        texts = _grouped(docs, how).select(*keys, gone.alias("gone")).groupBy(*keys)
        texts = texts.agg(F.max("gone").alias("gone"), F.count("*").alias("rows"))
        # Only rows that stand more than once are dealt out, not the whole table.
        special = _kept(texts.where("gone or rows > 1"), "part-enum-special")
    repeated = _small(special.where("not gone").select(*[F.col(c).alias(f"_{c}") for c in keys]), how)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(row.alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), *text_key())
    same = F.col("_id").eqNullSafe(F.col("_doc_id")) & (F.col("text1") == F.col("_text1")) & (F.col("text2") == F.col("_text2"))
    nth = F.row_number().over(Window.partitionBy("_id", "text1", "text2").orderBy("_id"))
    one = rows.join(repeated, same, "left_semi").withColumn("_nth", nth).where("_nth = 1").select("_row.*")
    return without_texts(docs, special, lambda texts: _small(texts, how)).select("_row.*").unionByName(one)
