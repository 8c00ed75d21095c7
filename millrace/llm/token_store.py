"""Token ids of a corpus as blocks of one concatenated array with Elias-Fano document boundaries.

A store is a folder of Parquet files whose rows are blocks; Spark's writer commits them, so a lost
executor leaves no half block behind, and any store Spark can write to will do. A block holds

* ``part``, ``block``: its place; blocks in that order are the whole array,
* ``base``: ids before it in its part,
* ``doc_ids``: its documents in order,
* ``boundaries``: where each document starts in it, and its end, as an Elias-Fano sequence,
* ``ids``: the ids, little-endian, 2 or 4 bytes each as ``width`` says.

An Elias-Fano sequence of n values below u keeps ``log2(u/n)`` low bits of each value as they are and
the high parts as a bit vector with one set bit per value, about ``2 + log2(u/n)`` bits per document.
``select`` finds the i-th value from the place of every 64th set bit, in 4 bytes each.

Nulls and empty texts are their end id alone. Documents stand in ascending ``doc_id`` (nulls first);
rows that share one follow the hash of their text. Repeated rows are kept. An empty table gives an
empty store. Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package

BLOCKS = (
    "part int, block int, base bigint, n_tokens bigint, width int, doc_ids array<bigint>, "
    "boundaries binary, ids binary"
)
DOCUMENTS = "doc_id bigint, part int, start bigint, n_tokens bigint, ids_crc32 bigint"
HEADER = struct.Struct("<4sBxxxQQQQ")
MAGIC = b"EFB1"
SAMPLE = 64


class EliasFano:
    """A non-decreasing sequence of integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        if not n:
            empty = np.zeros(0, np.uint8)
            return EliasFano(0, 0, empty, empty, np.zeros(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        return EliasFano(
            n,
            low_bits,
            np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"),
            np.packbits(high, bitorder="little"),
            places[::SAMPLE].astype(np.uint32),
        )

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        piece = int.from_bytes(self.low[first // 8 : (first + self.low_bits) // 8 + 1].tobytes(), "little")
        return (piece >> first % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i``."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = place // 8
        bits = int(self.high[byte]) >> place % 8 << place % 8
        while bits.bit_count() <= left:
            left -= bits.bit_count()
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        return (byte * 8 + (bits & -bits).bit_length() - 1 - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high.astype(np.int64)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, -1)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return (high | low).astype(np.int64)

    def to_bytes(self) -> bytes:
        head = HEADER.pack(MAGIC, self.low_bits, self.n, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @staticmethod
    def from_bytes(raw: bytes) -> EliasFano:
        magic, low_bits, n, n_low, n_high, n_samples = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not an Elias-Fano sequence")
        at = HEADER.size
        low = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(raw, "<u4", n_samples, at + n_low + n_high)
        return EliasFano(n, low_bits, low, high, samples)


@dataclass(frozen=True)
class Store:
    """``path`` and ``spaced``: the vocabulary, see ``tokens.Encoder``. ``end``: id after each text.
    ``block_tokens``: a block closes once it has as many. A text is never cut."""

    path: str
    spaced: bool = False
    end: int = 2
    block_tokens: int = 2_000_000


def _block(part: int, block: int, base: int, docs: list, texts: list[bytes]) -> tuple:
    sizes = np.array([len(x) // 4 for x in texts], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.frombuffer(b"".join(texts), dtype="<u4")
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    raw = ids.astype(f"<u{width}").tobytes()
    return part, block, base, int(bounds[-1]), width, docs, EliasFano.of(bounds).to_bytes(), raw


def write_store(docs: DataFrame, folder: str, how: Store) -> None:
    """Encodes ``docs`` (``doc_id``, ``text``) and writes the blocks in ascending ``doc_id``."""

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        from millrace.llm.arrow import batch_of
        from millrace.llm.tokens import encoder

        encoded = encoder(how.path, how.spaced).encoded
        end = how.end.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        block = base = size = 0
        docs: list = []
        texts: list[bytes] = []
        for batch in batches:
            for doc, raw in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"))):
                docs.append(doc)
                texts.append(raw + end)
                size += len(texts[-1]) // 4
                if size >= how.block_tokens:
                    yield batch_of([_block(part, block, base, docs, texts)], BLOCKS)
                    block, base, size, docs, texts = block + 1, base + size, 0, [], []
        if docs:
            yield batch_of([_block(part, block, base, docs, texts)], BLOCKS)

    ship_package(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.mapInArrow(run, BLOCKS).write.mode("overwrite").option("compression", "zstd").parquet(folder)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a store: ``doc_id``, ``start`` in the whole array, ``n_tokens``, ``ids_crc32``
    of its ids as unsigned 32-bit integers. Offsets come from the boundaries, ids from the array."""

    def run(batches: Iterator) -> Iterator:
        from millrace.llm.arrow import batch_of

        for batch in batches:
            for row in batch.to_pylist():
                bounds = EliasFano.from_bytes(row["boundaries"]).values().tolist()
                ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}").astype("<u4")
                found = [
                    (doc, row["part"], row["base"] + a, b - a, zlib.crc32(ids[a:b]))
                    for doc, a, b in zip(row["doc_ids"], bounds, bounds[1:])
                ]
                yield batch_of(found, DOCUMENTS)

    ship_package(spark)
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    # One row per part, and parts are the tasks that wrote: their number is a setting, not the data's.
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = F.sum("in_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = sums.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_before"))
    docs = blocks.mapInArrow(run, DOCUMENTS)
    joined = docs.join(F.broadcast(parts), docs["part"] == parts["_part"])
    return joined.select("doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")
