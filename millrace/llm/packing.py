"""Bounded-space online best-fit packing of documents into token sequences of a fixed length.

Each task packs its own rows with a fixed number of open bins; only the bins a task leaves open at
its end lose space to the split. Bins are kept in a bitset keyed by free space: the lowest set bit at
or above a piece's length is the tightest bin. With all bins open and none fitting, the fullest closes.
Rows of one Arrow batch go in by falling length, which leaves small pieces to fill gaps.

A null or empty text is its end id alone. Repeated rows are packed each; the bins of a task follow
from its rows, so a task that runs again gives the same. Of the input only ``doc_id`` and ``text`` are
read, other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.ship import ship_package

SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
)


@dataclass(frozen=True)
class Packing:
    """``path`` and ``spaced``: the vocabulary, see ``tokens.Encoder``. ``end``: id after each text.
    ``length``: tokens of a sequence. ``open_bins``: bins a task holds open at once."""

    path: str
    spaced: bool = True
    end: int = 2
    length: int = 1024
    open_bins: int = 256


class Bins:
    """Places pieces; ``place`` gives a bin's number and the offset in it."""

    def __init__(self, length: int, open_bins: int) -> None:
        self.length, self.most = length, open_bins
        self.free_bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        number = self.by_free[free].pop()
        if not self.by_free[free]:
            self.free_bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, piece: int) -> tuple[int, int]:
        fitting = self.free_bits >> piece
        if fitting:
            free = piece + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most and piece < self.length:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            number, free = self.made, self.length
            self.made += 1
        left = free - piece
        if left:
            self.by_free[left].append(number)
            self.free_bits |= 1 << left
            self.open += 1
        return number, self.length - free


def pieces(n_tokens: int, length: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than ``length``."""
    first = n_tokens % length or min(n_tokens, length)
    starts = [0, *range(first, n_tokens, length)]
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], n_tokens])]))


def pack(docs: DataFrame, how: Packing) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start`` in the document, ``length``, ``ids_crc32``,
    ``sequence_id`` (unique over all tasks) and ``offset`` in the sequence."""

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        from millrace.llm.arrow import batch_of
        from millrace.llm.tokens import encoder

        encoded = encoder(how.path, how.spaced).encoded
        end = how.end.to_bytes(4, "little")
        base = TaskContext.get().partitionId() << 40
        bins = Bins(how.length, how.open_bins)
        for batch in batches:
            found = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoded(batch.column("text"))):
                raw = ids + end
                for k, (start, size) in enumerate(pieces(len(raw) // 4, how.length)):
                    found.append((doc, k, start, size, zlib.crc32(raw[4 * start : 4 * (start + size)])))
            found.sort(key=lambda x: -x[3])
            rows = []
            for row in found:
                number, offset = bins.place(row[3])
                rows.append((*row, base + number, offset))
            yield batch_of(rows, SCHEMA)

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)
