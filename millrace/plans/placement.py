"""Rows dealt to tasks by how much work they are.

A scan packs small files together and keeps a large row group in one task, and adaptive execution merges
exchanges of few bytes. Both are right for cheap rows. Rows whose cost is far from their bytes, such as source
text to be parsed, or narrow rows that large texts are made from, are placed here instead: so many bytes of
work to a task, on any number of cores.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.reshape import column

#: Work of a task, and the most tasks; beyond those a task gets more.
TASK_BYTES = 4 << 20
MOST_TASKS = 100_000
#: Rows too long to share a task are numbered within so many groups.
GROUPS = 256


def dealt(rows: DataFrame, key: str, size: Column, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``rows`` in partitions of about ``task_bytes``, where ``size`` says how many bytes of work a row is.

    A row of half of that or more (a power of two up to it, to be exact) has a partition to itself, or shares it
    with long rows of its own key; the others are dealt by a hash of ``key``. The number of partitions follows from
    the sum of ``size``, which costs one pass over the columns it reads; it is fixed, so adaptive execution leaves
    it alone. A NULL size counts nothing.
    """
    work = F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))
    place = F.xxhash64(column(key))
    group = F.pmod(place, F.lit(GROUPS)).cast("int")
    # At most so many groups times the bits of a number.
    bits = F.when(column(key).isNotNull(), F.length(F.bin(work))).otherwise(0)
    sums = rows.groupBy(group.alias("group"), bits.alias("bits")).agg(F.sum(work).alias("work"), F.count("*").alias("n")).collect()
    whole = sum(r["work"] for r in sums)
    task_bytes = max(task_bytes, -(-whole // MOST_TASKS))
    least = max(task_bytes // 2, 1).bit_length()
    is_long = bits >= least
    found = [r for r in sums if r["bits"] >= least]
    shared = max(1, -(-(whole - sum(r["work"] for r in found)) // task_bytes))
    hashed = F.pmod(place, F.lit(shared)).cast("int")
    if not found:
        return rows.repartitionById(shared, hashed)
    # Where each group's numbers begin, after the shared partitions.
    counts = [0] * GROUPS
    for r in found:
        counts[r["group"]] += r["n"]
    starts = [shared + x for x in accumulate(counts, initial=0)]
    long = rows.where(is_long).select(column(key).alias("_key"), group.alias("_group")).distinct()
    first = F.element_at(F.array(*map(F.lit, starts[:-1])), F.col("_group") + 1)
    nth = F.row_number().over(Window.partitionBy("_group").orderBy("_key")) - 1
    slots = long.select("_key", (first + nth).cast("int").alias("_slot"))
    joined = rows.join(slots, (column(key) == F.col("_key")) & is_long, "left")
    return joined.repartitionById(starts[-1], F.coalesce("_slot", hashed)).drop("_key", "_slot")
