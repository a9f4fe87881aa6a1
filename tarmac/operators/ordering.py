"""Stable event order without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored

#: Row ids hold the task above this bit and the row within it below.
_TASK_BIT = 33


def with_position(rows: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Number the rows 0, 1, 2... in the order of the columns `order`, nulls last.

    One range shuffle deals the rows out in order, and each task sorts its range and stores it. A
    range has as many rows as its predecessors add up to before it, so the counts, one number for
    each task, are all that comes to the driver, and a row's place is its range's offset plus its
    place there. `order` should tell rows apart, so that a busy moment can be split over ranges.
    """
    by = [F.asc_nulls_last(column) for column in order]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("at", _TASK_BIT).cast("int")
    counts = dict(placed.groupBy(task.alias("task")).agg(F.count("*")).collect())
    before, total = [], 0
    for n in range(max(counts, default=-1) + 1):
        before.append(str(total))
        total += counts.get(n, 0)
    offsets = F.split(F.lit(",".join(before)), ",").cast("array<bigint>")
    within = F.col("at").bitwiseAND(F.lit((1 << _TASK_BIT) - 1))
    return placed.withColumn(name, F.get(offsets, task) + within).drop("at")
