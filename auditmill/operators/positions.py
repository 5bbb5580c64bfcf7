"""Row numbers over whole tables: two passes over a range-sorted table, no window over all rows and none over a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditmill.plans.storage import write_once

#: `monotonically_increasing_id` holds the partition above these bits and the row's place in it below.
PLACE_BITS = 33


def with_positions(rows: DataFrame, order: Sequence[str], keys: Sequence[str] = (), *, name: str = "position", total: str | None = None) -> DataFrame:
    """`rows` with their 0-based position in ascending `order` (nulls first), over all rows or within each group of `keys`;
    `total` names a further column with the number of rows of the group.

    The first pass range-sorts the rows by (keys, order) and writes them with their place in their partition. The second
    counts rows per partition and key, sums the counts before each partition, and adds them to the places. A key with
    most of the rows is many partitions; what is summed in one task is one row per partition of a key. Rows equal in
    keys and order get consecutive positions in any order, but always the same ones, since the places are stored.

    Ranges are sampled, so `rows` is read twice: hand in a stored table where it is costly to derive.
    """
    place, part, first, n, before = (_unused(rows, c) for c in ("place", "part", "first", "n", "before"))
    sorted_rows = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = write_once(sorted_rows.withColumn(place, F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn(part, F.shiftright(place, PLACE_BITS))
    runs = placed.groupBy(*keys, part).agg(F.min(place).alias(first), F.count("*").alias(n))
    group = Window.partitionBy(*keys)
    sums = {before: F.coalesce(F.sum(n).over(group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col(first)}
    if total:
        sums[total] = F.sum(n).over(group)
    # Other names on this side: both come from one table, and keys may be null.
    other = {c: _unused(rows, f"{c}_of_run") for c in (*keys, part)}
    offsets = runs.withColumns(sums).drop(first, n).withColumnsRenamed(other)
    joined = placed.join(offsets, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{o}`")) for c, o in other.items()])
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(place) + F.col(before)).alias(name), *([total] if total else ()))


def page(positioned: DataFrame, start: int, rows: int, *, name: str = "position") -> DataFrame:
    """Rows `start` to `start + rows - 1` of a table with positions. From a stored one the scan opens only the files and
    row groups whose positions overlap."""
    return positioned.where(F.col(name).between(start, start + rows - 1))


def _unused(rows: DataFrame, base: str) -> str:
    taken = {c.lower() for c in rows.columns}
    while base in taken:
        base += "_"
    return base
