"""Places in an order, and sums up to a place, without a task that holds a whole group.

Rows are sorted into ranges that Spark cuts evenly; a row's place within its range comes with the
sort, and only the number of rows that each range has of each group is added up over the ranges
before. So a group with a third of all rows is numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmetrics.llm.common import fresh, stored

_ROW_BITS = 33  # monotonically_increasing_id has the row's place in its partition in these


def numbered(df: DataFrame, order: Sequence[Column], number: str,
             within: Sequence[str] = ()) -> DataFrame:
    """The rows, stored, with their place (from 0) among the rows of the same `within` columns.

    Nulls in `within` are a group of their own. Rows that `order` does not tell apart are numbered
    in any order. `order` should tell most rows apart, as rows that it does not share a range.
    """
    place, part, first, before = (fresh(df, c) for c in ("place", "range", "first", "before"))
    keys = [*(F.col(c) for c in within), *order]
    # The id of the row makes the sort key unique, so ties are cut into ranges as well.
    tie = fresh(df, "tie")
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(*keys, F.col(tie)).sortWithinPartitions(*keys, F.col(tie)))
    placed = stored(ranged.drop(tie).withColumn(place, F.monotonically_increasing_id())
                    .withColumn(part, F.shiftright(F.col(place), _ROW_BITS)))
    group = [fresh(df, f"{c}_of_group") for c in within]
    sizes = placed.groupBy(part, *within).agg(F.min(place).alias(first), F.count("*").alias("n"))
    # One row for each range of a group.
    earlier = (Window.partitionBy(*within).orderBy(part)
               .rowsBetween(Window.unboundedPreceding, -1))
    # Stored, so that Spark knows how small they are when it chooses the join.
    starts = stored(sizes.select(
        F.col(part).alias(f"{part}_"), *[F.col(c).alias(g) for c, g in zip(within, group)], first,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before)))
    same = F.col(part) == F.col(f"{part}_")
    for c, g in zip(within, group):
        same &= F.col(c).eqNullSafe(F.col(g))
    at = (F.col(place) - F.col(first) + F.col(before)).cast("bigint")
    return placed.join(starts, same).select(*df.columns, at.alias(number))
