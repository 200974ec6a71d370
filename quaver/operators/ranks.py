"""Row numbers in a total order without a task that sees all rows of a group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quaver.session import materialize, unused


def numbered(rows: DataFrame, order: list[str], group: tuple[str, ...] = (), name: str = "place") -> DataFrame:
    """Rows with their number from 0 in `order`, within each group."""
    one = unused("one", [*rows.columns, name])
    return running(rows.withColumn(one, F.lit(1)), one, order, group, name).drop(one)


def running(rows: DataFrame, weight: str, order: list[str], group: tuple[str, ...] = (), name: str = "before") -> DataFrame:
    """Rows with the sum of the weights (whole numbers) before them in `order`, within each group.

    Two passes: rows are dealt by ranges of (group, order) and written sorted; what is summed over
    then is one count for every group and range, however many rows either has. Ties in `order` are numbered in any order.
    """
    line, part, inner, outer = (unused(c, [*rows.columns, name]) for c in ("line", "part", "inner", "outer"))
    keys = [*group, *order]
    dealt = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(line, F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn(part, F.shiftright(line, 33))
    earlier = lambda *by: W.partitionBy(*by).rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    within = dealt.withColumn(inner, before(weight, earlier(*group, part).orderBy(line)))
    counts = dealt.groupBy(*group, part).agg(F.sum(weight).alias("n"))
    starts = counts.select(*[F.col(c).alias(f"_{c}") for c in group], F.col(part).alias("_part"), before("n", earlier(*group).orderBy(part)).alias(outer))
    same = F.col(part) == F.col("_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return within.join(starts, same).select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(outer) + F.col(inner)).cast("bigint").alias(name))
