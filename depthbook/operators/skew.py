"""Keeping hot groups out of single tasks.

A window over a group runs in one task. That is right for ordinary groups and
wrong for a group that holds a large part of all rows. Groups are counted, and the
hot ones, however many, are walked in pieces; all others in a plain window. Both
ways give equal results. Everything is part of one lazy plan: no job runs while a
query is built, hot keys stay a table that Spark joins as it sees fit, and pieces
are functions of the row, so any recomputation cuts a group at the same places.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task sorts and walks without trouble. A physical parameter: results
#: do not depend on it.
HOT_ROWS = 1_000_000
#: Hash buckets that keys are counted in before they are counted one by one: a few rows per task are exchanged for it.
KEY_BUCKETS = 16_384
#: Price steps per doubling. A group has at most 64 doublings, so about a quarter of a
#: million pieces, of which one window sums the totals.
STEPS = 4_096
#: Orders of one price and region are cut by ranges of this many ids.
ID_RANGE = 65_536


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows; counts are combined before their shuffle."""
    return rows.groupBy(*keys).count().where(F.col("count") > hot_rows).select(*keys)


def apart(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, hot rows)."""
    return rows.join(hot, list(keys), "left_anti"), rows.join(hot, list(keys), "left_semi")


def apart_by_bucket(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows none of whose keys is hot, rows of buckets of keys that hold more than `hot_rows` rows).

    No key has more rows than its bucket, so only the second part, empty as a rule, needs `hot_keys`. The full buckets
    are at most KEY_BUCKETS rows, whatever the tables, and are broadcast.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    placed = rows.withColumn("bucket", bucket)
    full = F.broadcast(placed.groupBy("bucket").count().where(F.col("count") > hot_rows).select("bucket"))
    return tuple(placed.join(full, "bucket", how).drop("bucket") for how in ("left_anti", "left_semi"))


def price_step(price: Column) -> Column:
    """A whole number that never falls as the price rises, and seldom stays for long."""
    units = F.greatest(price.cast("double"), F.lit(0.0)) * 10_000 + 1
    return F.floor(F.log2(units) * STEPS)


def before_piece(totals: DataFrame, group: Sequence[str], column: str, *order: Column | str) -> Column:
    """Sum of `column` over the earlier pieces of the group; `totals` has a row per piece."""
    earlier = (
        Window.partitionBy(*group)
        .orderBy(*(order or ("piece",)))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(totals[column]).over(earlier), F.lit(0))


def with_position(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    descending: bool,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add `position`, counted from 1 in `order` within each group.

    `order` starts with the price (falling if `descending`), then region_id and
    order_id. Hot groups are cut by price step, then by price and region, then by
    ranges of order ids: a row's position is what lies before its piece at each of the
    three depths, and its place in its own piece. Rows equal in all of these share a
    piece. `counted`: rows to find hot groups in, if some at least as many are cheaper
    to read.
    """
    group, order = list(group), list(order)
    hot = hot_keys(rows if counted is None else counted, group, hot_rows)
    whole_group = Window.partitionBy(*group).orderBy(*order)
    ordinary, large = apart(rows, hot, group)
    placed = ordinary.withColumn("position", F.row_number().over(whole_group).cast("long"))

    sign = -1 if descending else 1
    cut = large.withColumns(
        {
            "cut_1": sign * price_step(F.col("price")),
            "cut_2": sign * F.col("price"),
            "cut_3": F.col("region_id"),
            "cut_4": F.floor(F.col("order_id") / ID_RANGE),
        }
    )
    depths = [group, [*group, "cut_1"], [*group, "cut_1", "cut_2", "cut_3"]]
    steps = [["cut_1"], ["cut_2", "cut_3"], ["cut_4"]]
    counts = cut.groupBy(*group, "cut_1", "cut_2", "cut_3", "cut_4").agg(F.count("*").alias("n"))
    # A window per depth over one row per piece; deeper windows stay within a piece of the depth above.
    third = counts.withColumn("before", before_piece(counts, depths[2], "n", *steps[2]))
    second = counts.groupBy(*depths[2]).agg(F.sum("n").alias("n"))
    second = second.withColumn("before_2", before_piece(second, depths[1], "n", *steps[1]))
    first = second.groupBy(*depths[1]).agg(F.sum("n").alias("n"))
    first = first.withColumn("before_1", before_piece(first, depths[0], "n", *steps[0])).drop("n")
    starts = third.drop("n").join(second.drop("n"), depths[2]).join(first, depths[1])
    starts = starts.withColumn("before", F.col("before") + F.col("before_2") + F.col("before_1"))
    piece = [*depths[2], "cut_4"]
    within = Window.partitionBy(*piece).orderBy(*order)
    pieces = cut.join(starts.drop("before_2", "before_1"), piece).withColumn(
        "position", F.col("before") + F.row_number().over(within)
    )
    return placed.unionByName(pieces.select(*placed.columns))
