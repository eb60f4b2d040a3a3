"""Market depth: price levels, outlier suppression, running volume and eight statistics.

Volumes stay integers and prices decimals until the last division, so results do
not depend on how the rows were partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthbook.functions.constants import (
    BEST_SHARE,
    EMPTY_STATISTIC,
    GLOBAL_LOC,
    OUTLIER_FACTOR,
)
from depthbook.operators.skew import HOT_ROWS, apart, apart_by_bucket, before_piece, hot_keys, price_step

# The most selective column leads: sorts compare it first.
GROUP = ["type_id", "loc_id", "order_set", "buy"]
#: What the groups of all locations have in common.
BOOK = ["type_id", "order_set", "buy"]
STATISTICS = [
    "weighted_average",
    "max_price",
    "min_price",
    "stddev",
    "median",
    "volume",
    "order_count",
    "percentile",
]

#: Squares of fewer units add up within 38 digits for a hundred million levels; larger ones are halved at HALF.
HUGE_UNITS = 10**15
HALF = 10**10

SCOPE_COLUMNS = {"region": "region_id", "station": "station_id", "system": "system_id"}


# ---------------------------------------------------------------- price levels


def price_levels(orders: DataFrame, loc: str | Column = "region_id") -> DataFrame:
    """Volume per (snapshot, location, type, side, price)."""
    loc = F.col(loc) if isinstance(loc, str) else loc
    return (
        orders.select(
            "order_set", loc.cast("long").alias("loc_id"), "type_id", "buy", "price", "volume"
        )
        .groupBy(*GROUP, "price")
        .agg(F.sum("volume").alias("volume"))
    )


def with_station_system(orders: DataFrame, stations: DataFrame, how: str = "inner") -> DataFrame:
    """The system of an order is the one of its station; unknown stations drop out (inner)."""
    located = stations.select("station_id", "system_id")
    return orders.drop("system_id").join(located, "station_id", how)


def _at_all_scopes(rows: DataFrame) -> DataFrame:
    """Each row at its global, region, system and station location."""
    locations = F.array(
        F.lit(GLOBAL_LOC).cast("long"),
        F.col("region_id").cast("long"),
        F.col("system_id").cast("long"),
        F.col("station_id").cast("long"),
    )
    places = ["region_id", "system_id", "station_id"]
    return rows.withColumn("loc_id", F.explode(F.array_compact(locations))).drop(*places)


def all_scope_levels(orders: DataFrame, stations: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Levels of the global, region, system and station scopes from one scan.

    Orders are folded to levels of the finest location first, so the fourfold
    expansion applies to levels and not to orders. With `wanted` (loc_id, type_id, each pair
    once) only these are made: orders of other types leave before the first fold, other
    places right after the expansion.
    """
    if wanted is not None:
        orders = orders.join(wanted.select("type_id").distinct(), "type_id", "left_semi")
    places = ["region_id", "station_id"]
    key = ["order_set", "type_id", "buy", "price"]
    fine = orders.groupBy(*places, *key).agg(F.sum("volume").alias("volume"))
    placed = _at_all_scopes(with_station_system(fine, stations, "left"))
    if wanted is not None:
        placed = placed.join(wanted, ["loc_id", "type_id"], "left_semi")
    return placed.groupBy(*GROUP, "price").agg(F.sum("volume").alias("volume"))


# ------------------------------------------------------------------ the walk


def _walk_order(buy_best_first: bool) -> Column:
    """Sort key of the walk: sells from the cheapest up, buys from the dearest down."""
    if not buy_best_first:
        return F.col("price")
    return F.when(F.col("buy"), -F.col("price")).otherwise(F.col("price"))


def _best(highest: Column, lowest: Column) -> Column:
    return F.when(F.col("buy"), highest).otherwise(lowest)


def _kept_volume() -> Column:
    """Volume of a level, nothing if its price is out of all proportion to the best one."""
    price, best = F.col("price"), F.col("best")
    outlier = F.when(F.col("buy"), price * OUTLIER_FACTOR < best).otherwise(
        price > best * OUTLIER_FACTOR
    )
    return F.when(outlier, F.lit(0).cast("long")).otherwise(F.col("volume"))


def _walk(levels: DataFrame) -> DataFrame:
    """Walk each group in one window: `running`, `total`, `rank`, `n_levels` per level."""
    lane = Window.partitionBy(*GROUP).orderBy("walk")
    whole = lane.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = lane.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        levels.withColumn("best", _best(F.max("price").over(whole), F.min("price").over(whole)))
        .withColumn("kept", _kept_volume())
        .select(
            *GROUP,
            "walk",
            "price",
            "kept",
            F.sum("kept").over(so_far).alias("running"),
            F.sum("kept").over(whole).alias("total"),
            F.row_number().over(lane).cast("long").alias("rank"),
            F.count("price").over(whole).alias("n_levels"),
        )
    )


def _piece() -> Column:
    """Which piece of its group a row belongs to, counted along the walk."""
    step = price_step(F.col("price"))
    return F.when(F.col("walk") != F.col("price"), -step).otherwise(step)


def _walk_in_pieces(levels: DataFrame) -> DataFrame:
    """The same columns for groups too large for one window.

    Each group is cut along the walk by steps of the price; a piece is walked by itself
    and continues from the totals of the pieces before it. Only rows per piece meet per
    group.
    """
    cut = levels if "piece" in levels.columns else levels.withColumn("piece", _piece())
    piece_key = [*GROUP, "piece"]
    per_group = Window.partitionBy(*GROUP)
    best = (
        cut.groupBy(*piece_key)
        .agg(F.max("price").alias("high"), F.min("price").alias("low"))
        .select(
            *piece_key,
            _best(F.max("high").over(per_group), F.min("low").over(per_group)).alias("best"),
        )
    )
    kept = cut.join(best, piece_key).withColumn("kept", _kept_volume())
    sums = kept.groupBy(*piece_key).agg(
        F.sum("kept").alias("piece_kept"), F.count("price").alias("piece_levels")
    )
    sums = sums.select(
        *piece_key,
        before_piece(sums, GROUP, "piece_kept").alias("kept_before"),
        before_piece(sums, GROUP, "piece_levels").alias("levels_before"),
        F.sum("piece_kept").over(per_group).alias("total"),
        F.sum("piece_levels").over(per_group).alias("n_levels"),
    )
    lane = Window.partitionBy(*piece_key).orderBy("walk")
    so_far = lane.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return kept.join(sums, piece_key).select(
        *GROUP,
        "price",
        "kept",
        (F.col("kept_before") + F.sum("kept").over(so_far)).alias("running"),
        "total",
        (F.col("levels_before") + F.row_number().over(lane)).alias("rank"),
        "n_levels",
    )


# ---------------------------------------------------------------- statistics


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def _spread_sums() -> dict[str, Column]:
    """What the spread of a group is made of: exact sums of whole price units and of their squares.

    Prices whose squares would leave 38 digits in a sum are squared in two halves.
    """
    whole = "decimal(38,0)"
    number = lambda n: F.lit(Decimal(n)).cast(whole)
    # A single level has no spread, and nothing is summed up for it.
    units = F.when(F.col("n_levels") > 1, (F.col("price") * 10_000).cast("decimal(19,0)"))
    huge = units >= number(HUGE_UNITS)
    high, low = (F.when(huge, part) for part in (F.call_function("div", units, number(HALF)), units % number(HALF)))
    high, low = high.cast("decimal(19,0)"), low.cast("decimal(19,0)")
    return {
        "units": F.sum(units),
        "squares": F.sum(F.when(~huge, F.try_multiply(units, units).cast(whole))),
        "high": F.sum((high * high).cast(whole)),
        "mixed": F.sum((high * low).cast(whole)),
        "low": F.sum((low * low).cast(whole)),
    }


def _spread() -> Column:
    """Sample standard deviation of the prices from the exact sums.

    n * sum(p^2) - sum(p)^2 is a whole number, so the result does not depend on the order of
    addition. Where only the difference leaves 38 digits, it is taken between the exact sums as floats.
    """
    whole = "decimal(38,0)"
    number = lambda n: F.lit(Decimal(n)).cast(whole)
    parts = [(1, "squares"), (HALF * HALF, "high"), (2 * HALF, "mixed"), (1, "low")]
    parts = [(factor, F.coalesce(F.col(part).cast(whole), number(0))) for factor, part in parts]
    squares = number(0)
    for factor, part in parts:
        squares = F.try_add(squares, F.try_multiply(part, number(factor)).cast(whole)).cast(whole)
    n, total = F.col("order_count"), F.col("units").cast(whole)
    exact = F.try_subtract(
        F.try_multiply(n.cast(whole), squares).cast(whole), F.try_multiply(total, total).cast(whole)
    )
    n = n.cast("double")
    floats = sum((part.cast("double") * float(factor) for factor, part in parts), F.lit(0.0))
    floats = F.greatest(n * floats - total.cast("double") * total.cast("double"), F.lit(0.0))
    cross = F.coalesce(exact.cast("double"), floats)
    return F.when(n > 1, F.sqrt(F.try_divide(cross, n * (n - 1))) / 10_000)


def _shared(walked: DataFrame) -> DataFrame:
    """Walked levels with their share of the best twentieth and, in the middle of their group, their price."""
    price, kept = F.col("price"), F.col("kept")
    # Share of the level in the best twentieth, times twenty to stay an integer.
    reached = F.col("total") - BEST_SHARE * (F.col("running") - kept)
    share = F.greatest(F.lit(0).cast("long"), F.least(BEST_SHARE * kept, reached))
    # One middle level for an odd count, two for an even one.
    middle = F.when(
        (2 * F.col("rank")).between(F.col("n_levels"), F.col("n_levels") + 2), price
    )
    return walked.withColumn("share", share).withColumn("middle", middle)


def _sums() -> dict[str, Column]:
    """What the statistics of a group are made of."""
    price = F.col("price")
    return {
        "worth": F.sum(price * F.col("kept")),
        "min_price": F.min("price"),
        **_spread_sums(),
        "middles": F.sum("middle"),
        "n_middles": F.count("middle"),
        "volume": F.sum("kept"),
        "order_count": F.count("price"),
        "best_worth": F.sum(price * F.col("share")),
        "best_volume": F.sum("share"),
    }


def _of_sums(sums: DataFrame) -> DataFrame:
    made = {
        "weighted_average": _ratio(F.col("worth"), F.col("volume")),
        "stddev": F.coalesce(_spread(), F.lit(EMPTY_STATISTIC)),
        "median": _ratio(F.col("middles"), F.col("n_middles")),
        "percentile": _ratio(F.col("best_worth"), F.col("best_volume")),
    }
    return sums.select(*GROUP, *[made[n].alias(n) if n in made else n for n in STATISTICS])


def _statistics(walked: DataFrame) -> DataFrame:
    # A struct cannot be updated in a hash table, so Spark groups along the sort of the walk.
    highest = F.max(F.struct("price")).getField("price").alias("max_price")
    return _of_sums(_shared(walked).groupBy(*GROUP).agg(highest, *[c.alias(n) for n, c in _sums().items()]))


def _statistics_in_place(walked: DataFrame) -> DataFrame:
    """The same of groups that lie together as they were walked: summed up once along the walk, the first level of each
    group stands for it."""
    lane = Window.partitionBy(*GROUP).orderBy("walk")
    whole = lane.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = {"max_price": F.max("price"), **_sums()}
    rows = _shared(walked).select(*GROUP, "rank", *[c.over(whole).alias(n) for n, c in sums.items()])
    return _of_sums(rows.where("rank = 1"))


def _fold_in_place(rows: DataFrame, *key: str) -> DataFrame:
    """Levels of rows that lie together by `key` already.

    A struct cannot be updated in a hash table, so Spark folds along the sort that the walk needs.
    """
    folded = rows.groupBy(*key, "walk").agg(F.sum("volume").alias("volume"), F.max(F.struct("price")).alias("level"))
    return folded.select(*key, "walk", "level.price", "volume")


def _apart_by_place(
    orders: DataFrame, expanded: Callable[[DataFrame], DataFrame], hot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups) of orders that `expanded` gives their locations.

    The hot locations of a book, one for every `hot_rows` of its rows at most, meet its orders before these are expanded.
    """
    hot = hot_keys(expanded(orders), GROUP, hot_rows)
    places = hot.groupBy(*BOOK).agg(F.collect_list("loc_id").alias("hot_places"))
    rows = expanded(orders.join(places, BOOK, "left"))
    is_hot = F.coalesce(F.array_contains("hot_places", F.col("loc_id")), F.lit(False))
    return rows.where(~is_hot).drop("hot_places"), rows.where(is_hot).drop("hot_places")


def _stats_of_orders(
    orders: DataFrame, buy_best_first: bool, hot_rows: int, expanded: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Eight statistics per group of orders, with `loc_id` or with the columns that `expanded` makes it of.

    Orders are exchanged once, and are expanded, folded and walked where they lie. Groups of more than `hot_rows` orders
    are walked in pieces.
    """
    key = BOOK if expanded else GROUP
    plain, suspects = apart_by_bucket(orders, key, hot_rows)
    plain = plain.repartition(*key)
    if expanded:
        plain = expanded(plain)
        ordinary, large = _apart_by_place(suspects, expanded, hot_rows)
        ordinary = ordinary.repartition(*GROUP)
    else:
        # The ordinary rows lie together by their group as they were set apart.
        ordinary, large = apart(suspects, hot_keys(suspects, GROUP, hot_rows), GROUP)
    walk = _walk_order(buy_best_first)
    walked = [_walk(_fold_in_place(part.withColumn("walk", walk), *GROUP)) for part in (plain, ordinary)]
    # What follows from the price is not exchanged with it.
    pieces = large.withColumn("walk", walk).withColumn("piece", _piece()).drop("walk").repartition(*GROUP, "piece").withColumn("walk", walk)
    in_pieces = _statistics(_walk_in_pieces(_fold_in_place(pieces, *GROUP, "piece")))
    parts = [_statistics_in_place(part) for part in walked]
    return parts[0].unionByName(parts[1]).unionByName(in_pieces)


def depth_stats(
    levels: DataFrame, buy_best_first: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Eight statistics per group of price levels.

    Groups of more than `hot_rows` levels are walked in pieces.
    A group without any volume has no averages (NULL).
    """
    levels = levels.withColumn("walk", _walk_order(buy_best_first))
    ordinary, large = apart(levels, hot_keys(levels, GROUP, hot_rows), GROUP)
    return _statistics_in_place(_walk(ordinary)).unionByName(_statistics(_walk_in_pieces(large)))


# -------------------------------------------------------------------- scopes


def aggregate_scope(
    orders: DataFrame,
    scope: str,
    ids: Iterable[int] | None = None,
    stations: DataFrame | None = None,
    buy_best_first: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Statistics per location of a scope: `global`, `region`, `station` or `system`."""
    if scope == "global":
        loc = F.lit(GLOBAL_LOC)
    else:
        loc = F.col(SCOPE_COLUMNS[scope])
        if scope == "system" and stations is not None:
            orders = with_station_system(orders, stations)
        if ids is not None:
            orders = orders.where(loc.isin(list(ids)))
    rows = orders.select("order_set", loc.cast("long").alias("loc_id"), "type_id", "buy", "price", "volume")
    return _stats_of_orders(rows, buy_best_first, hot_rows)


def aggregate_all_scopes(
    orders: DataFrame, stations: DataFrame, hot_rows: int = HOT_ROWS, wanted: DataFrame | None = None
) -> DataFrame:
    """Statistics of every global, region, system and station location in one pass, or of the
    `wanted` (loc_id, type_id) only."""
    if wanted is not None:
        return depth_stats(all_scope_levels(orders, stations, wanted), hot_rows=hot_rows)
    rows = with_station_system(orders, stations, "left").select(
        *BOOK, "price", "volume", "region_id", "system_id", "station_id"
    )
    return _stats_of_orders(rows, True, hot_rows, _at_all_scopes)


def wide_aggregates(aggregates: DataFrame) -> DataFrame:
    """One row per (snapshot, location, type) with sell and buy columns side by side."""
    short = {
        "weighted_average": "wavg",
        "max_price": "max",
        "min_price": "min",
        "stddev": "stddev",
        "median": "median",
        "volume": "volume",
        "order_count": "count",
        "percentile": "fivep",
    }
    columns = []
    for name in STATISTICS:
        kind = "long" if name in ("volume", "order_count") else "decimal(19,2)"
        for side, wanted in (("sell", ~F.col("buy")), ("buy", F.col("buy"))):
            value = F.max(F.when(wanted, F.col(name)))
            columns.append(value.cast(kind).alias(f"{short[name]}_{side}"))
    return aggregates.groupBy("order_set", "loc_id", "type_id").agg(*columns)
