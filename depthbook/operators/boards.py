"""Front-page boards: busiest stations and a fixed list of items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthbook.functions.constants import BOARD_ITEMS, BOARD_STATION
from depthbook.functions.text import minute_text
from depthbook.operators.depth import STATISTICS


def top_stations(orders: DataFrame, stations: DataFrame, side: str, n: int = 10) -> DataFrame:
    """The `n` known stations with the most orders of one side.

    Stations are counted before their names are joined; the limit comes last and
    keeps only `n` rows per task.
    """
    per_station = (
        orders.where(F.col("buy") if side == "buy" else ~F.col("buy"))
        .groupBy("station_id")
        .agg(F.count(F.lit(1)).alias("coun"), F.sum("volume").alias("vol"))
    )
    return (
        per_station.join(stations.select("station_id", "station_name"), "station_id")
        .select("coun", "station_name", "station_id", "vol")
        .orderBy(F.desc("coun"), "station_id")
        .limit(n)
    )


def top_stations_json(orders: DataFrame, stations: DataFrame, side: str, n: int = 10) -> DataFrame:
    """The board as one JSON array; it never holds more than `n` stations."""
    entry = F.struct(
        (-F.col("coun")).alias("rank"),
        "station_id",
        F.struct(
            "coun",
            F.col("station_name").alias("stationName"),
            F.col("station_id").alias("stationID"),
            "vol",
        ).alias("doc"),
    )
    return (
        top_stations(orders, stations, side, n)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            F.lit(side).alias("side"),
            F.to_json(F.transform("entries", lambda e: e.doc)).alias("board"),
        )
    )


def front_page(
    orders: DataFrame, stations: DataFrame, updated: Column | None = None, n: int = 10
) -> DataFrame:
    """Both boards and the time of the update in one row; `updated` is now by default."""
    moment = F.current_timestamp() if updated is None else updated
    sell = top_stations_json(orders, stations, "sell", n).select(F.col("board").alias("fp_sell"))
    buy = top_stations_json(orders, stations, "buy", n).select(F.col("board").alias("fp_buy"))
    # One row each.
    return sell.select(
        "fp_sell", buy.scalar().alias("fp_buy"), minute_text(moment).alias("fp_lastupdate")
    )


def item_board(
    aggregates: DataFrame,
    locs: Sequence[int] = (BOARD_STATION,),
    items: Sequence[tuple[int, str]] = BOARD_ITEMS,
) -> DataFrame:
    """Both sides of a fixed list of items at fixed locations; what is not traded is zero.

    `aggregates` hold one row per location, type and side, see `lookup.live_statistics`.
    """
    spark = aggregates.sparkSession
    wanted = spark.createDataFrame(
        [(loc, place, item, label) for loc in locs for place, (item, label) in enumerate(items)],
        "loc_id long, place int, type_id long, label string",
    )
    columns = []
    for side, match in (("buy", F.col("buy")), ("sell", ~F.col("buy"))):
        for name in STATISTICS:
            value = F.max(F.when(match, F.col(name).cast("double")))
            columns.append(value.alias(f"{side}_{name}"))
    traded = (
        aggregates.where(
            F.col("type_id").isin([item for item, _ in items]) & F.col("loc_id").isin(list(locs))
        )
        .groupBy("loc_id", "type_id")
        .agg(*columns)
    )
    shown = [c for c in traded.columns if c not in ("loc_id", "type_id")]
    return wanted.join(traded, ["loc_id", "type_id"], "left").select(
        "loc_id",
        "place",
        "type_id",
        "label",
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in shown],
    )
