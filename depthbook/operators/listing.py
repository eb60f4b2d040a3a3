"""Order listings by type and place, order history, and paged market views."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthbook.functions.constants import EMPIRE_CLASS
from depthbook.operators.skew import HOT_ROWS, with_position

PAGE_ORDERS = 1_000


@dataclass(frozen=True)
class Dimensions:
    """Lookup tables of the listings. None is hinted: Spark broadcasts what is small."""

    stations: DataFrame
    types: DataFrame
    regions: DataFrame
    systems: DataFrame | None = None
    region_class: DataFrame | None = None
    hubs: DataFrame | None = None


def latest_order_set(manifest: DataFrame) -> DataFrame:
    """The newest published snapshot id, one row."""
    return manifest.agg(F.max("order_set").alias("order_set"))


def current_orders(orders: DataFrame, manifest: DataFrame) -> DataFrame:
    """Orders of the newest published snapshot; prunes partitions of a table split by snapshot."""
    return orders.where(F.col("order_set") == latest_order_set(manifest).scalar())


def _of_side(orders: DataFrame, side: str) -> DataFrame:
    return orders.where(F.col("buy") if side == "buy" else ~F.col("buy"))


def _named(orders: DataFrame, dims: Dimensions) -> DataFrame:
    """Orders with station, type and region names; an unknown id drops the order."""
    stations = dims.stations.select("station_id", "station_name", "system_id")
    return (
        orders.drop("system_id")
        .join(stations, "station_id")
        .join(dims.types.select("type_id", "type_name"), "type_id")
        .join(dims.regions.select("region_id", "region_name"), "region_id")
    )


def _columns(side: str, *extra: str) -> list[str]:
    ranged = ["range"] if side == "buy" else []
    return [
        "order_id",
        "type_id",
        "issued",
        "volume",
        "volume_entered",
        "min_volume",
        "price",
        "station_id",
        *ranged,
        "duration",
        "station_name",
        "type_name",
        "region_name",
        *extra,
    ]


def _best_price_first(side: str) -> Column:
    return F.desc("price") if side == "buy" else F.asc("price")


# Orders of equal price and region follow each other by these.
TIES = ["order_id", "station_id", "volume", "issued", "range"]


def order_listing(
    orders: DataFrame,
    dims: Dimensions,
    side: str,
    scope: str = "all",
    type_id: int | None = None,
    scope_id: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Orders of one side, best price first within each listing.

    scope: `all`, `region`, `station`, `empire`, `hub`, or `api` (a region or 0 for
    all, prices rounded to cents, with system and security).

    With `type_id` (and `scope_id` for a region or station) this is one sorted
    listing. Without, it is the listings of all types (and regions or stations), and
    each order has its `position` in its listing instead of a sort of everything.
    """
    rows = _of_side(orders, side)
    listing_key = ["type_id"]
    if type_id is not None:
        rows = rows.where(F.col("type_id") == type_id)
    if scope in ("region", "station"):
        listing_key = [f"{scope}_id", "type_id"]
        if scope_id is not None:
            rows = rows.where(F.col(f"{scope}_id") == scope_id)
    elif scope == "api" and scope_id:
        rows = rows.where(F.col("region_id") == scope_id)
    elif scope == "empire":
        empire = dims.region_class.where(F.col("region_type") <= EMPIRE_CLASS)
        rows = rows.join(empire.select("region_id"), "region_id", "left_semi")
    elif scope == "hub":
        rows = rows.join(dims.hubs.select("station_id"), "station_id", "left_semi")
    one_listing = type_id is not None and (len(listing_key) == 1 or scope_id is not None)

    named = _named(rows, dims)
    chosen = _columns(side, "region_id")
    if scope == "api":
        named = named.join(dims.systems.select("system_id", "security"), "system_id")
        named = named.withColumn("price", F.round("price", 2).cast("decimal(19,2)"))
        chosen = _columns(side, "region_id", "security", "system_id")
    order = [_best_price_first(side), "region_id", *TIES]
    if one_listing:
        return named.orderBy(*order).select(*chosen)
    # Joins only drop orders, so hot listings can be found before them.
    placed = with_position(named, listing_key, order, side == "buy", hot_rows, counted=rows)
    return placed.select(*chosen, "position")


def order_history(
    orders: DataFrame,
    dims: Dimensions,
    side: str,
    order_id: int | None = None,
) -> DataFrame:
    """An order through all snapshots, newest first.

    Without `order_id` the histories of all orders, with the `position` in each.
    """
    rows = _of_side(orders, side)
    order = [F.desc("order_set"), "type_id", "price", "region_id", *TIES]
    chosen = _columns(side, "order_set")
    if order_id is not None:
        found = rows.where(F.col("order_id") == order_id)
        return _named(found, dims).orderBy(*order).select(*chosen)
    # A history has a row per snapshot and feed, so no group is large.
    history = Window.partitionBy("order_id").orderBy(*order)
    placed = _named(rows, dims).withColumn("position", F.row_number().over(history).cast("long"))
    return placed.select(*chosen, "position")


def distinct_orders(orders: DataFrame) -> DataFrame:
    """One row per order and snapshot, for orders that more than one feed delivered.

    The row kept is the one with the smallest (region, station, type, price, volume).
    """
    rest = [c for c in orders.columns if c not in ("order_set", "order_id")]
    lead = [c for c in ("region_id", "station_id", "type_id", "price", "volume") if c in rest]
    ordered = lead + [c for c in rest if c not in lead]
    # A rank of one keeps a row per key in each task before the shuffle; a minimum of
    # whole rows would sort both before and after it.
    same = Window.partitionBy("order_set", "order_id").orderBy(*ordered)
    return orders.withColumn("copy", F.row_number().over(same)).where("copy = 1").drop("copy")


def _document_order(side: str) -> Column:
    """One order of a view document; decimals and times are texts, as the API gives them."""
    names = _columns(side, "region_id", "security", "system_id")
    as_text = {
        "issued": F.date_format("issued", "yyyy-MM-dd HH:mm:ss"),
        "price": F.col("price").cast("string"),
        "security": F.col("security").cast("string"),
    }
    return F.struct(*[as_text.get(n, F.col(n)).alias(n) for n in names])


def market_view_pages(
    orders: DataFrame,
    dims: Dimensions,
    side: str,
    region_id: int = 0,
    type_id: int | None = None,
    page_orders: int = PAGE_ORDERS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The view document of each type, split into pages of at most `page_orders` orders.

    A type may have more orders than one row can hold, so a document is a run of
    pages: type_id, type_name, order_set, side, page, n_orders, orders (JSON array).
    """
    rows = _of_side(orders, side)
    if type_id is not None:
        rows = rows.where(F.col("type_id") == type_id)
    if region_id:
        rows = rows.where(F.col("region_id") == region_id)
    named = (
        _named(rows, dims)
        .join(dims.systems.select("system_id", "security"), "system_id")
        .withColumn("price", F.round("price", 2).cast("decimal(19,2)"))
    )
    order = [_best_price_first(side), "region_id", *TIES]
    group = ["order_set", "type_id"]
    placed = with_position(named, group, order, side == "buy", hot_rows, counted=rows)
    page = F.floor((F.col("position") - 1) / page_orders)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", "doc"))), lambda e: e.doc)
    return (
        placed.withColumn("page", page)
        .withColumn("doc", _document_order(side))
        .groupBy("order_set", "type_id", "page")
        .agg(
            F.max("type_name").alias("type_name"),
            F.count(F.lit(1)).alias("n_orders"),
            F.to_json(listed).alias("orders"),
        )
        .withColumn("side", F.lit(side))
    )


def market_view_headers(orders: DataFrame, dims: Dimensions, order_set: Column | int) -> DataFrame:
    """What stands above the pages of a view: every known type with its name, the snapshot and the
    number of orders of each side, also where a side, or both, have none."""
    shown = _named(orders, dims).join(dims.systems.select("system_id"), "system_id")
    counts = shown.groupBy("type_id").agg(
        F.count_if("buy").alias("n_buy"), F.count_if(~F.col("buy")).alias("n_sell")
    )
    number = order_set if isinstance(order_set, Column) else F.lit(order_set)
    return dims.types.join(counts, "type_id", "left").select(
        "type_id",
        "type_name",
        number.alias("order_set"),
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_buy", "n_sell")],
    )
