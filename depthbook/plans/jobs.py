"""The whole load of one snapshot: landed pages to every table that is served."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.operators.boards import front_page
from depthbook.operators.depth import aggregate_all_scopes
from depthbook.operators.lookup import serving_rows
from depthbook.sources.pages import elements_of, orders_of, page_accounts, read_pages, rejected
from depthbook.sources.snapshots import (
    append_aggregates,
    append_snapshot,
    publish_snapshot,
    read_manifest,
    read_snapshots,
    write_aggregate_dump,
)


def load_snapshot(
    spark: SparkSession,
    landed: str,
    root: str,
    order_set: int,
    downloaded: datetime,
    stations: DataFrame,
    regions: DataFrame,
) -> None:
    """Load the pages under `landed` as snapshot `order_set` into the tables under `root`.

    Pages are parsed once, into a staged table of their elements. Orders are written, then published; aggregates follow and are served once
    written. Running it again replaces the snapshot. Each step starts from what the
    one before it stored.
    """
    staged = f"{root}/elements/order_set={order_set}"
    elements_of(read_pages(spark, landed)).write.mode("overwrite").parquet(staged)
    elements = spark.read.parquet(staged)
    append_snapshot(orders_of(elements, order_set), f"{root}/orders")
    rejected(elements).write.mode("overwrite").parquet(f"{root}/quarantine/order_set={order_set}")
    page_accounts(elements).write.mode("overwrite").parquet(f"{root}/pages/order_set={order_set}")
    publish_snapshot(spark, f"{root}/manifest", order_set, downloaded)

    this = F.col("order_set") == order_set
    orders = read_snapshots(spark, f"{root}/orders").where(this)
    append_aggregates(aggregate_all_scopes(orders, stations), f"{root}/aggregates")

    stored = spark.read.parquet(f"{root}/aggregates").where(this)
    manifest = read_manifest(spark, f"{root}/manifest").where(this)
    append_aggregates(serving_rows(stored, manifest), f"{root}/serving")
    of_regions = stored.join(
        regions.select(F.col("region_id").alias("loc_id")), "loc_id", "left_semi"
    )
    write_aggregate_dump(of_regions, f"{root}/dump/order_set={order_set}")
    front_page(orders, stations).write.mode("overwrite").json(f"{root}/front/order_set={order_set}")
