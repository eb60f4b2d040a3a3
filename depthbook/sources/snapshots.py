"""Snapshot tables and files, aggregates on disk, and what keeps them small.

Data is written first and the manifest row last: a snapshot exists for readers once
the manifest names it. All table writes replace exactly the snapshot they hold, so a
job that is run again leaves one copy.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.functions.constants import (
    BUCKETS,
    RETENTION_DAYS,
    SNAPSHOT_COLUMNS,
    SNAPSHOTS_PER_BUCKET,
)
from depthbook.functions.schemas import MANIFEST, ORDERS
from depthbook.functions.text import file_name, market_key, natural_key

# ------------------------------------------------------------------- tables


def order_set_bucket(order_set: Column) -> Column:
    """Which of the ten table parts a snapshot belongs to."""
    return F.call_function("div", order_set, F.lit(SNAPSHOTS_PER_BUCKET)) % BUCKETS


def _replace_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def append_snapshot(orders: DataFrame, path: str) -> None:
    """Write snapshots to the orders table, each replacing only itself.

    Ranges of types go to separate files, so a query for a type skips the others
    by file statistics; a type that fills many files is cut by price and order.
    """
    placed = (
        orders.withColumn("order_set_bucket", order_set_bucket(F.col("order_set")))
        .repartitionByRange("order_set", "type_id", "price", "order_id")
        .sortWithinPartitions("order_set", "type_id", "price")
    )
    _replace_partitions(placed, path, "order_set_bucket", "order_set")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("order_set_bucket")


def publish_snapshot(spark: SparkSession, path: str, order_set: int, downloaded: datetime) -> None:
    """Name a fully written snapshot in the manifest."""
    row = spark.createDataFrame([(order_set, downloaded)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Published snapshots; one published twice counts once, with its latest time."""
    return (
        spark.read.schema(MANIFEST)
        .parquet(path)
        .groupBy("order_set")
        .agg(F.max("downloaded").alias("downloaded"))
    )


def append_aggregates(aggregates: DataFrame, path: str) -> None:
    """Write aggregates or serving rows; files are evened out per snapshot."""
    _replace_partitions(aggregates.hint("rebalance", "order_set"), path, "order_set")


def retain(
    orders: DataFrame, manifest: DataFrame, now: datetime | Column, days: int = RETENTION_DAYS
) -> DataFrame:
    """Orders of snapshots downloaded within the last `days`."""
    now = now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")
    kept = manifest.where(F.col("downloaded") >= now - F.lit(timedelta(days=days)))
    return orders.join(kept.select("order_set"), "order_set", "left_semi")


# --------------------------------------------------------------- text files


def write_snapshot_tsv(orders: DataFrame, path: str, compression: str = "none") -> None:
    """Tab-separated, no header, quoted only where needed, columns in fixed order."""
    orders.select(*SNAPSHOT_COLUMNS).write.mode("overwrite").csv(
        path, sep="\t", header=False, compression=compression
    )


def read_snapshot_tsv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ORDERS).csv(path, sep="\t", header=False)


def parse_snapshot_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of snapshot files: `file`, `line`, the order in it (`order`), and whether it is broken: not the right
    number of fields, or one that is not of its kind."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDERS) + ", _broken string"
    options = {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    # Expanded once, so that the line is not parsed again for every condition on it.
    parsed = F.from_csv("line", schema, options)
    rows = lines.select("file", "line", F.inline(F.array(F.struct(parsed.alias("order")))))
    # An empty line is no order either, though nothing in it is wrong.
    broken = F.col("order._broken").isNotNull() | F.col("order.order_id").isNull()
    return rows.select("file", "line", broken.alias("broken"), *[f"order.{f.name}" for f in ORDERS.fields])


def snapshot_orders(lines: DataFrame) -> DataFrame:
    """The orders of the lines that could be read."""
    return lines.where(~F.col("broken")).select(*[f.name for f in ORDERS.fields])


def rejected_lines(lines: DataFrame) -> DataFrame:
    """What is kept of the other lines: their file and text."""
    return lines.where("broken").select("file", "line")


def dump_rows(aggregates: DataFrame) -> DataFrame:
    """Aggregates as the public dump shows them: one key column and the statistics."""
    return aggregates.select(
        market_key(F.col("loc_id"), F.col("type_id"), F.col("buy")).alias("what"),
        F.col("weighted_average").alias("weightedaverage"),
        F.col("max_price").alias("maxval"),
        F.col("min_price").alias("minval"),
        "stddev",
        "median",
        F.col("volume").cast("double").alias("volume"),
        F.col("order_count").alias("numorders"),
        F.col("percentile").alias("fivepercent"),
        F.col("order_set").alias("orderSet"),
    )


def write_aggregate_dump(aggregates: DataFrame, path: str) -> None:
    dump_rows(aggregates).write.mode("overwrite").csv(path, header=True, compression="gzip")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths of the packed order-book files below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv.gz")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select("path", "length")


def snapshot_listing(files: DataFrame) -> DataFrame:
    """Base names of files, newest first in natural order (`…-10` before `…-9`)."""
    name = file_name(F.col("path"))
    return files.select(name.alias("name"), "path").orderBy(F.desc(natural_key(F.col("name"))))
