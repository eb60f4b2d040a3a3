"""Serving rows and bulk lookups of aggregates by location and type."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthbook.functions.constants import AGGREGATE_TTL_SECONDS, STATISTIC_NAMES
from depthbook.functions.text import market_key, payload, payload_field, with_number_texts
from depthbook.operators.depth import STATISTICS

REQUEST_COLUMNS = ("region", "station", "system", "types")
KEY = ["loc_id", "type_id", "buy"]


# ------------------------------------------------------------- serving rows


def _with_texts(rows: DataFrame) -> DataFrame:
    """Rows with their statistics as texts: the count is a whole number, all else a float."""
    texts = with_number_texts(rows, *[n for n in STATISTICS if n != "order_count"])
    return texts.withColumn("order_count", F.col("order_count").cast("string"))


def serving_rows(aggregates: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """Key and payload per aggregate; with a manifest also the time the row expires.

    Payload fields keep the order of STATISTICS. The level count is written as an
    integer, all else as a float.
    """
    key = market_key(F.col("loc_id"), F.col("type_id"), F.col("buy"))
    texts = _with_texts(aggregates.select("order_set", key.alias("key"), *STATISTICS))
    rows = texts.select("order_set", "key", payload(*map(F.col, STATISTICS)).alias("payload"))
    if manifest is None:
        return rows
    expiry = manifest.select("order_set", _expiry("downloaded").alias("expires_at"))
    return rows.join(expiry, "order_set")


def decode_serving_rows(rows: DataFrame) -> DataFrame:
    """Serving rows back to typed columns."""
    parts = F.split("key", "[|]")
    return rows.select(
        "order_set",
        F.get(parts, F.lit(0)).cast("long").alias("loc_id"),
        F.get(parts, F.lit(1)).cast("long").alias("type_id"),
        F.get(parts, F.lit(2)).cast("boolean").alias("buy"),
        *[payload_field(F.col("payload"), i).alias(name) for i, name in enumerate(STATISTICS)],
    )


def _newest(rows: DataFrame, *key: str) -> DataFrame:
    """The row of the newest snapshot per key. A rank of one drops older rows before the shuffle."""
    latest = Window.partitionBy(*key).orderBy(F.desc("order_set"))
    return rows.withColumn("age", F.row_number().over(latest)).where("age = 1").drop("age")


def _expiry(column: str) -> Column:
    return F.col(column) + F.make_dt_interval(secs=F.lit(AGGREGATE_TTL_SECONDS))


def _moment(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp_ntz")


def live_aggregates(history: DataFrame, now: datetime | Column) -> DataFrame:
    """The newest serving row per key that has not expired at `now`."""
    alive = history.where(F.col("expires_at") >= _moment(now))
    return _newest(alive, "key").select("key", "order_set", "payload", "expires_at")


def live_snapshots(manifest: DataFrame, now: datetime | Column) -> DataFrame:
    """Snapshots whose aggregates have not expired at `now`."""
    return manifest.where(_expiry("downloaded") >= _moment(now)).select("order_set")


def live_statistics(aggregates: DataFrame, manifest: DataFrame, now: datetime | Column) -> DataFrame:
    """What lookups, boards and appraisals read: per location, type and side the newest
    aggregates that have not expired. A key that the newest snapshot lacks is still served."""
    alive = aggregates.join(live_snapshots(manifest, now), "order_set", "left_semi")
    return _newest(alive, "loc_id", "type_id", "buy")


# ------------------------------------------------------------------ lookups


def resolve_requests(requests: DataFrame) -> DataFrame:
    """Location and type tokens of each request.

    A request names its place as region, station or system, the first one given
    counts, none means 0. The same fields of a request body (`body_…`) take over,
    but only if the body names types.
    """
    body = {name: F.col(f"body_{name}") for name in REQUEST_COLUMNS}
    has_body = body["types"].isNotNull()
    place = F.coalesce(
        F.when(has_body, F.coalesce(body["region"], body["station"], body["system"])),
        "region",
        "station",
        "system",
        F.lit("0"),
    )
    types = F.when(has_body, body["types"]).otherwise(F.col("types"))
    tokens = F.array_distinct(F.filter(F.split(types, ","), lambda t: t != ""))
    return requests.select("request_id", place.alias("place"), F.explode(tokens).alias("token"))


def _exact_id(text: Column) -> Column:
    """The id a text stands for; texts that are no plain number match nothing."""
    return F.when(text.rlike("^(0|[1-9][0-9]*)$"), text.try_cast("long"))


def _requested(requests: DataFrame) -> DataFrame:
    """The tokens of each request with the ids they stand for."""
    return (
        resolve_requests(requests)
        .withColumn("loc_id", _exact_id(F.col("place")))
        .withColumn("type_id", _exact_id(F.col("token")))
    )


def wanted_keys(requests: DataFrame) -> DataFrame:
    """Every (loc_id, type_id) that is asked for, once: what has to be aggregated to answer."""
    return _requested(requests).select("loc_id", "type_id").dropna().distinct()


def lookup_aggregates(requests: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Both sides of every requested type; what is not on the market is zero.

    `aggregates` hold one row per location, type and side, see `live_statistics`; of `wanted_keys`
    are enough.
    """
    wanted = _requested(requests).withColumn("buy", F.explode(F.array(F.lit(True), F.lit(False))))
    known = aggregates.select("loc_id", "type_id", "buy", *STATISTICS)
    numbers = [F.coalesce(F.col(n).cast("double"), F.lit(0.0)).alias(n) for n in STATISTICS]
    return wanted.join(known, KEY, "left").select(
        "request_id",
        "place",
        "token",
        F.when(F.col("buy"), "buy").otherwise("sell").alias("side"),
        *numbers,
    )


def store_for_lookup(aggregates: DataFrame, table: str, path: str, buckets: int | None = None) -> None:
    """Keep live statistics as a table bucketed and sorted by what lookups join on, so that a
    batch of requests is exchanged and the table is not. A bucket is written, and later joined, by one
    task: without `buckets` there are as many as the session has shuffle partitions."""
    buckets = buckets or int(aggregates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(k) for k in KEY]
    rows = aggregates.select(*KEY, *STATISTICS).repartition(buckets, *keys)
    writer = rows.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY)
    writer.option("path", path).saveAsTable(table)


def lookup_document(requests: DataFrame, aggregates: DataFrame) -> DataFrame:
    """One JSON entry `{"buy": {…}, "sell": {…}}` per requested type.

    Numbers are texts, missing ones the number 0 in text form. Entries are kept
    apart: a request may ask for more types than one row can hold.
    """
    found = lookup_aggregates(requests, aggregates).withColumn(
        "order_count", F.col("order_count").cast("long")
    )
    found = _with_texts(found.select("request_id", "token", "side", *STATISTICS))
    texts = [
        F.when(F.col(name).isin("0", "0.0"), "0").otherwise(F.col(name)).alias(label)
        for name, label in zip(STATISTICS, STATISTIC_NAMES, strict=True)
    ]
    sides = {s: F.max(F.when(F.col("side") == s, F.col("doc"))) for s in ("buy", "sell")}
    entry = F.struct(sides["buy"].alias("buy"), sides["sell"].alias("sell"))
    return (
        found.select("request_id", "token", "side", F.struct(*texts).alias("doc"))
        .groupBy("request_id", "token")
        .agg(F.to_json(entry).alias("entry"))
    )
