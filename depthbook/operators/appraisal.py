"""Appraisal of pasted item lists, many lists at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthbook.functions import paste
from depthbook.functions.text import only_digits

TYPES_PER_MAP = 1_000
TOTALS = ("pbuy", "mbuy", "psell", "msell", "volume")


def split_blocks(blocks: DataFrame) -> DataFrame:
    """(list_id, block) to one row per line."""
    return blocks.select("list_id", F.explode(F.split("block", "\n")).alias("line"))


def parse_pasted(lines: DataFrame) -> DataFrame:
    """Item name and quantity of each line; blueprint copies are left out."""
    clean, fields = F.col("clean"), F.col("fields")
    return (
        lines.where(~paste.is_skipped(F.col("line")))
        .withColumn("clean", paste.clean_line(F.col("line")))
        .withColumn("fields", paste.read_line(clean))
        .withColumn("name", paste.item_name(fields))
        .withColumn("quantity_text", paste.quantity_text(fields))
        .withColumn("quantity", paste.leading_number(F.col("quantity_text")))
        .drop("clean", "fields")
    )


def rule_counts(lines: DataFrame) -> DataFrame:
    """How many lines each rule decides."""
    kept = lines.where(~paste.is_skipped(F.col("line")))
    return (
        kept.select(paste.clean_line(F.col("line")).alias("clean"))
        .groupBy(paste.rule_number(F.col("clean")).alias("rule"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def tradable(types: DataFrame) -> DataFrame:
    return types.where(F.col("published") & F.col("market_group_id").isNotNull())


def name_index(types: DataFrame) -> DataFrame:
    """Lower-cased name to type id; of equal names the highest id counts."""
    return (
        tradable(types)
        .groupBy(F.lower("type_name").alias("name"))
        .agg(F.max("type_id").alias("type_id"))
    )


def paste_inventory(parsed: DataFrame, types: DataFrame) -> DataFrame:
    """Quantity per list and type. Lines with unknown names are left out.

    Equal names of a list are folded before the join, so a line pasted over and
    over does not weigh on it.
    """
    folded = parsed.groupBy("list_id", "name").agg(F.sum("quantity").alias("quantity"))
    return (
        folded.join(name_index(types), "name")
        .groupBy("list_id", "type_id")
        .agg(F.sum("quantity").alias("quantity"))
    )


# ------------------------------------------------------------ stored lists


def store_lists(inventory: DataFrame) -> DataFrame:
    """Lists as JSON maps type → quantity, in parts of at most TYPES_PER_MAP types."""
    entry = F.struct(F.col("type_id").cast("string"), "quantity")
    return (
        inventory.withColumn("part", F.floor(F.col("type_id") / TYPES_PER_MAP))
        .groupBy("list_id", "part")
        .agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("list"))
    )


def stored_inventory(stored: DataFrame) -> DataFrame:
    pairs = F.from_json("list", "map<string, double>")
    entries = stored.select("list_id", F.explode_outer(pairs).alias("type_text", "quantity"))
    return entries.where(F.col("type_text").isNotNull()).select(
        "list_id", F.col("type_text").cast("long").alias("type_id"), "quantity"
    )


def list_identifiers(stored: DataFrame) -> DataFrame:
    """(list_id, identifier) of stored lists: a digest of the digests of their parts."""
    digests = stored.groupBy("list_id").agg(F.sort_array(F.collect_list(F.sha2("list", 256))).alias("parts"))
    return digests.select(
        "list_id", list_identifier(F.col("list_id").cast("string"), F.array_join("parts", "\n")).alias("identifier")
    )


def identified_lists(stored: DataFrame) -> DataFrame:
    """Stored parts with the identifier of their list."""
    return stored.join(list_identifiers(stored), "list_id")


def list_identifier(*content: Column) -> Column:
    """A stable identifier from the content: running the job again gives the same one."""
    return F.sha2(F.concat_ws("\n", *content), 256)


# ----------------------------------------------------------------- pricing


def valid_requests(requests: DataFrame) -> DataFrame:
    """(list_id, region) requests whose region is a number."""
    return requests.where(only_digits(F.col("region"))).select(
        "list_id", F.col("region").cast("long").alias("loc_id")
    )


def appraise(
    inventory: DataFrame, requests: DataFrame, aggregates: DataFrame, types: DataFrame
) -> DataFrame:
    """Each line of a list priced at the requested location.

    pbuy and psell use the averages of the best five percent, mbuy the highest
    buy and msell the lowest sell price. What is not on the market is worth 0.
    """
    side = {True: F.col("buy"), False: ~F.col("buy")}

    def price(name: str, buy: bool) -> Column:
        return F.max(F.when(side[buy], F.col(name).cast("double")))

    prices = aggregates.groupBy("loc_id", "type_id").agg(
        price("percentile", True).alias("best_buy"),
        price("percentile", False).alias("best_sell"),
        price("max_price", True).alias("max_buy"),
        price("min_price", False).alias("min_sell"),
    )
    named = tradable(types).select("type_id", "type_name", F.col("volume").alias("unit_volume"))
    lines = (
        inventory.join(valid_requests(requests), "list_id")
        .join(named, "type_id", "left")
        .join(prices, ["loc_id", "type_id"], "left")
    )

    def worth(name: str) -> Column:
        return F.col("quantity") * F.coalesce(F.col(name), F.lit(0.0))

    return lines.select(
        "list_id",
        "loc_id",
        "type_id",
        "type_name",
        "quantity",
        worth("best_buy").alias("pbuy"),
        worth("best_sell").alias("psell"),
        worth("max_buy").alias("mbuy"),
        worth("min_sell").alias("msell"),
        worth("unit_volume").alias("volume"),
    )


def _exact_totals() -> list[Column]:
    """Sums in decimals, so that they do not depend on the order of lines."""
    return [F.sum(F.col(t).cast("decimal(30,6)")).cast("decimal(38,6)").alias(t) for t in TOTALS]


def appraisal_totals(lines: DataFrame) -> DataFrame:
    """Sums per list and location."""
    return lines.groupBy("list_id", "loc_id").agg(*_exact_totals())


def appraisal_documents(lines: DataFrame, stored: DataFrame, requests: DataFrame, regions: DataFrame) -> DataFrame:
    """The head of each answer: identifier of the list, name of the region, number of lines, totals.

    Requests for a place that is no region are refused. A list without known items has no lines.
    The lines of an answer are the rows of `lines` with its list and region.
    """
    known = valid_requests(requests).join(
        regions.select(F.col("region_id").alias("loc_id"), "region_name"), "loc_id"
    )
    # Counted and summed up in one pass, as the lines are made for each pass over them.
    sums = lines.groupBy("list_id", "loc_id").agg(F.count("*").alias("n_lines"), *_exact_totals())
    return (
        known.join(list_identifiers(stored), "list_id", "left")
        .join(sums, ["list_id", "loc_id"], "left")
        .select(
            "list_id",
            "loc_id",
            "region_name",
            "identifier",
            F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"),
            *[F.coalesce(t, F.lit(0)).cast("decimal(38,6)").alias(t) for t in TOTALS],
        )
    )
