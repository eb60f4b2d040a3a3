"""Dictionaries, market groups and upkeep of reference data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthbook.functions.constants import (
    FIRST_REGION,
    FIRST_STRUCTURE_ID,
    LAST_REGION,
    MARKET_STRUCTURE_TYPES,
    REGIONS_WITHOUT_FEED,
    SELECTABLE_REGIONS_BELOW,
    UNSELECTABLE_REGIONS,
)
from depthbook.functions.session import checkpointed

# ------------------------------------------------------------ dictionaries


def _dictionary(rows: DataFrame, value: str, label: str, by_locale: bool) -> DataFrame:
    chosen = rows.select(F.col(value).alias("value"), F.col(label).alias("label"))
    by_name = F.collate("label", "UNICODE_CI") if by_locale else F.col("label")
    return chosen.orderBy(by_name, "value")


def positions_by_locale(entries: DataFrame) -> DataFrame:
    """Entries (value, label) with their `position`, from 1, in the order of the language's rules: letters first, then
    accents, case not at all; equal labels by value.

    Entries are split into ranges by the collation's own order and written once; a range is numbered by itself and goes
    on from the counts of the ranges before it, of which there is a row each.
    """
    order = [F.collate("label", "UNICODE_CI"), F.col("value")]
    ranged = checkpointed(entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranged.join(starts, "part").select("value", "label", (F.col("before") + place).alias("position"))


def dict_types(types: DataFrame, by_locale: bool = False) -> DataFrame:
    """Types with a market group, also unpublished ones."""
    listed = types.where(F.col("market_group_id").isNotNull())
    return _dictionary(listed, "type_id", "type_name", by_locale)


def dict_regions(regions: DataFrame, by_locale: bool = False) -> DataFrame:
    region = F.col("region_id")
    listed = regions.where(
        (region < SELECTABLE_REGIONS_BELOW) & ~region.isin(*UNSELECTABLE_REGIONS)
    )
    return _dictionary(listed, "region_id", "region_name", by_locale)


def dict_stations(stations: DataFrame, by_locale: bool = False) -> DataFrame:
    return _dictionary(stations, "station_id", "station_name", by_locale)


def search_types(types: DataFrame, term: str) -> DataFrame:
    """Entries of the type dictionary whose name holds `term`, two characters at least."""
    found = F.lower("label").contains(term.lower()) if len(term) >= 2 else F.lit(False)
    return dict_types(types).where(found)


def _grams(text: Column, size: Column) -> Column:
    """All runs of `size` characters of a text; a shorter text is its own run."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.transform(places, lambda i: F.substring(text, i, size))


def search_index(types: DataFrame) -> DataFrame:
    """Postings of the type dictionary: every run of two and of three characters of a name, in lower case, with the
    entry (gram, value), once each."""
    grams = [_grams(F.lower("label"), F.lit(n)) for n in (2, 3)]
    return dict_types(types).select("value", F.explode(F.array_distinct(F.concat(*grams))).alias("gram"))


def search_many(types: DataFrame, index: DataFrame, terms: DataFrame) -> DataFrame:
    """Entries (term, value, label) whose name holds the term, for a table of terms; terms of one character find nothing.

    A term meets the postings of its rarest gram only, and what they name is compared with the whole term. A gram that no
    name has ends the search.
    """
    low = F.lower("term")
    asked = terms.where(F.length("term") >= 2).select("term").distinct()
    runs = _grams(low, F.least(F.length(low), F.lit(3)))
    asked = asked.select("term", F.explode(F.array_distinct(runs)).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = asked.join(counts, "gram", "left").groupBy("term").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best")
    )
    found = rarest.select("term", "best.gram").join(index, "gram").join(dict_types(types), "value")
    return found.where(F.lower("label").contains(low)).select("term", "value", "label")


def in_region_universe(region: Column) -> Column:
    """Regions that have a feed."""
    return region.between(FIRST_REGION, LAST_REGION) & ~region.isin(*REGIONS_WITHOUT_FEED)


def region_universe(spark: SparkSession) -> DataFrame:
    """All regions a snapshot asks for."""
    every = spark.range(FIRST_REGION, LAST_REGION + 1).withColumnRenamed("id", "region_id")
    return every.where(in_region_universe(F.col("region_id")))


# ------------------------------------------------------------ market groups


def group_children(groups: DataFrame, parent: int | None = None) -> DataFrame:
    """Groups below `parent` (0: the roots) by name; below every group without `parent`."""
    above = F.coalesce(F.col("parent_group_id"), F.lit(0))
    rows = groups
    if parent == 0:
        rows = groups.where(F.col("parent_group_id").isNull())
    elif parent is not None:
        rows = groups.where(F.col("parent_group_id") == parent)
    return rows.select(
        above.alias("opened_group_id"),
        "parent_group_id",
        "market_group_id",
        "group_name",
        "icon_id",
        "has_types",
    ).orderBy("opened_group_id", "group_name", "market_group_id")


def group_types(types: DataFrame, parent: int | None = None) -> DataFrame:
    """Types of `parent`, or of every group, by name."""
    rows = types.where(F.col("market_group_id").isNotNull())
    if parent is not None:
        rows = rows.where(F.col("market_group_id") == parent)
    return rows.select("market_group_id", "type_id", "type_name", "icon_id").orderBy(
        "market_group_id", "type_name", "type_id"
    )


def group_documents(groups: DataFrame, types: DataFrame) -> DataFrame:
    """One answer per opened group (0: the roots) as JSON: its groups, its types, its id.

    Both lists are parts of the catalogue of one group, which does not grow with the orders.
    """
    below = group_children(groups).select(
        "opened_group_id",
        F.struct(
            F.col("group_name").alias("marketGroupName"),
            F.col("market_group_id").alias("marketGroupID"),
            F.col("icon_id").alias("iconID"),
            F.col("has_types").alias("hasTypes"),
        ).alias("entry"),
    )
    inside = group_types(types).select(
        F.col("market_group_id").alias("opened_group_id"),
        F.struct(
            F.col("type_name").alias("typeName"), F.col("type_id").alias("typeID"), F.col("icon_id").alias("iconID")
        ).alias("entry"),
    )
    parts = [
        rows.groupBy("opened_group_id").agg(F.sort_array(F.collect_list("entry")).alias(name))
        for rows, name in ((below, "marketgroups"), (inside, "types"))
    ]
    both = parts[0].join(parts[1], "opened_group_id", "full_outer")
    empty = {name: F.coalesce(name, F.array()).alias(name) for name in ("marketgroups", "types")}
    document = F.struct(*empty.values(), F.col("opened_group_id").alias("groupid"))
    return both.select("opened_group_id", F.to_json(document).alias("document"))


def group_tree(groups: DataFrame) -> DataFrame:
    """Every group with its depth, its root and the path of names from the root.

    One join per level of the tree, as long as a level has groups. Each level is
    written down, so the plan does not grow with the depth.
    """
    columns = ["market_group_id", "group_name", "depth", "root_group_id", "path"]
    roots = groups.where(F.col("parent_group_id").isNull()).select(
        "market_group_id",
        "group_name",
        F.lit(0).alias("depth"),
        F.col("market_group_id").alias("root_group_id"),
        F.col("group_name").alias("path"),
    )
    below = groups.where(F.col("parent_group_id").isNotNull()).select(
        F.col("parent_group_id").alias("parent"),
        F.col("market_group_id").alias("child"),
        F.col("group_name").alias("child_name"),
    )
    level = checkpointed(roots)
    tree = level
    while not level.isEmpty():
        level = checkpointed(
            level.join(below, F.col("market_group_id") == F.col("parent")).select(
                F.col("child").alias("market_group_id"),
                F.col("child_name").alias("group_name"),
                (F.col("depth") + 1).alias("depth"),
                "root_group_id",
                F.concat_ws("/", "path", "child_name").alias("path"),
            )
        )
        tree = tree.unionByName(level)
    return tree.select(*columns)


# ------------------------------------------------------------------- upkeep

# Columns a known type takes over from a fetched record.
UPDATED = {
    "type_name": "name",
    "group_id": "group_id",
    "market_group_id": "market_group_id",
    "capacity": "capacity",
    "published": "published",
    "portion_size": "portion_size",
    "volume": "volume",
}


def upsert_types(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """A new version of the types table.

    A known type takes over the columns of UPDATED, absent ones become NULL and an
    absent `published` false; a record without name or volume changes nothing. An
    unknown type is added with its mass, provided it has a name.
    """
    fields = [c for c in incoming.columns if c != "type_id"]
    best = Window.partitionBy("type_id").orderBy(
        F.desc(F.col("volume").isNotNull()), *[F.desc(c) for c in fields]
    )
    fetched = (
        incoming.where(F.col("name").isNotNull())
        .withColumn("copy", F.row_number().over(best))
        .where("copy = 1")
        .select("type_id", F.struct(*fields).alias("new"))
    )
    old = current.withColumn("known", F.lit(True))
    joined = old.join(fetched, "type_id", "full_outer")
    is_new = F.col("known").isNull()
    takes = F.col("new").isNotNull() & (is_new | F.col("new.volume").isNotNull())
    columns = [F.col("type_id")]
    for name in current.columns:
        if name == "type_id":
            continue
        if name in UPDATED:
            value = F.col(f"new.{UPDATED[name]}")
            if name == "published":
                value = F.coalesce(value, F.lit(False))
            columns.append(F.when(takes, value).otherwise(F.col(name)).alias(name))
        elif name == "mass":
            columns.append(F.when(is_new, F.col("new.mass")).otherwise(F.col("mass")).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def missing_types(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Type ids that were asked for and did not arrive: the list of the second pass."""
    return wanted.select("type_id").distinct().join(landed.select("type_id"), "type_id", "left_anti")


def append_delivery(spark: SparkSession, path: str, delivered: DataFrame, number: int, at: datetime) -> None:
    """Merge a delivery of type records into the catalogue kept under `path`.

    Only the types it changes or adds are written, as rows of the delivery; a repeated delivery writes the same.
    """
    merged = upsert_types(catalogue(spark, path, number - 1), delivered)
    _write_delivery(merged.subtract(catalogue(spark, path, number - 1).select(*merged.columns)), path, number, at)


def start_catalogue(types: DataFrame, path: str, at: datetime) -> None:
    """The catalogue before any delivery; it has number 0."""
    _write_delivery(types, path, 0, at)


def _write_delivery(rows: DataFrame, path: str, number: int, at: datetime) -> None:
    stamped = rows.withColumn("valid_from", F.lit(at).cast("timestamp_ntz"))
    stamped.write.mode("overwrite").parquet(f"{path}/delivery={number}")


def catalogue(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The types as a delivery left them: of every type the row of the last delivery that changed it."""
    rows = spark.read.parquet(path).where(F.col("delivery") <= number)
    fields = [c for c in rows.columns if c not in ("type_id", "valid_from", "delivery")]
    last = rows.groupBy("type_id").agg(F.max_by(F.struct(*fields), "delivery").alias("row"))
    return last.select("type_id", "row.*")


def catalogue_history(spark: SparkSession, path: str) -> DataFrame:
    """Every version of every type, from when and until when it held (NULL: still)."""
    following = Window.partitionBy("type_id").orderBy("delivery")
    rows = spark.read.parquet(path)
    return rows.withColumn("valid_to", F.lead("valid_from").over(following)).drop("delivery")


def structure_regions(stations: DataFrame, systems: DataFrame) -> DataFrame:
    """Structures whose own feed has to be read, with their region."""
    structures = stations.where(F.col("station_id") > FIRST_STRUCTURE_ID)
    return structures.join(systems.select("system_id", "region_id"), "system_id").select(
        "station_id", "region_id"
    )


def new_structures(details: DataFrame, market: DataFrame, stations: DataFrame) -> DataFrame:
    """Station rows of structures that can have a market, show one and are not known yet.

    `details`: structure_id, status and the fields of the structure document.
    `market`: structure_id and status of the first page of its market.
    """
    readable = market.where(F.col("status") == 200).select("structure_id")
    rows = (
        details.where((F.col("status") == 200) & F.col("type_id").isin(*MARKET_STRUCTURE_TYPES))
        .join(readable, "structure_id", "left_semi")
        .select(
            F.col("structure_id").alias("station_id"),
            F.col("name").alias("station_name"),
            F.col("type_id").alias("station_type_id"),
            F.col("solar_system_id").alias("system_id"),
            F.col("position.x").alias("x"),
            F.col("position.y").alias("y"),
            F.col("position.z").alias("z"),
        )
    )
    return rows.join(stations.select("station_id"), "station_id", "left_anti")
