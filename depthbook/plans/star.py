"""Market views over the star schema in which the test tables come.

Every view is row-local or a plain join or distinct, so it keeps its shape on any
scale. Market group ids come from a digest of the category name: no ranking over
all rows is needed to number them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthbook.functions.session import new_path

HUB_SUPPLIERS = (1, 2, 3, 5, 8)
PAGE_ORDER = ["order_id", "type_id", "station_id", "volume", "price", "issued"]

# Given, so that opening a table needs no job to look into its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _category_id(name: str):
    return F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("int")


class Market:
    """Lazily built views over one folder of star-schema tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def orders(self) -> DataFrame:
        volume = F.col("l_quantity").cast("long")
        # One dimension at a time: the size of a joined dimension is only guessed,
        # and the guess can turn the fact table into the broadcast side.
        return (
            self.table("lineitem")
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("type_id"),
                F.col("l_shipdate").alias("issued"),
                (F.col("l_linestatus") == "O").alias("buy"),
                volume.alias("volume"),
                (volume + F.col("l_linenumber")).alias("volume_entered"),
                F.lit(1).cast("long").alias("min_volume"),
                F.greatest(F.lit(1.0), F.floor(F.col("l_extendedprice") / 100))
                .cast("decimal(19,4)")
                .alias("price"),
                (60000000 + F.col("l_suppkey")).alias("station_id"),
                F.when(F.col("l_returnflag") == "A", "station")
                .when(F.col("l_returnflag") == "N", "region")
                .otherwise("5")
                .alias("range"),
                F.lit(90).alias("duration"),
                (10000000 + F.col("n_regionkey")).alias("region_id"),
                (30000000 + F.col("s_nationkey")).alias("system_id"),
                F.col("l_linenumber").alias("order_set"),
            )
        )

    @property
    def manifest(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(F.col("l_linenumber").alias("order_set"))
            .distinct()
            .withColumn(
                "downloaded",
                F.expr(
                    "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 30 * order_set)"
                ),
            )
        )

    @property
    def types(self) -> DataFrame:
        group = 100 * _category_id("p_type") + F.substring("p_brand", 7, 9).cast("int")
        return self.table("part").select(
            F.col("p_partkey").alias("type_id"),
            F.concat("p_name", F.lit(" mk"), F.col("p_partkey").cast("string")).alias("type_name"),
            (F.col("p_size") / 10.0).alias("volume"),
            (F.col("p_size") % 7 != 0).alias("published"),
            F.when(F.col("p_size") % 10 != 0, group).alias("market_group_id"),
            (F.col("p_size") * 10).alias("icon_id"),
        )

    @property
    def spelled_types(self) -> DataFrame:
        """The types in mixed case and with accents."""
        name, number = F.col("type_name"), F.col("type_id")
        spelled = F.when(number % 3 == 0, F.upper(name)).when(number % 3 == 1, F.translate(name, "aoi", "áöî"))
        return self.types.withColumn("type_name", F.coalesce(spelled, F.initcap(name)))

    @property
    def groups(self) -> DataFrame:
        category = _category_id("p_type")
        part = self.table("part")
        leaves = part.select(
            (100 * category + F.substring("p_brand", 7, 9).cast("int")).alias("market_group_id"),
            category.alias("parent_group_id"),
            F.col("p_brand").alias("group_name"),
            (category % 100).alias("icon_id"),
            F.lit(True).alias("has_types"),
        )
        roots = part.select(
            category.alias("market_group_id"),
            F.lit(None).cast("int").alias("parent_group_id"),
            F.col("p_type").alias("group_name"),
            (category % 100).alias("icon_id"),
            F.lit(False).alias("has_types"),
        )
        return leaves.distinct().unionByName(roots.distinct())

    @property
    def stations(self) -> DataFrame:
        return (
            self.table("supplier")
            .where(F.col("s_suppkey") % 17 != 0)  # some orders sit at unknown stations
            .select(
                (60000000 + F.col("s_suppkey")).alias("station_id"),
                F.col("s_name").alias("station_name"),
                (30000000 + F.col("s_nationkey")).alias("system_id"),
            )
        )

    @property
    def systems(self) -> DataFrame:
        return self.table("nation").select(
            (30000000 + F.col("n_nationkey")).alias("system_id"),
            (10000000 + F.col("n_regionkey")).alias("region_id"),
            ((F.col("n_nationkey") % 13 - 2).cast("decimal(9,1)") / 10)
            .cast("decimal(9,1)")
            .alias("security"),
        )

    @property
    def regions(self) -> DataFrame:
        return self.table("region").select(
            (10000000 + F.col("r_regionkey")).alias("region_id"),
            F.col("r_name").alias("region_name"),
        )

    @property
    def region_class(self) -> DataFrame:
        return self.table("region").select(
            (10000000 + F.col("r_regionkey")).alias("region_id"),
            (F.col("r_regionkey") + 1).alias("region_type"),
        )

    @property
    def hubs(self) -> DataFrame:
        return (
            self.table("supplier")
            .where(F.col("s_suppkey").isin(*HUB_SUPPLIERS))
            .select((60000000 + F.col("s_suppkey")).alias("station_id"))
        )

    @property
    def pasted(self) -> DataFrame:
        """Pasted lines with the quantity each must yield."""
        known = self.types.where(F.col("published") & F.col("market_group_id").isNotNull())
        lines = self.table("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            F.col("l_quantity").cast("long").alias("qty"),
        )
        number, name, qty = F.col("l_linenumber"), F.col("type_name"), F.col("qty")
        amount = qty.cast("string")
        line = (
            F.when(number == 1, F.concat(F.upper(name), F.lit(" ("), amount, F.lit(",000 units)")))
            .when(number == 2, F.concat(name, F.lit("\tmineral\t"), amount))
            .when(number == 3, F.concat(amount, F.lit(" "), name))
            .when(number == 4, F.concat(name, F.lit(": "), amount))
            .when(number == 5, F.concat(name, F.lit("\t"), amount))
            .when(number == 6, F.concat(F.lit("["), name, F.lit(", my fit]")))
            .otherwise(F.concat(name, F.lit("\r")))
        )
        expected = F.when(number == 1, 1000 * qty).when(number <= 5, qty).otherwise(F.lit(1))
        return lines.join(known, F.col("l_partkey") == F.col("type_id")).select(
            F.col("l_orderkey").alias("list_id"),
            "type_id",
            line.alias("line"),
            expected.cast("long").alias("expected_qty"),
        )

    @property
    def pasted_more(self) -> DataFrame:
        """Lines of the rarer forms: licences, a quantity between tabs, a name between tabs, unknown names."""
        key = F.col("p_partkey")
        number = key.cast("string")
        line = (
            F.when(key % 4 == 0, F.concat(F.lit("30 Day Pilot Licence "), number, F.lit("\t5\tlicence")))
            .when(key % 4 == 1, F.concat("p_name", F.lit("\t1,7"), number, F.lit("\tcrate")))
            .when(key % 4 == 2, F.concat(F.lit("hangar\t"), "p_name", F.lit("\tcrate")))
            .otherwise(F.concat(F.lit("nothing known "), number))
        )
        return self.table("part").select(key.alias("list_id"), line.alias("line"))

    # ------------------------------------------------------------ landed feeds

    @property
    def feed_orders(self) -> DataFrame:
        """Orders as a feed delivers them: some stations are structures with own feeds."""
        at_structure = F.col("station_id") % 10 == 0
        own_feed = at_structure & (F.col("order_set") % 2 == 0)
        return (
            self.orders.drop("system_id")
            .withColumn("structure", F.when(own_feed, 1).otherwise(0))
            .withColumn(
                "station_id",
                F.when(at_structure, 1000000000000 + F.col("station_id")).otherwise(
                    F.col("station_id")
                ),
            )
        )

    @property
    def feed_stations(self) -> DataFrame:
        at_structure = F.col("station_id") % 10 == 0
        moved = F.when(at_structure, 1000000000000 + F.col("station_id"))
        return self.stations.withColumn("station_id", F.coalesce(moved, F.col("station_id")))

    @staticmethod
    def _paged(orders: DataFrame) -> DataFrame:
        """Orders with their `page` of fifty order ids."""
        return orders.withColumn("page", F.call_function("div", F.col("order_id"), F.lit(50)).cast("int"))

    @classmethod
    def _pages(cls, orders: DataFrame, keys: list[str]) -> DataFrame:
        """Orders with their `element` gathered to pages, in a fixed order."""
        listed = F.array_sort(F.collect_list(F.struct(*PAGE_ORDER, "element")))
        elements = F.array_join(F.transform(listed, lambda e: e.element), ",")
        return (
            cls._paged(orders)
            .groupBy(*keys, "page")
            .agg(F.concat(F.lit("["), elements, F.lit("]")).alias("listed"))
        )

    def _feed_listed(self, orders: DataFrame) -> DataFrame:
        """Pages (order_set, region_id, structure, page) of orders as the feed writes them, as `listed`."""
        issued = F.date_format("issued", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        volume = F.col("volume")
        order = F.struct(
            "order_id",
            "type_id",
            issued.alias("issued"),
            F.col("buy").alias("is_buy_order"),
            F.when(volume == 48, "many").otherwise(volume.cast("string")).alias("volume_remain"),
            F.col("volume_entered").alias("volume_total"),
            F.when(volume != 49, F.col("min_volume")).alias("min_volume"),
            "price",
            F.when(volume != 50, F.col("station_id")).alias("location_id"),
            "range",
            "duration",
        )
        # Numbers of the feed are not texts.
        element = F.regexp_replace(F.to_json(order), r'"volume_remain":"(\d+)"', r'"volume_remain":$1')
        keys = ["order_set", "region_id", "structure"]
        # The orders are exchanged as they are, and written as texts where their page is made.
        together = self._paged(orders).repartition(*keys, "page")
        return self._pages(together.withColumn("element", element), keys)

    @property
    def feed_pages(self) -> DataFrame:
        """Pages of many orders. Orders of fifty lots lack their place, those of forty-eight have
        a text for their volume, those of forty-nine lack an optional field. Some pages are
        broken, each region ends with an empty page, and one more page is an error document."""
        keys = ["order_set", "region_id", "structure"]
        pages = self._feed_listed(self.feed_orders)
        noise = F.when(F.col("page") % 13 == 5, "<").otherwise("")
        filled = pages.select(*keys, "page", F.concat(noise, "listed").alias("body"))
        ends = self.regions.select(
            F.lit(0).alias("order_set"),
            "region_id",
            F.lit(0).alias("structure"),
            F.inline(
                F.array(
                    F.struct(F.lit(2000000000).alias("page"), F.lit("[]").alias("body")),
                    F.struct(F.lit(2000000001).alias("page"), F.lit('{"error": "gone"}').alias("body")),
                )
            ),
        )
        return filled.unionByName(ends)

    @property
    def landed_pages(self) -> DataFrame:
        """Deliveries of feed pages in waves, numbered from 1 within their feed, an empty page at the end of each.

        Wave 1: every second page of five of each third snapshot is broken, and one feed of snapshot 7 lacks its end.
        Wave 2: the broken pages again, mended but for one region of snapshot 6. Wave 3: the first pages of snapshot 2 anew,
        without small orders; and a broken page of snapshot 1 that was delivered before all others.
        """
        feed = ["order_set", "region_id", "structure"]
        in_feed = Window.partitionBy(*feed).orderBy("page")
        # Pages are numbered without their texts, which stay where they were made.
        numbers = self._paged(self.feed_orders).select(*feed, "page").distinct()
        numbers = numbers.withColumn("number", F.row_number().over(in_feed))
        listed, page = self._feed_listed(self.feed_orders), [*feed, "page"]
        same = [listed[c].eqNullSafe(numbers[c]) for c in page]
        listed = listed.join(numbers, reduce(Column.__and__, same)).select(*[listed[c] for c in page], "listed", "number")
        listed.write.parquet(made := new_path(self.spark, "pages"))
        listed = self.spark.read.schema(listed.schema).parquet(made)
        fewer = self._feed_listed(self.feed_orders.where("order_set = 2 and volume >= 25"))
        fewer = fewer.select(*feed, "page", F.col("listed").alias("fewer"))
        broken = (F.col("order_set") % 3 == 0) & (F.col("number") % 5 == 2)
        unmended = (F.col("order_set") == 6) & (F.col("region_id") == 10000001)
        rubbish = F.concat(F.lit("<"), "listed")
        ends = listed.groupBy(*feed).agg((F.max("number") + 1).alias("number"))
        ends = ends.where("order_set <> 7 or region_id <> 10000002 or structure <> 0")
        waves = [
            listed.select(*feed, "number", F.lit(1).alias("wave"), F.when(broken, rubbish).otherwise(F.col("listed")).alias("body")),
            ends.select(*feed, "number", F.lit(1).alias("wave"), F.lit("[]").alias("body")),
            listed.where(broken).select(
                *feed, "number", F.lit(2).alias("wave"), F.when(unmended, rubbish).otherwise(F.col("listed")).alias("body")
            ),
            listed.where("order_set = 2 and number = 1")
            .join(fewer, [*feed, "page"], "left")
            .select(*feed, "number", F.lit(3).alias("wave"), F.coalesce("fewer", F.lit("[]")).alias("body")),
            listed.where("order_set = 1 and number = 1").select(*feed, "number", F.lit(3).alias("wave"), rubbish.alias("body")),
        ]
        rows = waves[0]
        for more in waves[1:]:
            rows = rows.unionByName(more)
        started = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 30 * order_set)")
        landed = started + F.make_dt_interval(mins=F.when(F.col("order_set") == 1, 60 - F.col("wave")).otherwise(F.col("wave")))
        return rows.select(
            F.col("order_set").cast("long"),
            F.col("region_id").cast("long"),
            F.col("structure").cast("int"),
            F.col("number").cast("int").alias("page"),
            started.alias("started"),
            landed.alias("landed"),
            "body",
            "wave",
        )

    @property
    def legacy_pages(self) -> DataFrame:
        """Pages of the older feed. Orders of fifty lots lack their price; every second page names
        the next one."""
        order = F.struct(
            F.col("order_id").alias("id"),
            F.col("type_id").alias("type"),
            F.date_format("issued", "yyyy-MM-dd'T'HH:mm:ss").alias("issued"),
            "buy",
            "volume",
            F.col("volume_entered").alias("volumeEntered"),
            F.col("min_volume").alias("minVolume"),
            F.when(F.col("volume") != 50, F.col("price")).alias("price"),
            F.col("station_id").alias("stationID"),
            "range",
            "duration",
        )
        keys = ["order_set", "region_id"]
        pages = self._pages(self.orders.withColumn("element", F.to_json(order)), keys)
        url = F.concat(
            F.lit("https://feed.example/market/"), F.col("region_id").cast("string"), F.lit("/orders/all/")
        )
        following = F.when(
            F.col("page") % 2 == 0, F.concat(F.lit(',"next":{"href":"'), url, F.lit('?page=2"}'))
        ).otherwise("")
        body = F.concat(F.lit('{"items":'), "listed", following, F.lit("}"))
        return pages.select("order_set", url.alias("url"), body.alias("body"))

    # ---------------------------------------------------- reference documents

    @property
    def group_docs(self) -> DataFrame:
        """Market group documents, delivered in parts of up to fifty types."""
        known = self.types.where(F.col("market_group_id").isNotNull())
        part = F.call_function("div", F.col("type_id"), F.lit(50)).alias("part")
        listed = known.groupBy("market_group_id", part).agg(F.sort_array(F.collect_list("type_id")).alias("types"))
        return listed.select(F.to_json(F.struct("market_group_id", "types")).alias("body"))

    @property
    def stored_types(self) -> DataFrame:
        """The types table before an update: large sizes are not known yet."""
        return (
            self.table("part")
            .where(F.col("p_size") <= 40)
            .select(
                F.col("p_partkey").alias("type_id"),
                F.col("p_name").alias("type_name"),
                F.lit(1).cast("long").alias("group_id"),
                F.col("p_size").cast("long").alias("market_group_id"),
                F.lit(5.0).alias("capacity"),
                F.lit(True).alias("published"),
                F.lit(1).alias("portion_size"),
                F.col("p_retailprice").alias("volume"),
                F.lit(7.5).alias("mass"),
            )
        )

    @property
    def type_docs(self) -> DataFrame:
        """Fetched type documents; some do not arrive, some lack fields."""
        return self._type_docs("p_size <> 25")

    @property
    def late_type_docs(self) -> DataFrame:
        """Documents of the types that did not arrive at first."""
        return self._type_docs("p_size = 25")

    @property
    def renamed_type_docs(self) -> DataFrame:
        """All documents once more; some types have another name, some no name any more."""
        name = F.when(F.col("p_size") == 30, F.concat("p_name", F.lit(" II"))).when(F.col("p_size") != 31, F.upper("p_name"))
        return self._type_docs("true", name)

    def _type_docs(self, chosen: str, name: Column | None = None) -> DataFrame:
        size = F.col("p_size")
        doc = F.struct(
            F.col("p_partkey").alias("type_id"),
            (F.when(size != 7, F.upper("p_name")) if name is None else name).alias("name"),
            F.lit(2).alias("group_id"),
            F.when(size % 10 != 0, size + 1000).alias("market_group_id"),
            F.when(size > 20, size * 1.5).alias("capacity"),
            F.when(size % 6 != 0, size % 4 != 0).alias("published"),
            F.when(size > 10, size).alias("portion_size"),
            F.when(size % 9 != 0, size / 4.0).alias("volume"),
            F.when(size > 30, F.col("p_retailprice")).alias("mass"),
        )
        return self.table("part").where(chosen).select(F.to_json(doc).alias("body"))

    @property
    def structure_docs(self) -> DataFrame:
        kinds = F.array(*[F.lit(k) for k in (35826, 35827, 35833, 35834, 40340, 35825, 35832)])
        position = F.struct(
            F.col("s_acctbal").alias("x"),
            (F.col("s_acctbal") * 2).alias("y"),
            (-F.col("s_acctbal")).alias("z"),
        )
        doc = F.struct(
            F.col("s_name").alias("name"),
            F.get(kinds, (F.col("s_suppkey") % 7).cast("int")).alias("type_id"),
            (30000000 + F.col("s_nationkey")).alias("solar_system_id"),
            position.alias("position"),
        )
        return self.table("supplier").select(
            (1000000000000 + F.col("s_suppkey")).alias("structure_id"),
            F.when(F.col("s_nationkey") == 7, 403).otherwise(200).alias("status"),
            F.to_json(doc).alias("body"),
        )

    @property
    def structure_markets(self) -> DataFrame:
        return self.table("supplier").select(
            (1000000000000 + F.col("s_suppkey")).alias("structure_id"),
            F.when(F.col("s_suppkey") % 5 == 0, 403).otherwise(200).alias("status"),
        )

    @property
    def known_structures(self) -> DataFrame:
        known = self.table("supplier").where(F.col("s_acctbal") > 8000)
        return known.select((1000000000000 + F.col("s_suppkey")).alias("station_id"))

    # ----------------------------------------------------------------- requests

    @property
    def lookup_requests(self) -> DataFrame:
        key, kind = F.col("c_custkey"), F.col("c_nationkey") % 4
        region = F.when(kind == 0, (10000000 + key % 5).cast("string"))
        station = F.when(kind <= 1, (60000000 + key % 90).cast("string"))
        system = F.when(kind <= 2, (30000000 + key % 25).cast("string"))
        token = [(key % n).cast("string") for n in (199, 83)]
        types = F.concat(
            token[0], F.lit(",,"), token[1], F.lit(","), token[0], F.lit(",0"), token[1], F.lit(",abc")
        )
        in_body = F.col("c_mktsegment") == "BUILDING"
        return self.table("customer").select(
            key.alias("request_id"),
            region.alias("region"),
            station.alias("station"),
            system.alias("system"),
            types.alias("types"),
            F.when(F.col("c_acctbal") > 5000, "10000002").alias("body_region"),
            F.lit(None).cast("string").alias("body_station"),
            F.when(F.col("c_acctbal") > 2000, "30000003").alias("body_system"),
            F.when(in_body, F.concat(token[1], F.lit(",7"))).alias("body_types"),
        )

    @property
    def search_terms(self) -> DataFrame:
        """Runs of two to six characters of names, in upper case; some with a sign that no name has."""
        number = F.col("type_id")
        run = F.upper(F.substring("type_name", (1 + number % 9).cast("int"), (2 + number % 5).cast("int")))
        return self.types.select(F.when(number % 11 == 3, F.concat(run, F.lit("#"))).otherwise(run).alias("term"))

    @property
    def appraisal_requests(self) -> DataFrame:
        region = F.when(F.col("o_orderpriority") == "5-LOW", "everywhere").otherwise(
            (10000000 + F.col("o_custkey") % 5).cast("string")
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("list_id"), region.alias("region")
        )
