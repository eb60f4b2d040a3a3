"""Texts, serving rows, lookups, boards and listings."""

import json
from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from depthbook.functions import text
from depthbook.operators import boards, depth, listing, lookup

AGGREGATES = (
    "order_set long, loc_id long, type_id long, buy boolean, weighted_average double,"
    " max_price decimal(19,4), min_price decimal(19,4), stddev double, median double, volume long,"
    " order_count long, percentile double"
)


def aggregates(spark):
    return spark.createDataFrame(
        [
            (7, 10000002, 34, True, 4.02878502065, Decimal("5.95"), Decimal("0.01"), 1.62036217159,
             5.0, 10024734026, 52, 5.50168617928),
            (7, 10000002, 35, False, None, Decimal("2201571"), Decimal("5.01"), 177420.733866, 6.38,
             0, 179, None),
        ],
        AGGREGATES,
    )


def test_number_texts(spark):
    values = {
        4.028785020654321: "4.02878502065",
        5.0: "5.0",
        0.0: "0.0",
        10024734026.0: "10024734026.0",
        2201571.0: "2201571.0",
        0.01: "0.01",
        177420.733866: "177420.733866",
        1e13: "1e+13",
        123456789012345.0: "1.23456789012e+14",
        0.00001: "1e-05",
        100.0: "100.0",
    }
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.t for r in rows.select("v", text.float_text(F.col("v")).alias("t")).collect()}
    assert got == values


def test_presentation(spark):
    rows = spark.createDataFrame([(0.9,), (0.5,), (0.0,), (-0.2,), (1.0,), (0.05,), (0.004,), (-0.0042,)], "s double")
    shown = rows.select("s", text.security_class(F.col("s")), text.security_text(F.col("s")))
    got = {r[0]: (r[1], r[2]) for r in shown.collect()}
    assert got == {
        0.9: ("high", "0.9"), 0.5: ("low", "0.5"), 0.0: ("null", "0"), -0.2: ("null", "-0.2"),
        1.0: ("high", "1"), 0.05: ("low", "0.05"),
        0.004: ("low", "0.004"), -0.0042: ("null", "-0.004"),
    }
    one = spark.range(1).select(
        text.display_number(F.lit(1234567.125), 2),
        text.display_number(F.lit(1234.5), 0),
        text.minute_text(F.lit(datetime(2024, 1, 2, 3, 4, 5))),
    )
    assert tuple(one.collect()[0]) == ("1,234,567.13", "1,235", "2024-01-02 03:04")


def test_serving_rows(spark):
    rows = {r.key: r.payload for r in lookup.serving_rows(aggregates(spark)).collect()}
    assert rows == {
        "10000002|34|true": "4.02878502065|5.95|0.01|1.62036217159|5.0|10024734026.0|52|5.50168617928",
        "10000002|35|false": "|2201571.0|5.01|177420.733866|6.38|0.0|179|",
    }
    back = {r.type_id: r for r in lookup.decode_serving_rows(lookup.serving_rows(aggregates(spark))).collect()}
    assert back[34].percentile == 5.50168617928 and back[34].order_count == 52.0
    assert back[35].weighted_average == 0.0 and back[35].buy is False


def test_live_rows_expire(spark):
    manifest = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 0)), (2, datetime(2024, 1, 1, 1))],
        "order_set long, downloaded timestamp_ntz",
    )
    both = aggregates(spark).withColumn("order_set", F.lit(1)).unionByName(
        aggregates(spark).where("buy").withColumn("order_set", F.lit(2))
    )
    rows = lookup.serving_rows(both, manifest)

    def live(now):
        return {r.key: r.order_set for r in lookup.live_aggregates(rows, now).collect()}

    assert live(datetime(2024, 1, 1, 1, 30)) == {"10000002|34|true": 2, "10000002|35|false": 1}
    assert live(datetime(2024, 1, 1, 2)) == {"10000002|34|true": 2}
    assert live(datetime(2024, 1, 1, 3)) == {}


def test_live_statistics(spark):
    """A key that the newest snapshot lacks is served from the one before, until that expires."""
    manifest = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 0)), (2, datetime(2024, 1, 1, 1))],
        "order_set long, downloaded timestamp_ntz",
    )
    both = aggregates(spark).withColumn("order_set", F.lit(1)).unionByName(
        aggregates(spark).where("buy").withColumn("order_set", F.lit(2))
    )

    def live(now):
        rows = lookup.live_statistics(both, manifest, now)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan
        return {(r.type_id, r.buy): r.order_set for r in rows.collect()}

    assert live(datetime(2024, 1, 1, 1, 30)) == {(34, True): 2, (35, False): 1}
    assert live(datetime(2024, 1, 1, 2)) == {(34, True): 2}


def test_natural_order_of_any_length(spark):
    names = ["s-9", "s-10", "s-" + "1" * 41, "s-" + "1" * 40 + "2", "s-010"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").orderBy(text.natural_key(F.col("n")), "n")
    assert [r.n for r in rows.collect()] == ["s-9", "s-010", "s-10", "s-" + "1" * 41, "s-" + "1" * 40 + "2"]


def requests(spark, rows):
    names = ["request_id", *lookup.REQUEST_COLUMNS, *[f"body_{n}" for n in lookup.REQUEST_COLUMNS]]
    schema = ", ".join(f"{n} {'int' if n == 'request_id' else 'string'}" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_request_precedence(spark):
    asked = requests(
        spark,
        [
            {"request_id": 1, "region": "1", "station": "2", "system": "3", "types": "34,,34,x"},
            {"request_id": 2, "station": "2", "system": "3", "types": "34"},
            {"request_id": 3, "types": "34"},
            {"request_id": 4, "region": "1", "types": "34", "body_types": "35", "body_system": "9"},
            {"request_id": 5, "region": "1", "types": "34", "body_region": "8"},
            {"request_id": 6, "region": "1", "types": "34", "body_types": "35"},
        ],
    )
    got = sorted((r.request_id, r.place, r.token) for r in lookup.resolve_requests(asked).collect())
    assert got == [
        (1, "1", "34"), (1, "1", "x"), (2, "2", "34"), (3, "0", "34"), (4, "9", "35"), (5, "1", "34"),
        (6, "1", "35"),
    ]


def test_lookup_document(spark):
    asked = requests(spark, [{"request_id": 1, "region": "10000002", "types": "34,034,99999999999999999999"}])
    entries = {r.token: json.loads(r.entry) for r in lookup.lookup_document(asked, aggregates(spark)).collect()}
    assert entries["34"]["buy"] == {
        "weightedAverage": "4.02878502065", "max": "5.95", "min": "0.01", "stddev": "1.62036217159",
        "median": "5.0", "volume": "10024734026.0", "orderCount": "52", "percentile": "5.50168617928",
    }
    assert set(entries["34"]["sell"].values()) == {"0"}
    assert set(entries["034"]["buy"].values()) == {"0"}
    assert len(entries) == 3


def test_item_board(spark):
    board = boards.item_board(aggregates(spark), locs=[10000002]).collect()
    assert [r.label for r in sorted(board, key=lambda r: r.place)][:2] == ["Tritanium", "Pyrite"]
    assert len(board) == 10
    by_type = {r.type_id: r for r in board}
    assert by_type[34].buy_max_price == 5.95 and by_type[34].sell_volume == 0.0
    assert by_type[40520].buy_median == 0.0


def dims(market):
    return listing.Dimensions(
        market.stations, market.types, market.regions, market.systems, market.region_class, market.hubs
    )


def test_listing_of_one_type(spark, market):
    orders = market.orders
    type_id = orders.groupBy("type_id").count().orderBy(F.desc("count")).first().type_id
    for side, reverse in (("sell", False), ("buy", True)):
        rows = listing.order_listing(orders, dims(market), side, "all", type_id).collect()
        prices = [r.price for r in rows]
        assert prices == sorted(prices, reverse=reverse) and rows
        known = market.stations.select("station_id")
        want = orders.where((F.col("type_id") == type_id) & (F.col("buy") == (side == "buy")))
        assert len(rows) == want.join(known, "station_id").count()
        region = rows[0].region_id
        part = listing.order_listing(orders, dims(market), side, "region", type_id, region).collect()
        assert len(part) == sum(r.region_id == region for r in rows)
        every = listing.order_listing(orders, dims(market), side, "api", type_id, 0)
        assert every.count() == len(rows) and "security" in every.columns
        station = rows[0].station_id
        one = listing.order_listing(orders, dims(market), side, "station", type_id, station)
        assert one.count() == sum(r.station_id == station for r in rows)


def test_history_of_one_order(spark, market):
    order_id = market.orders.groupBy("order_id").count().orderBy(F.desc("count")).first().order_id
    sets = [
        r.order_set
        for side in ("sell",)
        for r in listing.order_history(market.orders, dims(market), side, order_id).collect()
    ]
    assert sets == sorted(sets, reverse=True)


def test_view_pages_are_bounded_and_whole(spark, market):
    orders = market.orders.withColumn("type_id", F.lit(1).cast("long"))
    for hot_rows in (10**6, 10):
        pages = listing.market_view_pages(
            orders, dims(market), "sell", page_orders=100, hot_rows=hot_rows
        ).collect()
        assert max(r.n_orders for r in pages) <= 100
        for order_set in {r.order_set for r in pages}:
            docs = [
                entry
                for r in sorted((r for r in pages if r.order_set == order_set), key=lambda r: r.page)
                for entry in json.loads(r.orders)
            ]
            prices = [float(d["price"]) for d in docs]
            assert prices == sorted(prices)
            listed = listing.order_listing(
                orders.where(F.col("order_set") == order_set), dims(market), "sell", "api"
            )
            assert len(docs) == listed.count()


def test_positions_follow_the_sorted_listing(spark, market):
    orders = market.orders.withColumn("type_id", F.col("type_id") % 3)
    for hot_rows in (10**6, 10):
        every = listing.order_listing(orders, dims(market), "buy", hot_rows=hot_rows)
        one = listing.order_listing(orders, dims(market), "buy", type_id=2)
        placed = every.where("type_id = 2").orderBy("position").collect()
        assert [r.position for r in placed] == list(range(1, len(placed) + 1))
        assert [tuple(r)[:-1] for r in placed] == [tuple(r) for r in one.collect()]


def test_distinct_orders(spark):
    rows = spark.createDataFrame(
        [(1, 5, 10, 3), (1, 5, 9, 8), (1, 6, 9, 1), (2, 5, 10, 3)],
        "order_set int, order_id int, region_id int, volume int",
    )
    got = sorted(tuple(r) for r in listing.distinct_orders(rows).collect())
    assert got == [(1, 5, 9, 8), (1, 6, 9, 1), (2, 5, 10, 3)]


def test_top_stations(spark):
    orders = spark.createDataFrame(
        [(i % 15, False, 2) for i in range(100)] + [(99, False, 1)] * 50,
        "station_id long, buy boolean, volume long",
    )
    stations = spark.range(15).selectExpr("id as station_id", "concat('s', id) as station_name")
    rows = boards.top_stations(orders, stations, "sell").collect()
    assert len(rows) == 10 and rows[0].station_id == 0 and rows[0].coun == 7
    board = json.loads(boards.top_stations_json(orders, stations, "sell").first().board)
    assert [b["stationID"] for b in board] == [r.station_id for r in rows]


def test_wide_row(spark):
    wide = {r.type_id: r for r in depth.wide_aggregates(aggregates(spark)).collect()}
    assert str(wide[34].wavg_buy) == "4.03" and wide[34].volume_buy == 10024734026
    assert wide[34].wavg_sell is None and wide[35].count_sell == 179


REQUEST = (
    "request_id long, region string, station string, system string, types string,"
    " body_region string, body_station string, body_system string, body_types string"
)


def requests_of(spark):
    rows = [
        (1, "10000001", None, None, "1,2,,x", None, None, None, None),
        (2, None, None, None, "7", None, None, None, None),
        (3, None, "60000003", None, "1", "30000002", None, None, "3,3"),
        (4, "nowhere", None, None, "01", None, None, None, None),
    ]
    return spark.createDataFrame(rows, REQUEST)


def test_only_what_is_asked_for_is_aggregated(spark, market):
    requests = requests_of(spark)
    wanted = lookup.wanted_keys(requests)
    assert {tuple(r) for r in wanted.collect()} == {(10000001, 1), (10000001, 2), (0, 7), (30000002, 3)}
    every = depth.aggregate_all_scopes(market.orders, market.stations)
    some = depth.aggregate_all_scopes(market.orders, market.stations, wanted=wanted)
    assert sorted(some.collect()) == sorted(every.join(wanted, ["loc_id", "type_id"], "left_semi").select(*some.columns).collect())
    # Types leave before the first fold, places before the second.
    plan = some._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "LeftSemi" in line and "type_id" in line]
    folds = [i for i, line in enumerate(plan) if "Aggregate [" in line and "sum(volume" in line]
    assert any("loc_id" in plan[i] and folds[0] < i < folds[1] for i in joins)
    assert any("loc_id" not in plan[i] and i > folds[1] for i in joins)


def test_buckets_follow_the_shuffle_partitions(spark, tmp_path):
    """A bucket is one task, so there are as many as of any other exchange of the session."""
    stats = spark.range(300).selectExpr("id as loc_id", "id % 7 as type_id", "id % 2 = 0 as buy", *[f"1.0 as {n}" for n in depth.STATISTICS])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        lookup.store_for_lookup(stats, "live_many_buckets", str(tmp_path / "live"))
        described = spark.sql("describe extended live_many_buckets").where("col_name = 'Num Buckets'").first()
        assert described.data_type == "23" and spark.table("live_many_buckets").count() == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("drop table if exists live_many_buckets")


def test_stored_statistics_are_not_exchanged(spark, market, tmp_path):
    stats = depth.aggregate_all_scopes(market.orders.where("order_set = 7"), market.stations)
    lookup.store_for_lookup(stats, "live_for_test", str(tmp_path / "live"), 4)
    found = lookup.lookup_aggregates(requests_of(spark), spark.table("live_for_test"))
    assert sorted(found.collect()) == sorted(lookup.lookup_aggregates(requests_of(spark), stats).collect())
    with_merge = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_merge}
    for key, value in with_merge.items():
        spark.conf.set(key, value)
    try:
        plan = lookup.lookup_aggregates(requests_of(spark), spark.table("live_for_test"))
        lines = plan._jdf.queryExecution().executedPlan().toString().split("\n")
        merge = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        # One exchange, that of the requests, stands before the scan of the table; none above its scan.
        stored_side = lines[max(i for i in range(merge, scan) if "Exchange" in lines[i]) + 1 : scan + 1]
        assert sum("Exchange" in line for line in lines) == 1 and "Bucketed: true" in lines[scan]
        assert not any("Exchange" in line for line in stored_side)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.sql("drop table live_for_test")
