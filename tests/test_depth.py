"""The depth kernel: literal cases, a plain-Python model, and the way around hot groups."""

import math
import random
import statistics
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from market_support import as_set
from pyspark.sql import functions as F

from depthbook.operators import depth, skew

LEVELS = "order_set long, loc_id long, type_id long, buy boolean, price decimal(19,4), volume long"


def levels(spark, cases):
    """cases: {type_id: (buy, [(price, volume)])}"""
    rows = [
        (1, 0, type_id, buy, Decimal(str(price)), volume)
        for type_id, (buy, book) in cases.items()
        for price, volume in book
    ]
    return spark.createDataFrame(rows, LEVELS)


CASES = {
    1: (False, [(10, 5)]),
    2: (False, [(1, 10), (2, 90)]),
    3: (False, [(1, 2), (2, 98)]),
    4: (True, [(1, 98), (2, 2)]),
    5: (False, [(1, 10), (100, 10)]),
    6: (False, [(1, 10), ("100.01", 10)]),
    7: (True, [(100, 10), ("0.99", 10)]),
    8: (False, [(1, 0)]),
    9: (True, [(100, 10), (1, 10)]),
}
EXPECTED = {
    1: {"weighted_average": 10, "stddev": 0.01, "median": 10, "volume": 5, "order_count": 1, "percentile": 10},
    2: {"weighted_average": 1.9, "volume": 100, "order_count": 2, "percentile": 1},
    3: {"percentile": 1.6},
    4: {"percentile": 1.4},
    5: {"volume": 20},
    6: {"volume": 10, "weighted_average": 1, "max_price": 100.01, "order_count": 2},
    7: {"volume": 10, "weighted_average": 100, "min_price": 0.99},
    8: {"weighted_average": None, "percentile": None, "volume": 0},
    9: {"volume": 20, "median": 50.5},
}


def check_cases(frame):
    found = {r.type_id: r.asDict() for r in frame.collect()}
    for type_id, expected in EXPECTED.items():
        for name, value in expected.items():
            got = found[type_id][name]
            if value is None:
                assert got is None, (type_id, name)
            else:
                assert math.isclose(float(got), value, rel_tol=1e-12), (type_id, name, got)


def test_literal_cases(spark):
    check_cases(depth.depth_stats(levels(spark, CASES)))


def test_literal_cases_in_pieces(spark):
    book = levels(spark, CASES)
    check_cases(depth.depth_stats(book, hot_rows=0))


def test_buy_walked_from_the_lowest_price(spark):
    frame = depth.depth_stats(levels(spark, {4: CASES[4]}), buy_best_first=False)
    assert frame.collect()[0].percentile == 1.0


def model(book, buy):
    """The definition, in floats, one group at a time."""
    best = max(p for p, _ in book) if buy else min(p for p, _ in book)
    walk = sorted(book, key=lambda level: -level[0] if buy else level[0])
    kept = []
    for price, volume in walk:
        out = price * 100 < best if buy else price > best * 100
        kept.append((float(price), 0 if out else volume))
    total, before, weights = sum(v for _, v in kept), 0, []
    for _, volume in kept:
        limit = total / 20
        weight = volume if before + volume <= limit else limit - before
        weights.append(max(weight, 0))
        before += volume
    prices = [p for p, _ in kept]

    def mean(ws):
        return sum(p * w for (p, _), w in zip(kept, ws, strict=True)) / sum(ws) if sum(ws) else None

    return {
        "weighted_average": mean([v for _, v in kept]),
        "max_price": max(prices),
        "min_price": min(prices),
        "stddev": statistics.stdev(prices) if len(prices) > 1 else 0.01,
        "median": statistics.median(prices),
        "volume": total,
        "order_count": len(prices),
        "percentile": mean(weights),
    }


def random_cases(seed, n):
    rng = random.Random(seed)
    cases = {}
    for type_id in range(n):
        spread = rng.choice([20, 5_000, 2_000_000])
        size = rng.choice([1, 2, 3, 40, 300])
        prices = rng.sample(range(1, spread + size * 2), size)
        book = [(Decimal(p) / 100, rng.choice([0, 1, rng.randint(1, 10**9)])) for p in prices]
        cases[type_id] = (rng.random() < 0.5, book)
    return cases


@pytest.mark.parametrize("pieces", [False, True])
def test_random_books_equal_the_model(spark, pieces):
    cases = random_cases(7, 120)
    book = levels(spark, cases)
    for row in depth.depth_stats(book, hot_rows=0 if pieces else 1000).collect():
        buy, listed = cases[row.type_id]
        for name, value in model(listed, buy).items():
            got = row[name]
            if value is None:
                assert got is None
            else:
                assert math.isclose(float(got), value, rel_tol=1e-9, abs_tol=1e-9), (row, name)


def test_properties(spark):
    cases = random_cases(11, 80)
    found = {r.type_id: r for r in depth.depth_stats(levels(spark, cases)).collect()}
    scaled = {t: (buy, [(p, v * 3) for p, v in book]) for t, (buy, book) in cases.items()}
    for r in depth.depth_stats(levels(spark, scaled)).collect():
        base = found[r.type_id]
        assert r.volume == 3 * base.volume
        assert (r.percentile is None) == (base.percentile is None)
        if r.percentile is not None:
            assert math.isclose(r.percentile, base.percentile, rel_tol=1e-12)
            assert float(r.min_price) - 1e-9 <= r.percentile <= float(r.max_price) + 1e-9


def test_hot_groups_do_not_change_results(spark, market):
    orders = market.orders
    for scope in ("region", "global"):
        plain = depth.aggregate_scope(orders, scope)
        cut = depth.aggregate_scope(orders, scope, hot_rows=2)
        assert as_set(plain) == as_set(cut, plain.columns)


def test_one_type_holding_a_third_of_all_orders(spark, market):
    """A hot type is found, walked in pieces, and its numbers equal the plain walk."""
    from pyspark.sql import functions as F

    orders = market.orders.withColumn(
        "type_id", F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("type_id"))
    ).withColumn("price", (F.col("price") + F.col("order_id") / 10000).cast("decimal(19,4)"))
    levels_ = depth.price_levels(orders, F.lit(0))
    hot = skew.hot_keys(levels_, depth.GROUP, hot_rows=100)
    assert {r.type_id for r in hot.collect()} == {1}
    plain = depth.aggregate_scope(orders, "global")
    cut = depth.aggregate_scope(orders, "global", hot_rows=100)
    assert as_set(plain) == as_set(cut, plain.columns)


def test_any_number_of_hot_groups(spark):
    """More hot keys than any list would hold; every one is found, placed and walked in pieces."""
    rows = spark.range(9000).selectExpr(
        "id % 3000 as k", "cast(id % 7 as decimal(19,4)) as price", "id % 2 as region_id", "id as order_id"
    )
    assert skew.hot_keys(rows, ["k"], hot_rows=2).count() == 3000
    order = [depth.F.col("price"), "region_id", "order_id"]
    plain = skew.with_position(rows, ["k"], order, False)
    cut = skew.with_position(rows, ["k"], order, False, hot_rows=2)
    assert as_set(plain, cut.columns) == as_set(cut)


@pytest.mark.parametrize("descending", [False, True])
def test_positions_in_pieces(spark, descending):
    """Many equal prices, ids far apart, and rows that are equal in every respect."""
    rows = spark.range(6000).selectExpr(
        "id % 3 = 0 as third",
        "cast(case when id % 2 = 0 then 5 else hash(id) % 50 + 60 end as decimal(19,4)) as price",
        "id % 4 as region_id",
        "(id div 2) * 40000 as order_id",
    )
    price = depth.F.desc("price") if descending else depth.F.col("price")
    order = [price, "region_id", "order_id"]
    plain = skew.with_position(rows, ["third"], order, descending)
    cut = skew.with_position(rows, ["third"], order, descending, hot_rows=1500)
    assert as_set(plain, cut.columns) == as_set(cut)


def test_no_job_while_a_query_is_built(spark, market):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "queries that are only built")
    depth.aggregate_all_scopes(market.orders, market.stations)
    depth.aggregate_scope(market.orders, "global", hot_rows=2)
    jobs = tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_all_scopes_is_the_union_of_scopes(spark, market):
    orders, stations = market.orders, market.stations
    one_pass = depth.all_scope_levels(orders, stations)
    parts = [
        depth.price_levels(orders.withColumn("zero", depth.F.lit(0)), "zero"),
        depth.price_levels(orders, "region_id"),
        depth.price_levels(orders, "station_id"),
        depth.price_levels(depth.with_station_system(orders, stations), "system_id"),
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    assert as_set(one_pass, together.columns) == as_set(together)


def test_region_volumes_add_up_to_global(spark, market):
    sums = defaultdict(int)
    for scope in ("region", "global"):
        for r in depth.price_levels(
            market.orders, "region_id" if scope == "region" else depth.F.lit(0)
        ).collect():
            sums[scope, r.order_set, r.type_id, r.buy] += r.volume
    for (scope, *key), volume in list(sums.items()):
        if scope == "region":
            assert sums[("global", *key)] == volume


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_columns_not_needed_are_not_read(market):
    plan = plan_of(depth.aggregate_scope(market.orders, "region"))
    assert "l_orderkey" not in plan and "l_shipdate" not in plan


def test_ordinary_walk_is_one_exchange_and_one_sort(spark):
    """All windows and the final grouping share one exchange by group and one sort."""
    book = levels(spark, CASES).withColumn("walk", depth._walk_order(True))
    plan = plan_of(depth._statistics(depth._walk(book)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_pieces_bound_every_window_over_rows(spark):
    """In the walk in pieces, rows are only ever windowed per piece."""
    book = levels(spark, CASES).withColumn("walk", depth._walk_order(True))
    for line in plan_of(depth._walk_in_pieces(book)).splitlines():
        if "Window [" in line and "walk#" in line:
            assert "piece#" in line.split("windowspecdefinition(", 1)[1].split("walk#")[0]


def test_spread_of_huge_prices_does_not_depend_on_the_order(spark):
    """Squares beyond 38 digits: still from exact sums, so every arrangement of the rows gives the same bits."""
    rng = random.Random(5)
    cases = {
        1: (False, [(Decimal(p), 1) for p in rng.sample(range(10**13, 9 * 10**14), 300)]),
        2: (True, [(Decimal(rng.randrange(1, 10**6)) / 7, 1) for _ in range(50)] + [(Decimal(8 * 10**14), 3)]),
        3: (True, [(Decimal(10**11) + i, 1) for i in range(5)]),
    }
    cases = {t: (buy, sorted({(p.quantize(Decimal("0.0001")), v) for p, v in book})) for t, (buy, book) in cases.items()}
    book = levels(spark, cases)
    found = {r.type_id: r.stddev for r in depth.depth_stats(book).collect()}
    for parts in (1, 3, 17):
        again = depth.depth_stats(book.repartition(parts, F.rand(parts)))
        assert {r.type_id: r.stddev for r in again.collect()} == found
    for type_id, (_, listed) in cases.items():
        prices = [Fraction(p) for p, _ in listed]
        mean = sum(prices) / len(prices)
        exact = sum((p - mean) ** 2 for p in prices) / (len(prices) - 1)
        assert math.isclose(found[type_id], math.sqrt(exact), rel_tol=1e-12)


def scattered_orders(spark, n=4000):
    """Orders of a few types, one of them with half of all; prices repeat, and some stations are unknown."""
    return spark.range(n).selectExpr(
        "1 + id % 2 as order_set", "case when id % 4 < 2 then 1 else id % 60 end as type_id", "id % 3 = 0 as buy",
        "cast(1 + id * 7 % 400 as decimal(19,4)) as price", "1 + id % 9 as volume",
        "10 + id % 3 as region_id", "100 + id % 7 as station_id",
    )


def test_orders_are_exchanged_once_before_they_are_expanded(spark):
    """Besides the counts of buckets, the ordinary walk of all scopes has one exchange, below the expansion, and one sort."""
    orders = scattered_orders(spark)
    stations = spark.range(100, 106).selectExpr("id as station_id", "id % 2 as system_id")
    plan = plan_of(depth.aggregate_all_scopes(orders, stations))
    walk = plan[plan.index("Window [") :]
    walk = walk[: walk.index("LeftAnti")]
    assert walk.count("Exchange hashpartitioning") == 1 and walk.index("Generate explode") < walk.index("Exchange")
    assert walk.count("Sort [") == 1 and "HashAggregate" not in walk


@pytest.mark.parametrize("hot_rows", [0, 2, 30, 500])
def test_all_scopes_in_pieces_equal_the_plain_walk(spark, hot_rows):
    orders = scattered_orders(spark)
    stations = spark.range(100, 106).selectExpr("id as station_id", "id % 2 as system_id")
    plain = depth.aggregate_all_scopes(orders, stations)
    cut = depth.aggregate_all_scopes(orders, stations, hot_rows=hot_rows)
    assert as_set(plain) == as_set(cut, plain.columns)
    levels_ = depth.depth_stats(depth.all_scope_levels(orders, stations))
    assert as_set(plain) == as_set(levels_, plain.columns)


def test_rows_of_full_buckets_are_set_apart(spark):
    rows = spark.range(3000).selectExpr("case when id < 500 then null when id < 1500 then 0 else id end as k")
    plain, suspects = skew.apart_by_bucket(rows, ["k"], hot_rows=800)
    assert suspects.where("k = 0").count() == 1000 and plain.where("k = 0").isEmpty()
    assert plain.count() + suspects.count() == 3000
