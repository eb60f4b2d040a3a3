"""Serving rows and their stream: texts without the formatter, no exchange of rows by a handful of snapshots."""

import random

from pyspark.sql import functions as F

from depthbook.functions import text
from depthbook.operators import appraisal, depth, lookup
from depthbook.sources import versions
from depthbook.streaming import publication
from depthbook.streaming import snapshots as stream


def test_number_texts_are_those_of_the_formatter(spark):
    draw = random.Random(7)
    values = [draw.uniform(0, 10) * 10 ** draw.uniform(-6, 14) for _ in range(2_000)]
    values += [round(draw.uniform(0, 10) * 10 ** draw.uniform(-3, 11), draw.randint(0, 12)) for _ in range(2_000)]
    # Halves at the thirteenth digit, and the ends of the ranges.
    values += [draw.randrange(10**11, 10**12) / 10 ** (d := draw.randint(1, 11)) + 0.5 / 10**d for _ in range(2_000)]
    values += [0.0, -0.0, 0.01, 0.0099999999999999, 999.9999999999999, 99999999999.5, 1e11, 1e12, 5e-324, 1e300, -3.25, None]
    values += [float("nan"), float("inf")]
    rows = spark.createDataFrame([(v, v) for v in values], "v double, t double")
    both = text.with_number_texts(rows, "t").select("t", text.float_text(F.col("v")).alias("slow")).collect()
    assert len(both) == len(values) and all(r.t == r.slow for r in both)


def test_common_numbers_are_not_formatted(spark):
    """The formatter stands in a lambda for the rest, not in the way of every number."""
    rows = spark.range(1).select(F.lit(1).alias("order_set"), F.lit(2).alias("loc_id"), F.lit(3).alias("type_id"), F.lit(True).alias("buy"), *[F.col("id").cast("double").alias(n) for n in depth.STATISTICS])
    plan = lookup.serving_rows(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lambdafunction(") == len(depth.STATISTICS) - 1, plan
    before = plan.split("lambdafunction(")[0]
    assert "format_string" not in before.rsplit("transform(", 1)[0], plan


def test_rows_of_a_version_are_written_where_they_are_made(spark, tmp_path):
    """An exchange by order_set and version would leave as many tasks as there are versions."""
    rows = spark.range(0, 1_000, 1, 5).select(F.lit(1).alias("order_set"), F.lit(1).alias("version"), F.col("id").alias("volume"))
    versions.write_versions(rows, str(tmp_path), "orders")
    found = spark.read.parquet(f"{tmp_path}/orders")
    assert found.count() == 1_000 and len({f.rsplit("/", 1)[1].split("-")[1] for f in found.inputFiles()}) == 5


def test_changes_read_each_version_once(spark, tmp_path):
    """Both sides of the changes come from one scan and one exchange, and equal sides from none."""
    root, at = str(tmp_path), "timestamp_ntz'2024-01-01 00:00:00'"
    made = [(s, 1, f"{k}|1|true", f"{s}.0") for s, keys in ((1, "ab"), (2, "bc"), (6, "c")) for k in keys]
    rows = spark.createDataFrame(made, "order_set long, version long, key string, payload string")
    taken = F.expr(f"{at} + make_dt_interval(0, 0, 30 * cast(order_set as int))")
    rows = rows.withColumn("expires_at", taken + F.expr("interval 90 minutes"))
    versions.write_versions(rows, root, "serving")
    noted = rows.select("order_set", "version").distinct().withColumn("downloaded", taken)
    versions.publish(noted, root, F.col("downloaded"), stream.SERVED)
    events = versions.ledger(spark, root, stream.SERVED)
    clock = lambda e: e.agg(F.max("downloaded")).first()[0]
    older = events.where("order_set < 6")
    sides = [(older, clock(older)), (events, clock(events))]
    found = stream.changes(spark, root, sides)
    assert sorted((r.key[0], r.op, r.payload) for r in found.collect()) == [("a", "delete", None), ("b", "delete", None), ("c", "put", "6.0")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "FullOuter" not in plan
    assert stream.changes(spark, root, [sides[1], sides[1]]).isEmpty()
    nothing = stream.changes(spark, root, [(events.where("false"), None), sides[0]])
    assert sorted((r.key[0], r.op, r.order_set) for r in nothing.collect()) == [("a", "put", 1), ("b", "put", 2), ("c", "put", 2)]


def test_orders_of_a_load_are_not_exchanged_by_snapshot(spark, tmp_path, monkeypatch):
    """The snapshots of a batch are a few rows: orders meet them as a broadcast."""
    seen = []
    monkeypatch.setattr(versions, "write_versions", lambda rows, *_: seen.append(rows))
    pages = spark.createDataFrame([], publication.LANDED)
    todo = spark.createDataFrame([(1, 1)], "order_set long, version long")
    publication.load_versions(pages, publication.newest_deliveries(publication.delivery_accounts(pages)), todo, str(tmp_path))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2, plan


def test_ordinary_groups_of_a_scope_are_placed_once(spark, market):
    """Setting hot groups apart places the ordinary ones already: only orders and pieces are placed beside that."""
    plan = depth.aggregate_scope(market.orders, "global", hot_rows=2)._jdf.queryExecution().optimizedPlan().toString()
    placed = [line for line in plan.split("\n") if "RepartitionByExpression" in line]
    assert len([line for line in placed if "piece#" not in line]) == 1, placed


def test_documents_sum_up_their_lines_once(spark):
    lines = spark.createDataFrame([(1, 7, *[1.0] * 5), (1, 7, *[2.0] * 5)], "list_id long, loc_id long, " + ", ".join(f"{t} double" for t in appraisal.TOTALS))
    stored = spark.createDataFrame([(1, 0, "{}"), (1, 1, "[]")], "list_id long, part long, list string")
    requests = spark.createDataFrame([(1, "7"), (2, "7"), (1, "x")], "list_id long, region string")
    regions = spark.createDataFrame([(7, "seven")], "region_id long, region_name string")
    found = appraisal.appraisal_documents(lines, stored, requests, regions)
    named = appraisal.identified_lists(stored).select("identifier").first()[0]
    rows = sorted((r.list_id, r.identifier, r.n_lines, float(r.pbuy)) for r in found.collect() if r.list_id == 1)
    assert rows == [(1, named, 2, 3.0)] and found.count() == 2
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 3
