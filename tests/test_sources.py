"""Pages, snapshot files and tables, reference documents, all over real files."""

import json
import os
from datetime import datetime

import pytest
from market_support import as_set

from depthbook.operators import listing, refdata
from depthbook.sources import pages, snapshots
from depthbook.sources import refdata as documents


def order(order_id, **changes):
    base = {
        "order_id": order_id,
        "type_id": 34,
        "issued": "2017-09-01T12:30:00Z",
        "is_buy_order": False,
        "volume_remain": 5,
        "volume_total": 9,
        "min_volume": 1,
        "price": 5.01,
        "location_id": 60003760,
        "range": "region",
        "duration": 90,
    }
    return {**base, **changes}


def land(root, region, structure, page, body):
    folder = os.path.join(root, f"region_id={region}", f"structure={structure}", f"page={page}")
    os.makedirs(folder)
    with open(os.path.join(folder, "body.json"), "w") as out:
        out.write(body if isinstance(body, str) else json.dumps(body, indent=1))


@pytest.fixture()
def landed(tmp_path):
    root = str(tmp_path / "pages")
    structure = 1000000000001
    land(root, 10000001, 0, 1, [order(1), order(2, is_buy_order=True, location_id=structure)])
    land(root, 10000001, 0, 2, [order(3, location_id=structure)])
    land(root, 10000001, 0, 3, [])
    land(root, 10000001, 1, 1, [order(4, is_buy_order=True, location_id=structure)])
    land(root, 10000002, 0, 1, "<html>gateway timeout</html>")
    land(root, 10000002, 0, 2, {"error": "not an order"})
    land(root, 10000002, 0, 3, [order(5), {"order_id": 6}])
    return root


def test_pages(spark, landed):
    orders = pages.read_order_pages(spark, landed, 17)
    # of a page with one element that is no order, the others are taken
    assert sorted(r.order_id for r in orders.collect()) == [1, 3, 4, 5]
    first = orders.where("order_id = 1").collect()[0]
    assert first.issued == datetime(2017, 9, 1, 12, 30)
    assert (str(first.price), first.order_set, first.region_id) == ("5.0100", 17, 10000001)


def test_page_accounts(spark, landed):
    raw = pages.read_pages(spark, landed)
    kept = {(r.region_id, r.page, r.ordinal): (r.file_name, r.text) for r in pages.quarantine(raw).collect()}
    assert kept == {
        (10000002, 1, None): ("10000002-1.txt", "<html>gateway timeout</html>"),
        (10000002, 2, None): ("10000002-2.txt", json.dumps({"error": "not an order"}, indent=1)),
        (10000002, 3, 1): ("10000002-3.txt", '{"order_id":6}'),
    }
    accounts = pages.page_manifest(raw)
    by_page = {(r.region_id, r.structure, r.page): (r.n_orders, r.has_next) for r in accounts.collect()}
    assert by_page[10000001, 0, 1] == (2, True) and by_page[10000001, 0, 3] == (0, False)
    assert {(r.n_orders, r.n_rejected, r.n_failed) for r in accounts.where("page = 3").collect()} == {(0, 0, 0), (1, 1, 0)}
    ends = {(r.region_id, r.structure): r.complete for r in pages.region_completeness(accounts).collect()}
    assert ends == {(10000001, 0): True, (10000001, 1): False, (10000002, 0): False}


def test_one_bad_field_costs_one_order(spark):
    """Optional fields may be absent; a field of the wrong kind or a missing id costs that order only."""
    body = json.dumps([
        {k: v for k, v in order(1).items() if k not in ("min_volume", "range", "issued")},
        order(2, price="dear"), order(3, type_id=None), 7, order(4),
    ])
    raw = spark.createDataFrame([(1, 0, 1, body), (1, 0, 2, None), (1, 0, 3, " [ ]"), (1, 0, 4, "[1")],
                                "region_id long, structure int, page int, body string")
    found = {r.order_id: r for r in pages.parse_pages(raw, 9).collect()}
    assert sorted(found) == [1, 4] and found[1].min_volume is None and found[1].issued is None
    bad = sorted((r.page, r.ordinal) for r in pages.quarantine(raw).where("page in (1)").collect())
    assert bad == [(1, 1), (1, 2), (1, 3)]
    assert sorted((r.page, r.ordinal) for r in pages.quarantine(raw).where("page > 1").collect()) == [(2, None), (4, None)]


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_parsed_once(spark, market):
    """One parse per level of a document, whatever is filtered afterwards."""
    assert plan_of(pages.parse_pages(market.feed_pages, 1)).count("from_json") == 2  # page, then element
    assert plan_of(pages.parse_legacy_pages(market.legacy_pages, 1)).count("from_json") == 2
    assert plan_of(pages.next_legacy_pages(market.legacy_pages)).count("from_json") == 1
    assert plan_of(documents.group_types_flat(market.group_docs)).count("from_json") == 1
    types = refdata.upsert_types(market.stored_types, documents.parse_types(market.type_docs))
    assert plan_of(types).count("from_json") == 1
    structures = refdata.new_structures(
        documents.parse_structures(market.structure_docs), market.structure_markets, market.known_structures
    )
    assert plan_of(structures).count("from_json") == 1


def test_legacy_pages(spark, tmp_path):
    folder = tmp_path / "market" / "10000002" / "orders"
    folder.mkdir(parents=True)
    item = {
        "id": 9, "type": 35, "issued": "2016-01-02T03:04:05", "buy": True, "volume": 1,
        "volumeEntered": 2, "minVolume": 1, "price": 1.5, "stationID": 60008494, "range": "5",
        "duration": 30,
    }
    (folder / "1.json").write_text(json.dumps({"items": [item], "next": {"href": "https://x/2/"}}))
    (folder / "2.json").write_text(json.dumps({"items": [dict(item, id=10)]}))
    raw = pages.read_legacy_pages(spark, str(tmp_path / "market"))
    # the first number in the address counts; here the folder tree is the address
    raw = raw.withColumn("url", pages.F.regexp_extract("url", "market/.*", 0))
    got = {r.order_id: (r.region_id, r.buy, r.order_set) for r in pages.parse_legacy_pages(raw, 3).collect()}
    assert got == {9: (10000002, True, 3), 10: (10000002, True, 3)}
    assert [r.next_url for r in pages.next_legacy_pages(raw).collect()] == ["https://x/2/"]


def test_snapshot_tsv(spark, market, tmp_path):
    path = str(tmp_path / "tsv")
    orders = market.orders.select(*snapshots.SNAPSHOT_COLUMNS)
    snapshots.write_snapshot_tsv(orders, path)
    assert as_set(snapshots.read_snapshot_tsv(spark, path)) == as_set(orders)


def test_tsv_reads_other_writers_booleans(spark, tmp_path):
    line = "1\t34\t2017-09-01T12:30:00\tTrue\t5\t9\t1\t5.01\t60003760\tregion\t90\t10000002\t7\n"
    (tmp_path / "a.csv").write_text(line)
    row = snapshots.read_snapshot_tsv(spark, str(tmp_path)).collect()[0]
    assert row.buy is True and row.issued == datetime(2017, 9, 1, 12, 30)


def test_snapshot_table_is_written_once_and_read_when_published(spark, market, tmp_path):
    table, manifest = str(tmp_path / "orders"), str(tmp_path / "manifest")
    rows = market.orders
    snapshots.append_snapshot(rows.where("order_set in (1, 2)"), table)
    snapshots.append_snapshot(rows.where("order_set = 2"), table)  # again
    snapshots.publish_snapshot(spark, manifest, 1, datetime(2024, 1, 1))
    stored = snapshots.read_snapshots(spark, table)
    assert stored.where("order_set = 2").count() == rows.where("order_set = 2").count()
    seen = listing.current_orders(stored, snapshots.read_manifest(spark, manifest))
    assert {r.order_set for r in seen.select("order_set").distinct().collect()} == {1}
    plan = seen._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert "order_set" in filters and "Subquery" in filters  # other snapshots are not read
    snapshots.publish_snapshot(spark, manifest, 2, datetime(2024, 1, 2))
    snapshots.publish_snapshot(spark, manifest, 2, datetime(2024, 1, 3))
    listed = snapshots.read_manifest(spark, manifest)
    assert listed.count() == 2
    kept = snapshots.retain(stored, listed, datetime(2024, 1, 4))
    assert {r.order_set for r in kept.select("order_set").distinct().collect()} == {2}


def test_order_set_bucket(spark):
    ids = spark.createDataFrame([(99,), (100,), (999,), (1000,), (1234,)], "order_set long")
    got = [r[0] for r in ids.select(snapshots.order_set_bucket(ids.order_set)).collect()]
    assert got == [0, 1, 9, 0, 2]


def test_natural_file_order(spark, tmp_path):
    for name in ("orderset-9.csv.gz", "orderset-10.csv.gz", "orderset-100.csv.gz", "note.txt"):
        (tmp_path / name).write_bytes(b"x")
    files = snapshots.snapshot_listing(snapshots.list_files(spark, str(tmp_path)))
    assert [r.name for r in files.collect()] == [
        "orderset-100.csv.gz",
        "orderset-10.csv.gz",
        "orderset-9.csv.gz",
    ]


def test_group_tree(spark):
    groups = spark.createDataFrame(
        [(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 1, "d"), (5, None, "e")],
        "market_group_id int, parent_group_id int, group_name string",
    )
    tree = {r.market_group_id: (r.depth, r.root_group_id, r.path) for r in refdata.group_tree(groups).collect()}
    assert tree == {
        1: (0, 1, "a"), 2: (1, 1, "a/b"), 3: (2, 1, "a/b/c"), 4: (1, 1, "a/d"), 5: (0, 5, "e"),
    }


def test_type_upsert(spark):
    current = spark.createDataFrame(
        [(1, "old", 1, 1, 1.0, True, 1, 1.0, 9.0), (2, "kept", 1, 1, 1.0, True, 1, 1.0, 9.0)],
        "type_id long, type_name string, group_id long, market_group_id long, capacity double,"
        " published boolean, portion_size int, volume double, mass double",
    )
    bodies = [
        {"type_id": 1, "name": "new", "volume": 2.0, "mass": 5.0},
        {"type_id": 2, "name": "no volume"},
        {"type_id": 3, "name": "added", "mass": 4.0, "published": True},
        {"type_id": 4, "volume": 1.0},
    ]
    docs = spark.createDataFrame([(json.dumps(b),) for b in bodies] + [("broken",)], "body string")
    merged = refdata.upsert_types(current, documents.parse_types(docs))
    got = {r.type_id: (r.type_name, r.published, r.volume, r.mass, r.group_id) for r in merged.collect()}
    assert got == {
        1: ("new", False, 2.0, 9.0, None),
        2: ("kept", True, 1.0, 9.0, 1),
        3: ("added", True, None, 4.0, None),
    }


def test_region_universe(spark):
    ids = {r.region_id for r in refdata.region_universe(spark).collect()}
    assert len(ids) == 67 and 10000001 in ids and 10000069 in ids
    assert not ids & {10000000, 10000024, 10000026, 10000070}


def test_search_needs_two_characters(spark, market):
    assert refdata.search_types(market.types, "a").count() == 0
    assert refdata.search_types(market.types, "MK1").count() > 0


def test_locale_order(spark):
    stations = spark.createDataFrame([(1, "b"), (2, "A"), (3, "a"), (4, "C")], "station_id int, station_name string")
    plain = [r.label for r in refdata.dict_stations(stations).collect()]
    by_locale = [r.label for r in refdata.dict_stations(stations, by_locale=True).collect()]
    assert plain == ["A", "C", "a", "b"] and by_locale == ["A", "a", "b", "C"]


def test_positions_by_locale(spark):
    labels = ["Öl", "ol", "OL", "zu", "Zb", "äb", "ab", "aa", "Ac", None, "10", " x"]
    entries = spark.createDataFrame(list(enumerate(labels)), "value int, label string")
    found = sorted(refdata.positions_by_locale(entries).collect(), key=lambda r: r.position)
    assert [r.position for r in found] == list(range(1, len(labels) + 1))
    assert [r.label for r in found] == [None, " x", "10", "aa", "ab", "äb", "Ac", "ol", "OL", "Öl", "Zb", "zu"]


def test_pages_to_fetch(spark, landed):
    accounts = pages.page_manifest(pages.read_pages(spark, landed))
    asked = sorted(
        (r.region_id, r.structure, r.page, r.again) for r in pages.pages_to_fetch(accounts).collect()
    )
    assert asked == [
        (10000001, 1, 2, False),
        (10000002, 0, 1, True),
        (10000002, 0, 2, True),
        (10000002, 0, 4, False),  # page 3 was read; one of its elements is no order
    ]


def test_load_snapshot(spark, landed, tmp_path):
    from depthbook.plans.jobs import load_snapshot

    stations = spark.createDataFrame(
        [(60003760, "hub", 30000142)], "station_id long, station_name string, system_id long"
    )
    regions = spark.createDataFrame([(10000001, "north")], "region_id long, region_name string")
    root = str(tmp_path / "tables")
    for _ in range(2):
        load_snapshot(spark, landed, root, 17, datetime(2024, 1, 1), stations, regions)
    assert spark.read.parquet(f"{root}/orders").count() == 4
    served = {r.key for r in spark.read.parquet(f"{root}/serving").collect()}
    assert served == {
        "0|34|false", "0|34|true", "10000001|34|false", "10000001|34|true", "30000142|34|false",
        "60003760|34|false", "1000000000001|34|false", "1000000000001|34|true", "10000002|34|false",
    }
    dump = spark.read.csv(f"{root}/dump", header=True)
    assert {r.what for r in dump.collect()} == {"10000001|34|false", "10000001|34|true"}
    front = spark.read.json(f"{root}/front").collect()[0]
    assert json.loads(front.fp_sell)[0]["stationName"] == "hub" and front.fp_buy == "[]"
    assert spark.read.parquet(f"{root}/quarantine").count() == 3


def test_search_of_many_terms(spark):
    names = ["Tritanium", "Small Ship", "small ring", "İzmir ring", "x", None, "a.b+c"]
    types = spark.createDataFrame([(i, n, 1) for i, n in enumerate(names)], "type_id long, type_name string, market_group_id int")
    terms = ["ing", "RING", "sm", "all s", "t", "", None, "tritanium!", "Tritanium", ".b+", "ship", "ship"]
    asked = spark.createDataFrame([(t,) for t in terms], "term string")
    found = refdata.search_many(types, refdata.search_index(types), asked)
    low = [n.lower() if n else None for n in names]
    assert as_set(found, ["term", "value"]) == sorted(
        (t, i) for t in {t for t in terms if t and len(t) >= 2} for i, n in enumerate(low) if n and t.lower() in n
    )


def test_broken_lines_are_kept_apart(spark, tmp_path):
    good = "1\t34\t2017-09-01T12:30:00\tTrue\t5\t9\t1\t5.01\t60003760\tregion\t90\t10000002\t7"
    lines = [good, good.replace("5.01", "much"), good + "\t8", "1\t34", "", good.replace("90", ""), 'x"y']
    (tmp_path / "a.csv").write_text("\n".join(lines))
    read = snapshots.parse_snapshot_lines(spark, str(tmp_path))
    assert read.count() == len(lines)
    orders = snapshots.snapshot_orders(read).collect()
    assert [(o.order_id, o.duration) for o in orders] == [(1, 90), (1, None)]
    assert [f.name for f in snapshots.snapshot_orders(read).schema] == [f.name for f in snapshots.ORDERS]
    rejected = snapshots.rejected_lines(read).collect()
    assert sorted(r.line for r in rejected) == sorted([lines[1], lines[2], lines[3], lines[4], lines[6]])
    assert all(r.file.endswith("a.csv") for r in rejected)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "b.csv").write_text("")
    assert snapshots.parse_snapshot_lines(spark, str(tmp_path / "empty")).count() == 0


def test_catalogue_keeps_versions(spark, tmp_path):
    path = str(tmp_path / "catalogue")
    columns = (
        "type_id long, type_name string, group_id long, market_group_id long, capacity double, published boolean,"
        " portion_size int, volume double, mass double"
    )
    fetched = (
        "type_id long, name string, group_id long, market_group_id long, capacity double, published boolean,"
        " portion_size int, volume double, mass double"
    )
    start = spark.createDataFrame([(1, "one", 1, 1, 1.0, True, 1, 1.0, 1.0)], columns)
    refdata.start_catalogue(start, path, datetime(2024, 1, 1))
    same, new = (1, "one", 1, 1, 1.0, True, 1, 1.0, 1.0), (2, "two", 1, None, None, True, 1, None, 2.0)
    deliveries = [[same], [new, same], [(1, "uno", 1, 1, 1.0, True, 1, 1.0, 1.0), new], []]
    for number, rows in enumerate(deliveries, 1):
        for _ in range(2):  # a repeated delivery writes the same
            refdata.append_delivery(spark, path, spark.createDataFrame(rows, fetched), number, datetime(2024, 1, 1 + number))
    day = lambda n: datetime(2024, 1, n)
    assert as_set(refdata.catalogue_history(spark, path), ["type_id", "type_name", "valid_from", "valid_to"]) == sorted(
        [(1, "one", day(1), day(4)), (1, "uno", day(4), None), (2, "two", day(3), None)], key=repr
    )
    assert [as_set(refdata.catalogue(spark, path, n), ["type_id", "type_name"]) for n in range(5)] == [
        [(1, "one")], [(1, "one")], [(1, "one"), (2, "two")], [(1, "uno"), (2, "two")], [(1, "uno"), (2, "two")]
    ]
