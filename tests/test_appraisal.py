"""Pasted lists: the rule table, odd input and pricing."""

from depthbook.operators import appraisal

TYPES = "type_id long, type_name string, volume double, published boolean, market_group_id long"
LINES = [
    ("Tritanium (1,000 units)\r", 2, "tritanium", "1000"),
    ("Tritanium\tmineral\t250", 3, "tritanium", "250"),
    ("5 Pyerite", 4, "pyerite", "5"),
    ("Isogen\t1.234.567\tfoo\tbar", 5, "isogen", "1234567"),
    ("Mexallon: 12,345", 6, "mexallon", "12345"),
    ("Zydrine\t77", 7, "zydrine", "77"),
    ("[Rifter, my fit]", 8, "rifter", "1"),
    ("Rifter, Qty: 3", 6, "rifter, qty", "3"),
    ("x\tRifter\ty", 10, "rifter", "1"),
    ("Rifter", 11, "rifter", "1"),
    ("30 Day Pilot's License\t2\tx", 1, "30 day pilot's license", "2"),
    ("Vexor\t12,\tz", 5, "vexor", "12,"),
    ("1,2,3 Pyerite", 11, "12,3 pyerite", "1"),
    ("Rifter: 1,,2", 6, "rifter", "12"),
    ("", 11, "", "1"),
]


def test_rule_table(spark):
    lines = spark.createDataFrame([(i, t[0]) for i, t in enumerate(LINES)], "list_id int, line string")
    parsed = {r.list_id: r for r in appraisal.parse_pasted(lines).collect()}
    assert len(parsed) == len(LINES)
    for i, (line, _, name, quantity) in enumerate(LINES):
        assert (parsed[i].name, parsed[i].quantity_text) == (name, quantity), line
    assert parsed[11].quantity == 12.0
    counts = {r.rule: r.n_lines for r in appraisal.rule_counts(lines).collect()}
    wanted = {}
    for _, rule, _, _ in LINES:
        wanted[rule] = wanted.get(rule, 0) + 1
    assert counts == wanted


def test_blueprint_copies_are_left_out(spark):
    blocks = spark.createDataFrame([(1, "Rifter Blueprint Copy\n2 Rifter\nRIFTER")], "list_id int, block string")
    parsed = appraisal.parse_pasted(appraisal.split_blocks(blocks)).collect()
    assert sorted((r.name, r.quantity) for r in parsed) == [("rifter", 1.0), ("rifter", 2.0)]
    ids = blocks.select(appraisal.list_identifier(blocks.list_id, blocks.block).alias("i"))
    assert ids.first().i == ids.first().i and len(ids.first().i) == 64


def test_leading_numbers(spark):
    texts = ["12,", "5.", ".5", ",5", "", "7"]
    lines = spark.createDataFrame([(t,) for t in texts], "t string")
    from depthbook.functions.paste import leading_number

    got = [r[0] for r in lines.select(leading_number(lines.t)).collect()]
    assert got == [12.0, 5.0, 0.5, 0.0, 0.0, 7.0]


def test_inventory_and_prices(spark):
    types = spark.createDataFrame(
        [
            (34, "Tritanium", 0.01, True, 5),
            (587, "Rifter", 27289.0, True, 9),
            (588, "RIFTER", 1.0, True, 9),
            (99, "Hidden", 1.0, False, 9),
            (98, "Ungrouped", 1.0, True, None),
        ],
        TYPES,
    )
    lines = spark.createDataFrame(
        [(1, "10 Tritanium"), (1, "Tritanium\t5"), (1, "Rifter"), (1, "Hidden"), (1, "Ungrouped")],
        "list_id int, line string",
    )
    inventory = appraisal.paste_inventory(appraisal.parse_pasted(lines), types)
    got = {r.type_id: r.quantity for r in inventory.collect()}
    assert got == {34: 15.0, 588: 1.0}  # of equal names the highest id
    again = appraisal.stored_inventory(appraisal.store_lists(inventory))
    assert {r.type_id: r.quantity for r in again.collect()} == got

    aggregates = spark.createDataFrame(
        [(1, 34, True, 4.0, 5.0, 1.0), (1, 34, False, 6.0, 9.0, 5.5)],
        "loc_id long, type_id long, buy boolean, percentile double, max_price double, min_price double",
    )
    requests = spark.createDataFrame([(1, "1"), (2, "x1")], "list_id int, region string")
    priced = {
        r.type_id: r for r in appraisal.appraise(inventory, requests, aggregates, types).collect()
    }
    line = priced[34]
    assert (line.pbuy, line.psell, line.mbuy, line.msell) == (60.0, 90.0, 75.0, 82.5)
    assert priced[588].pbuy == 0.0 and priced[588].volume == 1.0
    totals = appraisal.appraisal_totals(
        appraisal.appraise(inventory, requests, aggregates, types)
    ).collect()
    assert len(totals) == 1 and totals[0].mbuy == 75.0
