"""The same results as SQL over the star schema, run by another engine as a check."""

from __future__ import annotations

VIEWS = r"""
mkt_orders as (
  select l_orderkey as order_id, l_partkey as type_id, l_shipdate as issued, l_linestatus = 'O' as buy,
         cast(l_quantity as bigint) as volume, cast(l_quantity as bigint) + l_linenumber as volume_entered,
         cast(1 as bigint) as min_volume,
         cast(greatest(1, floor(l_extendedprice / 100)) as decimal(19,4)) as price,
         60000000 + l_suppkey as station_id,
         case l_returnflag when 'A' then 'station' when 'N' then 'region' else '5' end as "range",
         90 as duration, 10000000 + n_regionkey as region_id, 30000000 + s_nationkey as system_id,
         l_linenumber as order_set
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
mkt_manifest as (
  select order_set, timestamp '2024-01-01 00:00:00' + order_set * interval 30 minute as downloaded
  from (select distinct l_linenumber as order_set from lineitem)),
latest as (select * from mkt_orders where order_set = (select max(order_set) from mkt_manifest)),
part_groups as (
  select *, cast('0x' || substring(md5(p_type), 1, 6) as int) as category,
         cast(substring(p_brand, 7) as int) as brand_no from part),
mkt_types as (
  select p_partkey as type_id, p_name || ' mk' || cast(p_partkey as varchar) as type_name,
         cast(p_size as double) / 10 as volume, p_size % 7 <> 0 as published,
         case when p_size % 10 <> 0 then 100 * category + brand_no end as market_group_id,
         p_size * 10 as icon_id
  from part_groups),
mkt_groups as (
  select distinct 100 * category + brand_no as market_group_id, category as parent_group_id,
         p_brand as group_name, category % 100 as icon_id, true as has_types from part_groups
  union all
  select distinct category, cast(null as int), p_type, category % 100, false from part_groups),
mkt_stations as (
  select 60000000 + s_suppkey as station_id, s_name as station_name, 30000000 + s_nationkey as system_id
  from supplier where s_suppkey % 17 <> 0),
mkt_systems as (
  select 30000000 + n_nationkey as system_id, 10000000 + n_regionkey as region_id,
         cast(cast(n_nationkey % 13 - 2 as decimal(9,1)) / 10 as decimal(9,1)) as security from nation),
mkt_regions as (select 10000000 + r_regionkey as region_id, r_name as region_name from region),
mkt_region_class as (select 10000000 + r_regionkey as region_id, r_regionkey + 1 as region_type from region),
mkt_hubs as (select 60000000 + s_suppkey as station_id from supplier where s_suppkey in (1, 2, 3, 5, 8)),
mkt_paste as (
  select l_orderkey as list_id, l_partkey as type_id,
         case when l_linenumber = 1 then 1000 * cast(l_quantity as bigint)
              when l_linenumber <= 5 then cast(l_quantity as bigint) else 1 end as qty
  from lineitem join mkt_types on l_partkey = mkt_types.type_id
  where published and market_group_id is not null)
"""

# Where each scope takes its orders from: rows with the columns of mkt_orders and a loc_id.
SCOPES = {
    "region": "select *, region_id as loc_id from mkt_orders",
    "global": "select *, 0 as loc_id from mkt_orders",
    "book": "select * replace (0 as order_set), 0 as loc_id from mkt_orders",
    "station": "select *, station_id as loc_id from mkt_orders"
    " where station_id in (select station_id from mkt_hubs)",
    "system": "select o.*, s.system_id as loc_id from mkt_orders o join mkt_stations s"
    " on o.station_id = s.station_id where s.system_id in (30000001, 30000002)",
    "all": "select *, 0 as loc_id from mkt_orders"
    " union all by name select *, region_id as loc_id from mkt_orders"
    " union all by name select *, station_id as loc_id from mkt_orders"
    " union all by name select o.*, s.system_id as loc_id from mkt_orders o"
    " join mkt_stations s on o.station_id = s.station_id",
}

STATS_COLUMNS = """order_set, loc_id, type_id, buy, weighted_average, max_price, min_price,
  stddev, median, volume, order_count, percentile"""


def stats_views(scope: str, best_first: bool = True) -> str:
    """CTEs `levels` and `stats` for one scope."""
    walk = "case when buy then -price else price end" if best_first else "price"
    return f"""
located as ({SCOPES[scope]}),
levels as (
  select order_set, cast(loc_id as bigint) as loc_id, type_id, buy, price,
         cast(sum(volume) as bigint) as volume
  from located group by all),
bounded as (
  select *, max(price) over g as top, min(price) over g as bottom from levels
  window g as (partition by order_set, loc_id, type_id, buy)),
weighed as (
  select *, case when (buy and 100 * price < top) or (not buy and price > 100 * bottom)
            then 0 else volume end as kept from bounded),
summed as (
  select *, cast(sum(kept) over (g order by {walk} rows unbounded preceding) as bigint) as running,
         cast(sum(kept) over g as bigint) as total from weighed
  window g as (partition by order_set, loc_id, type_id, buy)),
shared as (
  select *, cast(price * 10000 as hugeint) as units,
         case when 20 * running <= total then 20 * kept
                 else greatest(0, total - 20 * (running - kept)) end as share
  from summed),
stats as (
  select order_set, loc_id, type_id, buy,
         case when sum(kept) > 0 then cast(sum(price * kept) as double) / cast(sum(kept) as double) end
           as weighted_average,
         max(price) as max_price, min(price) as min_price,
         coalesce(sqrt(cast(count(*) * sum(units * units) - sum(units) * sum(units) as double)
           / nullif(cast(count(*) as double) * (cast(count(*) as double) - 1), 0)) / 10000, 0.01) as stddev,
         median(cast(price as double)) as median,
         cast(sum(kept) as bigint) as volume, count(*) as order_count,
         case when sum(share) > 0 then cast(sum(price * share) as double) / cast(sum(share) as double) end
           as percentile
  from shared group by order_set, loc_id, type_id, buy)"""


def sql(body: str, *views: str) -> str:
    return "with " + ",\n".join([VIEWS.strip(), *[v.strip() for v in views]]) + "\n" + body.strip()


def _wide() -> str:
    """Two decimals, rounded half up on the decimal digits of the number."""
    columns = []
    for name, short in (
        ("weighted_average", "wavg"), ("max_price", "max"), ("min_price", "min"),
        ("stddev", "stddev"), ("median", "median"), ("volume", "volume"),
        ("order_count", "count"), ("percentile", "fivep"),
    ):
        for side, match in (("sell", "not buy"), ("buy", "buy")):
            value = f"max({name}) filter ({match})"
            if name not in ("volume", "order_count"):
                value = f"cast(cast({value} as varchar) as decimal(19,2))"
            columns.append(f"{value} as {short}_{side}")
    return ", ".join(columns)


def depth_oracles() -> dict[str, str]:
    whole = f"select {STATS_COLUMNS} from stats"
    return {
        "agg_region": sql(whole, stats_views("region")),
        "agg_global": sql(whole, stats_views("global")),
        "agg_global_book": sql(whole, stats_views("book")),
        "agg_station": sql(whole, stats_views("station")),
        "agg_system": sql(whole, stats_views("system", best_first=False)),
        "agg_system_best_first": sql(whole, stats_views("system")),
        "agg_all_scopes": sql(whole, stats_views("all")),
        "agg_global_pieces": sql(whole, stats_views("global")),
        "agg_all_scopes_pieces": sql(whole, stats_views("all")),
        "price_levels": sql(
            "select order_set, loc_id, type_id, buy, price, volume from levels",
            stats_views("region"),
        ),
        "agg_wide": sql(f"select order_set, loc_id, type_id, {_wide()} from stats group by all",
                        stats_views("region")),
    }



# ---------------------------------------------------------------------- listings


def _listing(
    side: str,
    joins: str = "",
    extra: str = "o.region_id",
    price: str = "price",
    source: str = "latest",
    key: str = "o.type_id",
    order: str = "",
) -> str:
    buy = side == "buy"
    order = order or ("price desc" if buy else "price")
    return sql(f"""
        select order_id, o.type_id, issued, o.volume, volume_entered, min_volume, {price} as price,
               o.station_id{', "range"' if buy else ""}, duration, station_name, type_name,
               region_name, {extra},
               row_number() over (partition by {key} order by {order}, o.region_id, order_id,
                 o.station_id, o.volume, issued, "range") as position
        from {source} o
        join mkt_stations sta on o.station_id = sta.station_id
        join mkt_types it on o.type_id = it.type_id
        join mkt_regions mr on o.region_id = mr.region_id {joins}
        where {"buy" if buy else "not buy"}""")


def listing_oracles() -> dict[str, str]:
    forms = {
        "region_api": {
            "joins": "join mkt_systems ms on sta.system_id = ms.system_id",
            "extra": "o.region_id, security, sta.system_id",
            "price": "cast(round(price, 2) as decimal(19,2))",
        },
        "type": {},
        "region": {"key": "o.region_id, o.type_id"},
        "station": {"key": "o.station_id, o.type_id"},
        "empire": {
            "joins": "join mkt_region_class rc on o.region_id = rc.region_id and region_type <= 2"
        },
        "hub": {"joins": "join mkt_hubs hub on o.station_id = hub.station_id"},
    }
    history = {
        "extra": "order_set",
        "source": "mkt_orders",
        "key": "order_id",
        "order": "order_set desc, o.type_id, price",
    }
    made = {}
    for side in ("sell", "buy"):
        for name, form in forms.items():
            made[f"orders_{name}_{side}"] = _listing(side, **form)
        made[f"order_history_{side}"] = _listing(side, **history)
    return made


def _view(side: str) -> str:
    ranged = '"range" := "range", ' if side == "buy" else ""
    order = "-price" if side == "buy" else "price"
    return f"""
        select order_set, type_id, (n - 1) // 1000 as page, max(type_name) as type_name,
               count(*) as n_orders,
               cast(to_json(list(struct_pack(order_id, type_id, issued := issued_text,
                 volume, volume_entered, min_volume, price := cast(price as varchar), station_id,
                 {ranged}duration, station_name, type_name, region_name, region_id,
                 security := cast(security as varchar), system_id) order by n)) as varchar) as orders,
               '{side}' as side
        from (
          select o.*, strftime(issued, '%Y-%m-%d %H:%M:%S') as issued_text,
                 row_number() over (partition by type_id
                   order by {order}, region_id, order_id, station_id, volume, issued, "range") as n
          from (
            select o.order_set, o.order_id, o.type_id, issued, o.volume, volume_entered, min_volume,
                   cast(round(price, 2) as decimal(19,2)) as price, o.station_id, "range", duration,
                   station_name, type_name, region_name, o.region_id, security, sta.system_id
            from latest o join mkt_stations sta on o.station_id = sta.station_id
            join mkt_types it on o.type_id = it.type_id
            join mkt_regions mr on o.region_id = mr.region_id
            join mkt_systems ms on sta.system_id = ms.system_id
            where {"buy" if side == "buy" else "not buy"}) o)
        group by order_set, type_id, page"""


def order_oracles() -> dict[str, str]:
    return {
        "market_view_doc": sql(_view("buy") + " union all " + _view("sell")),
        "market_view_header": sql("""
            select t.type_id, t.type_name, (select max(order_set) from mkt_manifest) as order_set,
                   coalesce(n_buy, 0) as n_buy, coalesce(n_sell, 0) as n_sell
            from mkt_types t left join (
              select o.type_id, count(*) filter (buy) as n_buy, count(*) filter (not buy) as n_sell
              from latest o join mkt_stations sta on o.station_id = sta.station_id
              join mkt_regions mr on o.region_id = mr.region_id
              join mkt_systems ms on sta.system_id = ms.system_id group by o.type_id) c
            on t.type_id = c.type_id"""),
        "orders_api_one_region_sell": _listing(
            "sell",
            "join mkt_systems ms on sta.system_id = ms.system_id",
            "o.region_id, security, sta.system_id",
            "cast(round(price, 2) as decimal(19,2))",
        ) + " and o.region_id = 10000002",
        "orders_one_station_buy": _listing("buy") + " and o.station_id = 60000003",
        "orders_one_type_sell": "select * exclude (position) from (" + _listing("sell") + " and o.type_id = 23)",
        "market_view_pieces": sql(_view("buy") + " union all " + _view("sell")),
        "orders_type_sell_pieces": _listing("sell"),
        "distinct_orders": sql("""
            select * exclude (n) from (
              select *, row_number() over (partition by order_set, order_id
                order by region_id, station_id, type_id, price, volume, issued, buy) as n
              from mkt_orders) where n = 1"""),
        "latest_order_set": sql("select max(order_set) as order_set from mkt_manifest"),
    }


LIVE = """
live as (
  select * exclude (age) from (
    select *, row_number() over (partition by loc_id, type_id, buy order by order_set desc) as age from stats
    where order_set in (select order_set from mkt_manifest
      where downloaded + interval 5400 second >= timestamp '2024-01-01 03:40:00')) where age = 1)"""


# ------------------------------------------------------------------------ boards


def _top(side: str) -> str:
    return f"""
        select coun, station_name, station_id, vol from (
          select station_id, count(*) as coun, cast(sum(volume) as bigint) as vol from latest
          where {"buy" if side == "buy" else "not buy"} group by station_id)
        join mkt_stations using (station_id) order by coun desc, station_id limit 10"""


def _top_json(side: str) -> str:
    return f"""
        select '{side}' as side, cast(to_json(list(struct_pack(coun := coun,
          "stationName" := station_name, "stationID" := station_id, vol := vol)
          order by coun desc, station_id)) as varchar) as board
        from ({_top(side)})"""


_BOARD_ITEMS = """items(place, type_id, label) as (values (0, 34, 'Tritanium'), (1, 35, 'Pyrite'),
  (2, 36, 'Mexallon'), (3, 37, 'Isogen'), (4, 38, 'Nocxium'), (5, 39, 'Zydrine'), (6, 40, 'Megacyte'),
  (7, 11399, 'Morphite'), (8, 44992, 'PLEX'), (9, 40520, 'Skill Injector'))"""

_STATISTICS = (
    "weighted_average", "max_price", "min_price", "stddev", "median", "volume", "order_count",
    "percentile",
)


def board_oracles() -> dict[str, str]:
    sides = ", ".join(
        f"coalesce(max(cast({name} as double)) filter ({match}), 0) as {side}_{name}"
        for side, match in (("buy", "buy"), ("sell", "not buy"))
        for name in _STATISTICS
    )
    return {
        "top_stations_sell": sql(_top("sell")),
        "top_stations_buy": sql(_top("buy")),
        "top_stations_json": sql(f"({_top_json('sell')}) union all ({_top_json('buy')})"),
        "front_page": sql(f"""
            select (select board from ({_top_json("sell")})) as fp_sell,
                   (select board from ({_top_json("buy")})) as fp_buy,
                   strftime((select max(downloaded) from mkt_manifest), '%Y-%m-%d %H:%M') as fp_lastupdate"""),
        "item_board": sql(
            f"""
            select cast(h.station_id as bigint) as loc_id, place, cast(i.type_id as bigint) as type_id,
                   label, {sides}
            from mkt_hubs h cross join items i
            left join live s
              on s.loc_id = h.station_id and s.type_id = i.type_id
            group by all""",
            _BOARD_ITEMS,
            stats_views("station"),
            LIVE,
        ),
    }


# ----------------------------------------------------------------------- lookups


def _number_text(value: str) -> str:
    """Twelve significant digits; a plain whole number gets one decimal."""
    text = f"printf('%.12g', cast({value} as double))"
    return f"case when {text} similar to '.*[.e].*' then {text} else {text} || '.0' end"


def _payload() -> str:
    fields = [
        f"coalesce(cast({n} as varchar), '')" if n == "order_count"
        else f"coalesce({_number_text(n)}, '')"
        for n in _STATISTICS
    ]
    return " || '|' || ".join(fields)


_SERVING = f"""
serving as (
  select order_set, loc_id || '|' || type_id || '|' || case when buy then 'true' else 'false' end as key,
         {_payload()} as payload, loc_id, type_id, buy
  from stats)"""

_REQUESTS = """
requests as (
  select c_custkey as request_id, c_mktsegment = 'BUILDING' as in_body,
         case when c_nationkey % 4 = 0 then cast(10000000 + c_custkey % 5 as varchar) end as region,
         case when c_nationkey % 4 <= 1 then cast(60000000 + c_custkey % 90 as varchar) end as station,
         case when c_nationkey % 4 <= 2 then cast(30000000 + c_custkey % 25 as varchar) end as system,
         cast(c_custkey % 199 as varchar) as a, cast(c_custkey % 83 as varchar) as b, c_acctbal
  from customer),
tokens as (
  select distinct request_id,
         coalesce(case when in_body and c_acctbal > 5000 then '10000002'
                       when in_body and c_acctbal > 2000 then '30000003' end,
                  region, station, system, '0') as place,
         unnest(case when in_body then [b, '7'] else [a, b, '0' || b, 'abc'] end) as token
  from requests),
sides(buy, side) as (values (true, 'buy'), (false, 'sell')),
found as (
  select request_id, place, token, side, s.* exclude (order_set, loc_id, type_id, buy)
  from tokens cross join sides
  left join live s on cast(s.loc_id as varchar) = place
    and cast(s.type_id as varchar) = token and s.buy = sides.buy)"""


def _side_document() -> str:
    labels = (
        "weightedAverage", "max", "min", "stddev", "median", "volume", "orderCount", "percentile",
    )
    fields = []
    for name, label in zip(_STATISTICS, labels, strict=True):
        shown = f"cast({name} as varchar)" if name == "order_count" else _number_text(name)
        fields.append(f"\"{label}\" := case when coalesce({name}, 0) = 0 then '0' else {shown} end")
    return f"struct_pack({', '.join(fields)})"


def lookup_oracles() -> dict[str, str]:
    numbers = ", ".join(f"coalesce(cast({n} as double), 0) as {n}" for n in _STATISTICS)
    decoded = []
    for name in _STATISTICS:
        text = f"cast({name} as varchar)" if name == "order_count" else _number_text(name)
        decoded.append(f"coalesce(cast({text} as double), 0) as {name}")
    expiry = "downloaded + interval 5400 second"
    return {
        "serving_rows": sql(
            f"""select s.order_set, key, payload, {expiry} as expires_at
            from serving s join mkt_manifest m on s.order_set = m.order_set""",
            stats_views("region"), _SERVING,
        ),
        "serving_decode": sql(
            f"select order_set, loc_id, type_id, buy, {', '.join(decoded)} from stats",
            stats_views("region"),
        ),
        "live_aggregates": sql(
            f"""select key, order_set, payload, {expiry} as expires_at from (
              select s.*, downloaded, row_number() over (partition by key order by s.order_set desc) as n
              from serving s join mkt_manifest m on s.order_set = m.order_set
              where {expiry} >= timestamp '2024-01-01 03:40:00') where n = 1""",
            stats_views("region"), _SERVING,
        ),
        "agg_lookup": sql(
            f"select request_id, place, token, side, {numbers} from found",
            stats_views("all"), LIVE, _REQUESTS,
        ),
        "agg_lookup_stored": sql(
            f"select request_id, place, token, side, {numbers} from found",
            stats_views("all"), LIVE, _REQUESTS,
        ),
        "agg_lookup_json": sql(
            """select request_id, token, cast(to_json(struct_pack(
                 buy := max(doc) filter (side = 'buy'), sell := max(doc) filter (side = 'sell')))
                 as varchar) as entry
               from (select *, """ + _side_document() + """ as doc from found)
               group by request_id, token""",
            stats_views("all"), LIVE, _REQUESTS,
        ),
    }


# --------------------------------------------------------------------- appraisal

_INVENTORY = """
inventory as (
  select list_id, type_id, cast(sum(qty) as bigint) as quantity from mkt_paste group by list_id, type_id)"""

_LINES = """
prices as (
  select loc_id, type_id, max(percentile) filter (buy) as best_buy,
         max(percentile) filter (not buy) as best_sell,
         max(cast(max_price as double)) filter (buy) as max_buy,
         max(cast(min_price as double)) filter (not buy) as min_sell
  from live group by loc_id, type_id),
lines as (
  select i.list_id, cast(10000000 + o_custkey % 5 as bigint) as loc_id, i.type_id, type_name,
         cast(quantity as double) as quantity,
         quantity * coalesce(best_buy, 0) as pbuy, quantity * coalesce(best_sell, 0) as psell,
         quantity * coalesce(max_buy, 0) as mbuy, quantity * coalesce(min_sell, 0) as msell,
         quantity * t.volume as volume
  from inventory i join orders on i.list_id = o_orderkey join mkt_types t on i.type_id = t.type_id
  left join prices p on p.loc_id = 10000000 + o_custkey % 5 and p.type_id = i.type_id
  where o_orderpriority <> '5-LOW')"""


_STORED = """
parts as (
  select list_id, cast(type_id // 1000 as bigint) as part,
         '{' || string_agg('"' || type_id || '":' || quantity || '.0', ',' order by cast(type_id as varchar)) || '}' as list
  from inventory group by list_id, part),
names as (
  select list_id, sha256(list_id || chr(10) || string_agg(sha256(list), chr(10) order by sha256(list))) as identifier
  from parts group by list_id)"""


def appraisal_oracles() -> dict[str, str]:
    totals = ", ".join(
        f"cast(sum(cast(cast({t} as varchar) as decimal(30,6))) as decimal(38,6)) as {t}"
        for t in ("pbuy", "mbuy", "psell", "msell", "volume")
    )
    return {
        "paste_parse": sql("select list_id, type_id, qty as quantity from mkt_paste"),
        "paste_rules": sql("""
            select case l_linenumber when 1 then 2 when 2 then 3 when 3 then 4 when 4 then 6 when 5 then 7
                   when 6 then 8 else 11 end as rule, count(*) as n_lines
            from lineitem join mkt_types on l_partkey = mkt_types.type_id
            where published and market_group_id is not null group by rule"""),
        "paste_more": """
            select p_partkey as list_id,
                   case p_partkey % 4 when 0 then '30 day pilot licence ' || p_partkey
                     when 3 then 'nothing known ' || p_partkey else lower(p_name) end as name,
                   case p_partkey % 4 when 0 then 5 when 1 then cast('17' || p_partkey as bigint) else 1 end as quantity
            from part""",
        "paste_rules_more": """
            select case p_partkey % 4 when 0 then 1 when 1 then 5 when 2 then 10 else 11 end as rule,
                   count(*) as n_lines from part group by rule""",
        "appraisal_stored": sql("select list_id, part, list, identifier from parts join names using (list_id)", _INVENTORY, _STORED),
        "appraisal_document": sql(
            f"""select r.list_id, r.loc_id, region_name, identifier, coalesce(n_lines, 0) as n_lines,
                   {", ".join(f"coalesce({t}, 0) as {t}" for t in ("pbuy", "mbuy", "psell", "msell", "volume"))}
            from (select o_orderkey as list_id, cast(10000000 + o_custkey % 5 as bigint) as loc_id from orders
                  where o_orderpriority <> '5-LOW') r
            join mkt_regions on region_id = r.loc_id left join names on names.list_id = r.list_id
            left join (select list_id, loc_id, count(*) as n_lines, {totals} from lines group by list_id, loc_id) t
              on t.list_id = r.list_id and t.loc_id = r.loc_id""",
            stats_views("region"), LIVE, _INVENTORY, _LINES, _STORED,
        ),
        "paste_blocks": sql(
            "select list_id, type_id, 2 * quantity as quantity from inventory", _INVENTORY
        ),
        "paste_inventory": sql("select * from inventory", _INVENTORY),
        "appraisal_list_roundtrip": sql("select * from inventory", _INVENTORY),
        "appraisal_lines": sql("select * from lines", stats_views("region"), LIVE, _INVENTORY, _LINES),
        "appraisal_totals": sql(
            f"select list_id, loc_id, {totals} from lines group by list_id, loc_id",
            stats_views("region"), LIVE, _INVENTORY, _LINES,
        ),
    }


# ---------------------------------------------------------------- reference data

_TREE = """
tree as (
  select market_group_id, group_name, 0 as depth, market_group_id as root_group_id, group_name as path
  from mkt_groups where parent_group_id is null
  union all
  select g.market_group_id, g.group_name, depth + 1, root_group_id, path || '/' || g.group_name
  from mkt_groups g join tree t on g.parent_group_id = t.market_group_id)"""


_TERMS = """
  select upper(substring(type_name, 1 + type_id % 9, 2 + type_id % 5)) || case when type_id % 11 = 3 then '#' else '' end as term
  from mkt_types"""

_TYPE_FIELDS = {
    "type_name": "new_name", "group_id": "2", "market_group_id": "new_group", "capacity": "new_capacity",
    "published": "coalesce(new_published, false)", "portion_size": "new_portion", "volume": "new_volume",
}


def _type_versions() -> str:
    """The states of the types table after each delivery, and what each has changed."""
    names = {1: "case when p_size <> 7 then upper(p_name) end", 2: "case when p_size <> 7 then upper(p_name) end"}
    names[3] = "case when p_size = 30 then p_name || ' II' when p_size <> 31 then upper(p_name) end"
    chosen = {1: "p_size <> 25", 2: "p_size = 25", 3: "true"}
    parts = ["""
state_0 as (
  select p_partkey as type_id, p_name as type_name, cast(1 as bigint) as group_id, cast(p_size as bigint) as market_group_id,
         cast(5.0 as double) as capacity, true as published, 1 as portion_size, p_retailprice as volume,
         cast(7.5 as double) as mass
  from part where p_size <= 40)"""]
    for k in (1, 2, 3):
        fields = ", ".join(f"case when takes then {new} else {old} end as {old}" for old, new in _TYPE_FIELDS.items())
        parts.append(f"""
state_{k} as (
  select type_id, {fields}, case when known then mass else new_mass end as mass
  from (
    select *, coalesce(s.had, false) as known,
           n.came is not null and (s.had is null or new_volume is not null) as takes
    from (select *, true as had from state_{k - 1}) s full join (
      select p_partkey as type_id, true as came, {names[k]} as new_name,
             case when p_size % 10 <> 0 then cast(p_size + 1000 as bigint) end as new_group,
             case when p_size > 20 then cast(p_size as double) * 1.5 end as new_capacity,
             case when p_size % 6 <> 0 then p_size % 4 <> 0 end as new_published,
             case when p_size > 10 then p_size end as new_portion,
             case when p_size % 9 <> 0 then cast(p_size as double) / 4 end as new_volume,
             case when p_size > 30 then p_retailprice end as new_mass
      from part where {chosen[k]} and {names[k]} is not null) n using (type_id)))""")
    changed = ["select *, timestamp '2024-01-01' as valid_from from state_0"]
    changed += [
        f"select *, timestamp '2024-01-0{1 + k}' from (select * from state_{k} except select * from state_{k - 1})" for k in (1, 2, 3)
    ]
    return f"""
select *, lead(valid_from) over (partition by type_id order by valid_from) as valid_to from (
  with {", ".join(parts)} {" union all ".join(changed)})"""


def refdata_oracles() -> dict[str, str]:
    children = """select coalesce(parent_group_id, 0) as opened_group_id, parent_group_id,
                         market_group_id, group_name, icon_id, has_types from mkt_groups"""
    listed = "from mkt_types where market_group_id is not null"
    return {
        "published_types": sql(f"select type_id, type_name, volume {listed} and published"),
        "dict_types": sql(f"select type_id as value, type_name as label {listed}"),
        "dict_regions": sql("""
            select region_id as value, region_name as label from mkt_regions
            where region_id < 11000000 and region_id not in (10000004, 10000017)"""),
        "dict_stations": sql("select station_id as value, station_name as label from mkt_stations"),
        "dict_types_by_locale": sql(f"""
            select value, label, row_number() over (order by strip_accents(lower(label)), lower(label), value) as position
            from (select type_id as value, case type_id % 3 when 0 then upper(type_name)
                    when 1 then translate(type_name, 'aoi', 'áöî')
                    else array_to_string(list_transform(string_split(type_name, ' '),
                      lambda w: upper(w[1]) || w[2:]), ' ') end as label {listed})"""),
        "type_search": sql(f"""
            select type_id as value, type_name as label {listed} and type_name ilike '%ing%'"""),
        "type_search_many": sql(f"""
            select distinct term, type_id as value, type_name as label
            from (select type_id as value, type_name as label {listed}) e(type_id, type_name)
            join ({_TERMS}) on contains(lower(type_name), lower(term)) where length(term) >= 2"""),
        "type_versions": sql(_type_versions()),
        "market_group_children": sql(children),
        "market_group_roots": sql(children + " where parent_group_id is null"),
        "market_group_types": sql(f"select market_group_id, type_id, type_name, icon_id {listed}"),
        "market_group_doc": sql("""
            select opened_group_id, cast(to_json(struct_pack(
                     marketgroups := coalesce(marketgroups, []), types := coalesce(types, []),
                     groupid := opened_group_id)) as varchar) as document
            from (
              select coalesce(parent_group_id, 0) as opened_group_id, list(struct_pack("marketGroupName" := group_name,
                       "marketGroupID" := market_group_id, "iconID" := icon_id, "hasTypes" := has_types)
                       order by group_name, market_group_id) as marketgroups
              from mkt_groups group by all)
            full join (
              select market_group_id as opened_group_id, list(struct_pack("typeName" := type_name,
                       "typeID" := type_id, "iconID" := icon_id) order by type_name, type_id) as types
              from mkt_types where market_group_id is not null group by all) using (opened_group_id)"""),
        "market_group_tree": sql("select * from tree", _TREE).replace("with ", "with recursive ", 1),
        "security_class": sql("""
            select system_id, security, case when security > 0.5 then 'high'
              when security > 0 then 'low' else 'null' end as security_class,
              case when security = 0 then '0' else regexp_replace(cast(cast(printf('%.0e', security)
                as decimal(38,30)) as varchar), '\\.?0+$', '') end as security_text
            from (select system_id, cast(security as double) * case system_id % 3 when 0 then 0.042
                    when 1 then 0.00137 else 1.0 end as security from mkt_systems)"""),
        "region_universe": sql("""
            select order_set, region_id, count(*) as n_orders from mkt_orders
            where region_id between 10000001 and 10000069 and region_id not in (10000024, 10000026)
            group by order_set, region_id"""),
        "group_types_flat": sql(f"select cast(market_group_id as bigint) as market_group_id, type_id {listed}"),
        "type_missing": sql(f"""
            select type_id {listed} and type_id in (select p_partkey from part where p_size = 25)"""),
        "type_upsert": sql("""
            select type_id, case when takes then new_name else type_name end as type_name,
                   cast(case when takes then 2 else group_id end as bigint) as group_id,
                   cast(case when takes then new_group else market_group_id end as bigint) as market_group_id,
                   case when takes then new_capacity else capacity end as capacity,
                   case when takes then coalesce(new_published, false) else published end as published,
                   case when takes then new_portion else portion_size end as portion_size,
                   case when takes then new_volume else volume end as volume,
                   case when known then mass else new_mass end as mass
            from (
              select p_partkey as type_id, p_size <= 40 as known, p_name as type_name, 1 as group_id,
                     p_size as market_group_id, cast(5.0 as double) as capacity, true as published,
                     1 as portion_size, p_retailprice as volume, cast(7.5 as double) as mass,
                     upper(p_name) as new_name,
                     case when p_size % 10 <> 0 then p_size + 1000 end as new_group,
                     case when p_size > 20 then cast(p_size as double) * 1.5 end as new_capacity,
                     case when p_size % 6 <> 0 then p_size % 4 <> 0 end as new_published,
                     case when p_size > 10 then p_size end as new_portion,
                     case when p_size % 9 <> 0 then cast(p_size as double) / 4 end as new_volume,
                     case when p_size > 30 then p_retailprice end as new_mass,
                     p_size not in (25, 7) and (p_size > 40 or p_size % 9 <> 0) as takes
              from part)"""),
        "structure_regions": sql("""
            select 1000000000000 + station_id as station_id, region_id
            from mkt_stations join mkt_systems using (system_id) where station_id % 10 = 0"""),
        "structure_stations": sql("""
            select 1000000000000 + s_suppkey as station_id, s_name as station_name,
                   cast(case s_suppkey % 7 when 0 then 35826 when 1 then 35827 when 2 then 35833
                     when 3 then 35834 else 40340 end as bigint) as station_type_id,
                   cast(30000000 + s_nationkey as bigint) as system_id,
                   s_acctbal as x, s_acctbal * 2 as y, -s_acctbal as z
            from supplier
            where s_nationkey <> 7 and s_suppkey % 7 <= 4 and s_suppkey % 5 <> 0 and s_acctbal <= 8000"""),
    }


# ---------------------------------------------------------------- feeds and files

_FEED = """
feed as (
  select *, (page % 13 = 5) as broken, volume in (48, 50) as bad,
         row_number() over (partition by order_set, region_id, structure, page
           order by order_id, type_id, station_id, volume, price, issued) - 1 as ordinal
  from (
    select * exclude (system_id) replace (case when station_id % 10 = 0 then 1000000000000 + station_id
             else station_id end as station_id),
           case when station_id % 10 = 0 and order_set % 2 = 0 then 1 else 0 end as structure,
           cast(order_id // 50 as int) as page
    from mkt_orders)),
ruled as (
  select * exclude (broken, bad, ordinal), broken, bad from feed
  where not (structure = 0 and station_id > 100000000 and buy)),
page_counts as (
  select region_id, structure, page,
         count(*) filter (not broken and not bad) as n_orders,
         count(*) filter (not broken and bad) as n_rejected,
         count(distinct order_set) filter (broken) as n_failed
  from feed group by all
  union all select region_id, 0, 2000000000, 0, 0, 0 from mkt_regions
  union all select region_id, 0, 2000000001, 0, 0, 1 from mkt_regions)"""

_ORDER_COLUMNS = """order_id, type_id, issued, buy, volume, volume_entered, min_volume, price, station_id,
  "range", duration, region_id, order_set"""


# Feeds with their pages numbered; snapshots all of whose feeds end and are mended, and the one that lands again.
_PUBLISHED = """
numbered as (
  select *, dense_rank() over (partition by order_set, region_id, structure order by page) as number from feed),
publications as (
  select distinct order_set, 1 as publication from numbered
  where order_set <> 6 and order_set <> 7
     or order_set = 6 and not exists (select * from numbered where order_set = 6 and region_id = 10000001 and number % 5 = 2)
     or order_set = 7 and not exists (select * from numbered where order_set = 7 and region_id = 10000002 and structure = 0)
  union all select distinct order_set, 2 from numbered where order_set = 2)"""

_LATEST = sql(
            """select key, order_set, payload, downloaded + interval 5400 second as expires_at from (
              select s.*, downloaded, row_number() over (partition by key order by s.order_set desc) as n
              from serving s join mkt_manifest m on s.order_set = m.order_set
              where downloaded + interval 5400 second >= (select max(downloaded) from mkt_manifest)) where n = 1""",
            stats_views("all"), _SERVING,
        )


def feed_oracles() -> dict[str, str]:
    return {
        "feed_rule": sql("select * exclude (page, broken, bad) from ruled", _FEED),
        "ingest_pages": sql(
            f"""select {_ORDER_COLUMNS} from (
              select * replace (case when volume <> 49 then min_volume end as min_volume) from ruled
              where not broken and not bad)""",
            _FEED,
        ),
        "ingest_pages_legacy": sql(
            f"""select {_ORDER_COLUMNS} from (
              select * replace (cast(region_id as bigint) as region_id) from mkt_orders where volume <> 50)"""
        ),
        "legacy_next_pages": sql("""
            select 'https://feed.example/market/' || region_id || '/orders/all/' as url,
                   'https://feed.example/market/' || region_id || '/orders/all/?page=2' as next_url,
                   count(*) as n
            from (select distinct order_set, region_id, order_id // 50 as page from mkt_orders)
            where page % 2 = 0 group by region_id"""),
        "page_quarantine": sql(
            """
            select order_set, region_id, structure, page, cast(ordinal as int) as ordinal,
                   region_id || '-' || page || '.txt' as file_name
            from feed where bad and not broken
            union all
            select distinct order_set, region_id, structure, page, cast(null as int),
                   region_id || '-' || page || '.txt' from feed where broken
            union all
            select 0, region_id, 0, 2000000001, null, region_id || '-2000000001.txt' from mkt_regions""",
            _FEED,
        ),
        "page_manifest": sql("select *, n_orders + n_rejected > 0 as has_next from page_counts", _FEED),
        "region_completeness": sql(
            """
            select region_id, structure, max(page) as last_page, cast(sum(n_orders) as bigint) as n_orders,
                   bool_or(n_orders + n_rejected = 0 and n_failed = 0) and sum(n_failed) = 0 as complete
            from page_counts group by region_id, structure""",
            _FEED,
        ),
        "pages_to_fetch": sql(
            """
            select region_id, structure, page, true as again from page_counts where n_failed > 0
            union all
            select region_id, structure, page + 1, false from page_counts c where n_orders + n_rejected > 0
              and page = (select max(page) from page_counts d
                          where d.region_id = c.region_id and d.structure = c.structure)""",
            _FEED,
        ),
        "order_set_bucket": sql("""
            select order_set * 170 as order_set, cast((order_set * 170) // 100 % 10 as bigint) as order_set_bucket,
                   count(*) as n_orders
            from mkt_orders group by order_set"""),
        "snapshot_tsv_roundtrip": sql(f"""
            select {_ORDER_COLUMNS} from (select * replace (cast(region_id as bigint) as region_id,
              cast(order_set as bigint) as order_set) from mkt_orders)"""),
        "snapshot_tsv_checked": sql("""
            select order_id, type_id, issued, volume, price, order_set, cast(null as varchar) as line from mkt_orders
            union all
            select null, null, null, null, null, null,
                   case volume when 50 then order_id || chr(9) || '34'
                     when 49 then order_id || chr(9) || 'no type' || repeat(chr(9) || '1', 11)
                     else order_id || repeat(chr(9) || order_id, 13) end
            from mkt_orders where volume >= 48"""),
        "snapshot_table": sql(
            "select order_id, type_id, buy, volume, price, station_id, region_id from latest"
        ),
        "snapshot_files": sql("""
            select 'orderset-' || order_set * 5 || '.csv.gz' as name,
                   'orderset-' || order_set * 5 || '.csv.gz' as path from mkt_manifest"""),
        "aggregate_dump": sql(
            """
            select loc_id || '|' || type_id || '|' || case when buy then 'true' else 'false' end as what,
                   weighted_average as weightedaverage, max_price as maxval, min_price as minval, stddev,
                   median, cast(volume as double) as volume, order_count as numorders,
                   percentile as fivepercent, order_set as "orderSet" from stats""",
            stats_views("region"),
        ),
        "retained_orders": sql("""
            select order_set, order_id, type_id, station_id, volume, price from mkt_orders
            where timestamp '2024-01-01' + order_set * interval 12 hour
              >= timestamp '2024-01-04 12:00:00' - interval 2 day"""),
        "stream_aggregates": sql(f"select {STATS_COLUMNS} from stats", stats_views("all")),
        "stream_latest": sql(
            """select key, order_set, payload, downloaded + interval 5400 second as expires_at from (
              select s.*, downloaded, row_number() over (partition by key order by s.order_set desc) as n
              from serving s join mkt_manifest m on s.order_set = m.order_set) where n = 1""",
            stats_views("all"), _SERVING,
        ),
        "serving_changes": _LATEST,
        "stream_publish": sql(
            """
            select order_set, publication, region_id, buy, count(*) as n_orders, cast(sum(volume) as bigint) as volume,
                   cast(sum(price * volume) as decimal(28,4)) as value
            from numbered join publications using (order_set)
            where not bad and not (structure = 0 and station_id > 100000000 and buy)
              and not (publication = 2 and number = 1 and volume < 25)
            group by all""",
            _FEED, _PUBLISHED,
        ),
        "snapshot_versions": sql("""
            select order_set, publication, region_id, buy, count(*) as n_orders, cast(sum(volume) as bigint) as volume,
                   cast(sum(price * volume) as decimal(28,4)) as value
            from mkt_orders, (values (1, 0), (2, 10)) v(publication, least) where volume >= least group by all"""),
        "retention_sweep": sql("""
            select order_set, order_id, type_id, station_id, volume, price, buy from mkt_orders
            where timestamp '2024-01-01' + order_set * interval 12 hour
              >= timestamp '2024-01-04 12:00:00' - interval 2 day and (order_set <> 6 or not buy)"""),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **depth_oracles(),
        **listing_oracles(),
        **order_oracles(),
        **board_oracles(),
        **lookup_oracles(),
        **appraisal_oracles(),
        **refdata_oracles(),
        **feed_oracles(),
    }
