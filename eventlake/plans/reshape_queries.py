"""Queries of the reshaping operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..operators import reshape
from .registry import ev, query, read

AGG_ITEMS = "l_linenumber, CAST(l_quantity AS BIGINT) AS q, l_extendedprice AS price, l_returnflag AS flag"


def slots(spark, d):
    """Orders with their line items as an array of slots."""
    items = read(spark, d, "lineitem")
    item = F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q"), F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("day"))
    return reshape.group_collect(items.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], item, "slots")


@query("e01_explode_slots", """SELECT o_orderkey, l_linenumber, q, strftime(day, '%Y-%m-%d') AS day FROM (
SELECT o_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, l_shipdate AS day FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag <> 'R' AND l_quantity > 10
UNION ALL SELECT o_orderkey, NULL, NULL, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) WHERE o_orderkey % 5 NOT IN (0, 1) AND day >= TIMESTAMP '1996-01-01'""")
def e01(spark, d):
    title = F.when(F.col("o_orderkey") % 5 == 0, "A Test show").when(F.col("o_orderkey") % 5 == 1, " ").otherwise(F.col("o_orderpriority"))
    df = read(spark, d, "orders").join(slots(spark, d), "o_orderkey", "left").select("o_orderkey", "slots", "o_orderdate", title.alias("title"))
    out = reshape.explode_slots(df, "slots", lambda s: (s["flag"] != "R") & (s["q"] > 10), "title", lambda s: s["day"], F.to_date("o_orderdate"), F.lit("1996-01-01").cast("date"))
    return out.select("o_orderkey", "slot.l_linenumber", "slot.q", F.date_format("slot_day", "yyyy-MM-dd").alias("day"))


@query("e02_slot_fragment_url", """SELECT l_orderkey, l_linenumber, CASE WHEN n > 1 THEN '/e/' || l_orderkey || '#' || strftime(l_shipdate, '%Y-%m-%dT%H%M') ELSE '/e/' || l_orderkey END AS url
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WHERE l_returnflag <> 'R')""")
def e02(spark, d):
    df = read(spark, d, "lineitem").withColumn("url", F.concat(F.lit("/e/"), F.col("l_orderkey").cast("string")))
    return reshape.slot_fragment_url(df, "l_orderkey", "url", "l_shipdate", F.col("l_returnflag") != "R").select("l_orderkey", "l_linenumber", "url")


@query("e03_expand_daily", """SELECT event_id, CASE WHEN n > 0 THEN name || ' (' || strftime(start_ts + i * INTERVAL '1' DAY, '%b %d') || ')' ELSE name END AS name, strftime(start_ts + i * INTERVAL '1' DAY, '%Y-%m-%d') AS start_day,
strftime(CASE WHEN n > 0 THEN end_ts - (n - i) * INTERVAL '1' DAY ELSE end_ts END, '%Y-%m-%d') AS end_day FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM (SELECT *, greatest(date_diff('day', start_ts, coalesce(end_ts, start_ts)), 0) AS n FROM ev))""")
def e03(spark, d):
    out = reshape.expand_daily(ev(spark, d), "start_ts", "end_ts", "name")
    return out.select("event_id", "name", F.date_format("start_ts", "yyyy-MM-dd").alias("start_day"), F.date_format("end_ts", "yyyy-MM-dd").alias("end_day"))


@query("e04_explode_nested_dates", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 1")
def e04(spark, d):
    venue = F.struct(F.col("slots").alias("dates"))
    k = F.col("o_orderkey") % 3
    venues = F.when(k == 1, F.array(venue)).when(k == 2, F.array(venue, venue)).otherwise(F.slice(F.array(venue), 1, 0))
    df = slots(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), venues.alias("venues"))
    return reshape.explode_nested_dates(df, "venues", "dates").select("l_orderkey", "date.l_linenumber")


@query("e05_dedupe_first", "SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def e05(spark, d):
    return reshape.dedupe_first(read(spark, d, "lineitem"), ["l_partkey"], [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber")


@query("e06_distinct_sorted", "SELECT DISTINCT url FROM pages ORDER BY url")
def e06(spark, d):
    return reshape.distinct_sorted(read(spark, d, "pages"), "url")


@query("e07_sort_records", "SELECT event_id, strftime(start_ts, '%Y-%m-%d') AS day FROM ev ORDER BY start_ts, url")
def e07(spark, d):
    return reshape.sort_records(ev(spark, d), "start_ts", "url").select("event_id", F.date_format("start_ts", "yyyy-MM-dd").alias("day"))


@query("e08_group_collect", "SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS day, string_agg(l_linenumber || ':' || CAST(l_quantity AS BIGINT), '|' ORDER BY l_linenumber, CAST(l_quantity AS BIGINT)) AS items FROM lineitem GROUP BY 1, 2")
def e08(spark, d):
    df = read(spark, d, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q")).alias("item"))
    out = reshape.group_collect(df, ["l_orderkey", "day"], F.col("item"))
    return out.select("l_orderkey", "day", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["l_linenumber"], x["q"])), "|").alias("items"))


@query("e09_zip_keys", "SELECT l_orderkey, strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag AS slot, CAST(l_linenumber AS VARCHAR) AS line, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty, CAST(NULL AS VARCHAR) AS surplus FROM lineitem")
def e09(spark, d):
    trip = F.array(F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))
    rows = read(spark, d, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"), F.col("l_returnflag").alias("slot"), trip.alias("trip"))
    by_slot = reshape.group_collect(rows, ["l_orderkey", "day", "slot"], F.col("trip"), "trips")
    by_day = by_slot.groupBy("l_orderkey", "day").agg(F.map_from_entries(F.collect_list(F.struct("slot", "trips"))).alias("slots"))
    days = by_day.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("day", "slots"))).alias("days"))
    out = reshape.explode_trips(days, "days", F.array(*[F.lit(x) for x in ("line", "qty", "surplus")]))
    return out.select("l_orderkey", "day", "slot", *[F.try_element_at("trip", F.lit(x)).alias(x) for x in ("line", "qty", "surplus")])


@query("e10_lookup_map", "SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN p_retailprice + p_partkey % 4 END AS price FROM part")
def e10(spark, d):
    prices = F.create_map(*[x for i in range(3) for x in (F.lit(i), F.col("p_retailprice") + i)])
    return read(spark, d, "part").select("p_partkey", F.try_element_at(prices, (F.col("p_partkey") % 4).cast("int")).alias("price"))


@query("e11_reverse_lookup_join", """SELECT l_orderkey, l_linenumber, f.fmt, f.lang FROM lineitem LEFT JOIN (SELECT p_partkey, min_by(p_type, (p_size, p_name)) AS fmt, min_by(p_brand, (p_size, p_name)) AS lang FROM part WHERE p_size > 10 GROUP BY 1) f ON l_partkey = p_partkey""")
def e11(spark, d):
    formats = read(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), F.struct("p_size", "p_name").alias("pos"), F.col("p_type").alias("fmt"), F.col("p_brand").alias("lang"))
    shows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return reshape.reverse_lookup_join(shows, formats, "l_partkey").drop("l_partkey")


@query("e12_star_join", "SELECT l_orderkey, l_linenumber, p_name, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size > 20")
def e12(spark, d):
    part = read(spark, d, "part").filter("p_size > 20").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    supplier = read(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return reshape.star_join(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), (part, "l_partkey"), (supplier, "l_suppkey")).drop("l_partkey", "l_suppkey")


@query("e13_sum_availability", "SELECT l_orderkey AS o_orderkey, CAST(sum(CAST(l_quantity AS BIGINT) - 20) AS BIGINT) AS seats FROM lineitem GROUP BY 1 HAVING sum(CAST(l_quantity AS BIGINT) - 20) > 0")
def e13(spark, d):
    seats = nested.array_sum(F.transform("slots", lambda s: s["q"] - 20), "bigint")
    return slots(spark, d).select("o_orderkey", seats.alias("seats")).filter("seats > 0")


def _tiers(spark, d):
    tier = F.transform("slots", lambda s: F.struct(s["flag"].alias("name"), F.when(s["l_linenumber"] % 2 == 0, F.lit(0.0)).otherwise(s["price"]).alias("price"), (s["q"] > 15).alias("is_active"), F.array(F.struct(F.lit(1).alias("slot"), (s["q"] - 25).alias("available")), F.struct(F.lit(2).alias("slot"), F.lit(9).cast("bigint").alias("available"))).alias("capacity")))
    return slots(spark, d).select("o_orderkey", tier.alias("tiers"))


@query("e14_build_offers", "SELECT l_orderkey AS o_orderkey, l_returnflag AS name, CASE WHEN l_quantity > 25 THEN 'InStock' ELSE 'SoldOut' END AS availability, CAST(l_quantity AS BIGINT) - 25 AS remaining FROM lineitem WHERE l_quantity > 15")
def e14(spark, d):
    return _tiers(spark, d).select("o_orderkey", F.explode(nested.build_offers(F.col("tiers"), F.lit(1))).alias("o")).select("o_orderkey", "o.name", "o.availability", "o.remaining")


@query("e15_free_or_paid", "SELECT l_orderkey AS o_orderkey, NOT bool_or(l_linenumber % 2 = 1 AND l_extendedprice > 0) AS is_free FROM lineitem GROUP BY 1")
def e15(spark, d):
    return _tiers(spark, d).select("o_orderkey", nested.free_or_paid(F.col("tiers")).alias("is_free"))


@query("e16_split_addons", "SELECT p_partkey, 2 - CAST(contains(lower(p_type), 'economy') AS INTEGER) - CAST(contains(lower(p_brand), 'economy') AS INTEGER) AS n_offers, CAST(contains(lower(p_type), 'economy') AS INTEGER) + CAST(contains(lower(p_brand), 'economy') AS INTEGER) AS n_addons FROM part")
def e16(spark, d):
    both = nested.split_addons(F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.col("p_brand").alias("name"))), ["economy"])
    return read(spark, d, "part").select("p_partkey", F.size(both["offers"]).alias("n_offers"), F.size(both["addons"]).alias("n_addons"))


@query("e17_pick_variant", "SELECT p_partkey, CASE WHEN contains(p_type, 'SMALL') AND NOT contains(p_brand, 'SMALL') THEN p_type ELSE p_brand END AS title FROM part")
def e17(spark, d):
    variants = F.array(F.struct(F.col("p_brand").alias("title")), F.struct(F.col("p_type").alias("title")))
    return read(spark, d, "part").select("p_partkey", nested.pick_variant(variants, lambda v: v["title"].contains("SMALL"))["title"].alias("title"))


@query("e18_merge_struct", """SELECT event_id, '{"name":"' || CASE WHEN event_id % 2 = 0 THEN organizer ELSE location_name END || '"' || CASE WHEN event_id % 3 = 0 THEN ',"id":' || event_id ELSE '' END || '}' AS merged FROM ev""")
def e18(spark, d):
    base = F.struct(F.col("location_name").alias("name"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("id"))
    merged = base.withField("name", F.when(F.col("event_id") % 2 == 0, F.col("organizer")).otherwise(base["name"]))
    return ev(spark, d).select("event_id", F.to_json(merged).alias("merged"))


@query("e19_first_of", "SELECT event_id, keywords[1] AS first_keyword FROM ev")
def e19(spark, d):
    return ev(spark, d).select("event_id", nested.first_of(F.col("keywords")).alias("first_keyword"))


@query("e20_union_sources", "SELECT event_id, name, CASE WHEN event_id % 2 = 1 THEN organizer END AS organizer FROM ev")
def e20(spark, d):
    df = ev(spark, d)
    return reshape.union_sources(df.filter("event_id % 2 = 0").select("event_id", "name"), df.filter("event_id % 2 = 1").select("name", "event_id", "organizer"))


@query("e21_join_detail", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 8")
def e21(spark, d):
    detail = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    return reshape.join_detail(read(spark, d, "orders").select("o_orderkey", "o_custkey"), detail, "o_custkey", F.col("c_nationkey") == 8).select("o_orderkey", "c_name")


@query("e22_left_join_collect", "SELECT o_orderkey, CAST(count(l_linenumber) AS INTEGER) AS n_tickets, coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber), '') AS tickets FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey GROUP BY 1")
def e22(spark, d):
    children = read(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    out = reshape.left_join_collect(read(spark, d, "orders").select("o_orderkey"), children, "o_orderkey", F.col("l_linenumber"), "tickets")
    return out.select("o_orderkey", F.size("tickets").alias("n_tickets"), F.array_join(F.transform("tickets", lambda x: x.cast("string")), ",").alias("tickets"))
