"""Queries of the date, time and number operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from .registry import ev, query, read

AS_OF = "1996-01-01"
STAMP = "yyyy-MM-dd HH:mm:ss"
_H = "CAST(o_orderkey % 11 + 1 AS BIGINT)"


@query("t01_parse_time_range", f"""SELECT o_orderkey, CASE WHEN k <> 3 THEN strftime(d + h * INTERVAL '1' HOUR + CASE WHEN k = 1 THEN INTERVAL '30' MINUTE ELSE INTERVAL '0' MINUTE END + CASE WHEN k <> 2 THEN INTERVAL '12' HOUR ELSE INTERVAL '0' HOUR END, '%Y-%m-%d %H:%M:%S') END AS start_text,
CASE WHEN k <> 3 THEN strftime(d + CASE WHEN h = 11 THEN 0 ELSE h + 1 END * INTERVAL '1' HOUR + CASE WHEN k = 2 AND h < 11 THEN INTERVAL '0' HOUR ELSE INTERVAL '12' HOUR END, '%Y-%m-%d %H:%M:%S') END AS end_text
FROM (SELECT o_orderkey, date_trunc('day', o_orderdate) AS d, o_orderkey % 4 AS k, {_H} AS h FROM orders)""")
def t01(spark, d):
    k, h = F.col("o_orderkey") % 4, F.expr(_H)
    # the four forms: "3 - 4 PM", "3:30 PM to 4 PM", "10 AM - 11 AM" and no range
    form = F.when(k == 0, F.concat(h.cast("string"), F.lit(" - "), (h + 1).cast("string"), F.lit(" PM"))).when(k == 1, F.concat(h.cast("string"), F.lit(":30 to "), (h + 1).cast("string"), F.lit(" PM")))
    form = form.when(k == 2, F.concat(F.lit("at "), h.cast("string"), F.lit(" AM -"), (h + 1).cast("string"), F.when(h == 11, " PM").otherwise(" AM"))).otherwise("all day")
    r = times.parse_time_range(form, F.col("o_orderdate"))
    return read(spark, d, "orders").select("o_orderkey", F.date_format(r["start"], STAMP).alias("start_text"), F.date_format(r["end"], STAMP).alias("end_text"))


@query("t02_parse_hour_range", f"""SELECT o_orderkey, CASE k WHEN 0 THEN CASE WHEN h = 11 THEN 11 ELSE h + 12 END WHEN 1 THEN h WHEN 2 THEN CASE WHEN h + 12 > 13 THEN h ELSE h + 12 END END AS start_hour,
CASE k WHEN 0 THEN CASE WHEN h = 11 THEN 12 ELSE h + 13 END WHEN 1 THEN h + 2 WHEN 2 THEN 13 END AS end_hour FROM (SELECT o_orderkey, o_orderkey % 4 AS k, CAST({_H} AS INTEGER) AS h FROM orders)""")
def t02(spark, d):
    k, h = F.col("o_orderkey") % 4, F.expr(_H)
    form = F.when(k == 0, F.concat(h.cast("string"), F.lit(" PM - "), (h + 1).cast("string"), F.lit(" PM"))).when(k == 1, F.concat(F.lit("from "), h.cast("string"), F.lit("am"))).when(k == 2, F.concat(h.cast("string"), F.lit(" PM - 1 PM"))).otherwise("none")
    r = times.parse_hour_range(form)
    return read(spark, d, "orders").select("o_orderkey", r["start_hour"].alias("start_hour"), r["end_hour"].alias("end_hour"))


@query("t03_to_24h", """SELECT event_id, strftime(ts, '%H:%M') || ':00' AS clock, lpad(CAST(CASE WHEN hour(ts) < 12 THEN (hour(ts) + 11) % 12 + 1 ELSE (hour(ts) + 11) % 12 + 13 END AS VARCHAR), 2, '0') || strftime(ts, ':%M') || ':00' AS clock_compat FROM events""")
def t03(spark, d):
    raw = F.date_format("ts", "hh:mm a")
    return read(spark, d, "events").select("event_id", times.to_24h(raw).alias("clock"), times.to_24h(raw, compat=True).alias("clock_compat"))


@query("t04_parse_duration", "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN CAST(l_quantity AS BIGINT) * 3600 + l_linenumber * 60 WHEN 1 THEN CAST(l_quantity AS BIGINT) * 86400 END AS seconds FROM lineitem")
def t04(spark, d):
    q = F.col("l_quantity").cast("bigint").cast("string")
    raw = F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit(" Hours "), F.col("l_linenumber").cast("string"), F.lit(" Minutes"))).when(F.col("l_linenumber") % 3 == 1, F.concat(q, F.lit(" days"))).otherwise("a while")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", times.parse_duration(raw).alias("seconds"))


@query("t05_duration_hours", "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_quantity + 1 WHEN 1 THEN l_quantity WHEN 2 THEN 0 END AS hours FROM lineitem")
def t05(spark, d):
    q, k = F.col("l_quantity").cast("bigint"), F.col("l_linenumber") % 4
    raw = F.when(k == 0, F.concat(q.cast("string"), F.lit(" to "), (q + 1).cast("string"), F.lit(" hrs, easy"))).when(k == 1, F.concat(q.cast("string"), F.lit(" hours"))).when(k == 2, "unknown").otherwise("2 days / 1 night")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", times.duration_hours(raw).alias("hours"))


@query("t06_parse_date_range", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS start_day, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate + INTERVAL '40' DAY, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS end_day FROM orders")
def t06(spark, d):
    k, fmt = F.col("o_orderkey") % 3, "MMMM d, yyyy"
    raw = F.when(k == 0, F.concat(F.date_format("o_orderdate", fmt), F.lit(" to "), F.date_format(F.expr("o_orderdate + INTERVAL '40' DAY"), fmt))).when(k == 1, F.date_format("o_orderdate", fmt)).otherwise("soon to be told")
    r = times.parse_date_range(raw)
    return read(spark, d, "orders").select("o_orderkey", F.date_format(r["start"], "yyyy-MM-dd").alias("start_day"), F.date_format(r["end"], "yyyy-MM-dd").alias("end_day"))


@query("t07_future_only", f"SELECT event_id FROM ev WHERE start_ts >= TIMESTAMP '{AS_OF}'")
def t07(spark, d):
    return times.future_only(ev(spark, d), "start_ts", F.expr(f"TIMESTAMP_NTZ '{AS_OF} 00:00:00'")).select("event_id")


@query("t08_within_horizon", f"SELECT event_id FROM ev WHERE start_ts BETWEEN TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' + INTERVAL '30' DAY")
def t08(spark, d):
    return times.within_horizon(ev(spark, d), "start_ts", F.expr(f"TIMESTAMP_NTZ '{AS_OF} 00:00:00'"), 30).select("event_id")


@query("t09_drop_long", "SELECT event_id FROM ev WHERE coalesce(date_diff('day', start_ts, end_ts), 0) <= 1")
def t09(spark, d):
    return times.drop_long(ev(spark, d), "start_ts", "end_ts", 1).select("event_id")


@query("t10_epoch_ms", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def t10(spark, d):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return read(spark, d, "events").select("event_id", F.date_format(F.timestamp_millis(ms), STAMP).alias("at"))


@query("t11_fix_datetime_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') || ':00+05:30' AS at FROM events")
def t11(spark, d):
    return read(spark, d, "events").select("event_id", times.fix_datetime_text(F.date_format("ts", STAMP)).alias("at"))


@query("t12_attach_zone", "SELECT event_id, strftime(ts - INTERVAL '330' MINUTE, '%Y-%m-%d %H:%M:%S') AS instant FROM events")
def t12(spark, d):
    return read(spark, d, "events").select("event_id", F.date_format(times.attach_zone(F.col("ts").cast("timestamp")), STAMP).alias("instant"))


@query("t13_price_norm", "SELECT l_orderkey, l_linenumber, CAST(CAST(ceil(CAST(l_extendedprice AS DECIMAL(20, 6))) AS BIGINT) AS VARCHAR) AS whole, CAST((CAST(l_quantity AS BIGINT) + l_linenumber) / 100 AS DOUBLE) AS minor FROM lineitem")
def t13(spark, d):
    raw = F.concat(F.lit("₹ "), F.format_number(F.col("l_extendedprice").cast("decimal(20,6)"), 6))
    minor = text.price_minor(F.col("l_quantity").cast("bigint"), F.col("l_linenumber"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.price_int(raw).alias("whole"), minor.cast("double").alias("minor"))
