"""Queries of the normalization operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, nested, text, times
from ..operators import normalize
from .registry import ev, query, read

CENTER = (12.965, 77.588)
_KM = f"2 * 6371.0 * atan2(sqrt(a), sqrt(1 - a)) AS km FROM (SELECT *, pow(sin(radians(lat - {CENTER[0]}) / 2), 2) + cos(radians({CENTER[0]})) * cos(radians(lat)) * pow(sin(radians(lng - {CENTER[1]}) / 2), 2) AS a FROM ev)"
ISO_DUCK = "'%Y-%m-%dT%H:%M:%S'"


@query("n01_set_defaults", "SELECT event_id, 'https://schema.org' AS context, coalesce(CASE WHEN event_id % 2 = 0 THEN 'own' END, url) AS record_url FROM ev")
def n01(spark, d):
    df = ev(spark, d).withColumn("record_url", F.when(F.col("event_id") % 2 == 0, "own"))
    return normalize.set_defaults(df, "https://schema.org").select("event_id", "context", "record_url")


@query("n02_to_zone", f"""SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'soon' ELSE strftime(ts + CASE WHEN event_id % 3 = 0 THEN INTERVAL '0' MINUTE ELSE INTERVAL '330' MINUTE END, {ISO_DUCK}) || '+05:30' END AS local FROM events""")
def n02(spark, d):
    iso = F.date_format("ts", times.ISO)
    raw = F.when(F.col("event_id") % 17 == 0, "soon").when(F.col("event_id") % 3 == 0, F.concat(iso, F.lit("+05:30"))).when(F.col("event_id") % 3 == 1, F.concat(iso, F.lit("Z"))).otherwise(iso)
    return read(spark, d, "events").select("event_id", times.to_zone(raw).alias("local"))


@query("n03_default_end", "SELECT event_id, strftime(CASE WHEN end_ts IS NULL OR end_ts = start_ts THEN start_ts + INTERVAL '2' HOUR ELSE end_ts END, '%Y-%m-%d %H:%M:%S') AS end_text FROM ev")
def n03(spark, d):
    return ev(spark, d).select("event_id", F.date_format(times.default_end(F.col("start_ts"), F.col("end_ts")), "yyyy-MM-dd HH:mm:ss").alias("end_text"))


@query("n04_unwrap_singleton", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN keywords[1] END AS only FROM ev")
def n04(spark, d):
    arr = F.when(F.col("event_id") % 2 == 0, F.slice("keywords", 1, 1)).otherwise(F.col("keywords"))
    return ev(spark, d).select("event_id", nested.unwrap_singleton(arr).alias("only"))


@query("n05_rename_if_present", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'Alias' ELSE name END AS name FROM ev")
def n05(spark, d):
    df = ev(spark, d).withColumn("title", F.when(F.col("event_id") % 3 == 0, "Alias").when(F.col("event_id") % 3 == 1, ""))
    return normalize.rename_if_present(df, "title", "name").select("event_id", "name")


@query("n06_extract_coords", "SELECT event_id, CASE WHEN lat <> 0 AND lng <> 0 AND event_id % 19 <> 0 THEN lat END AS lat, CASE WHEN lat <> 0 AND lng <> 0 AND event_id % 19 <> 0 THEN lng END AS lng FROM ev")
def n06(spark, d):
    lat, lng = geo.valid_pair(F.when(F.col("event_id") % 19 == 0, "north").otherwise(F.col("lat").cast("string")), F.col("lng").cast("string"))
    return ev(spark, d).select("event_id", lat.alias("lat"), lng.alias("lng"))


@query("n07_haversine", f"SELECT event_id, round(km, 6) AS km FROM (SELECT *, {_KM})")
def n07(spark, d):
    return ev(spark, d).select("event_id", F.round(geo.haversine_km(F.lit(CENTER[0]), F.lit(CENTER[1]), F.col("lat"), F.col("lng")), 6).alias("km"))


@query("n08_tag_outside_radius", f"SELECT event_id, array_to_string(CASE WHEN km > 50 AND lat <> 0 AND keywords IS NOT NULL THEN list_sort(list_distinct(list_append(keywords, 'FAR'))) ELSE keywords END, '|') AS keywords FROM (SELECT *, {_KM})")
def n08(spark, d):
    lat, lng = geo.valid_pair(F.col("lat"), F.col("lng"))
    df = ev(spark, d).withColumn("lat", lat).withColumn("lng", F.when(F.col("lat").isNotNull(), F.col("lng")))
    return normalize.tag_outside_radius(df, "lat", "lng", CENTER, 50, "FAR").select("event_id", F.array_join("keywords", "|").alias("keywords"))


@query("n09_fix_offset_suffix", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(start_ts + INTERVAL '330' MINUTE, {ISO_DUCK}) || '+05:30' ELSE strftime(start_ts, {ISO_DUCK}) || 'Z' END AS start_text FROM ev")
def n09(spark, d):
    raw = F.concat(F.date_format("start_ts", times.ISO), F.when(F.col("event_id") % 2 == 0, "+0530Z").otherwise("Z"))
    return ev(spark, d).select("event_id", times.fix_offset_suffix(raw, "+0530Z").alias("start_text"))


@query("n10_pad_date_parts", f"SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(start_ts, {ISO_DUCK}) || '+05:30' ELSE strftime(start_ts, '%Y-%m-%d') END AS padded FROM ev")
def n10(spark, d):
    day = F.concat_ws("-", F.year("start_ts"), F.month("start_ts"), F.day("start_ts"))
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(day, F.date_format("start_ts", "'T'HH:mm:ss"), F.lit("+5.5:00"))).otherwise(day)
    return ev(spark, d).select("event_id", times.pad_date_parts(raw).alias("padded"))


@query("n11_parse_loose_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def n11(spark, d):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format("o_orderdate", "MMMM d, yyyy")).when(k == 1, F.date_format("o_orderdate", "d MMM. yyyy")).when(k == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 3, F.regexp_replace(F.date_format("o_orderdate", "MMM d yyyy"), "Sep ", "Sept. ")).otherwise("to be announced")
    day = times.parse_loose_date(raw, ["MMMM d yyyy", "d MMM yyyy", "yyyy-MM-dd", "MMM d yyyy"])
    return read(spark, d, "orders").select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query("n12_normalize_language", "SELECT doc_id, lang AS lang_name, CASE lang WHEN 'en' THEN 'eng' WHEN 'de' THEN 'deu' ELSE 'und' END AS lang_code FROM documents")
def n12(spark, d):
    df = normalize.normalize_language(read(spark, d, "documents").select("doc_id", "lang"), "lang", {"en": "eng", "de": "deu"})
    return df.select("doc_id", F.col("in_language.name").alias("lang_name"), F.col("in_language.code").alias("lang_code"))


@query("n13_unwrap_typed_scalar", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE props END AS value FROM events")
def n13(spark, d):
    raw = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.lit("Age-Range").alias("@type"), F.col("event_type").alias("language")))).otherwise(F.col("props"))
    return read(spark, d, "events").select("event_id", normalize.unwrap_typed_scalar(raw, "Age-Range", "language").alias("value"))


@query("n14_dedupe_csv", """SELECT doc_id, coalesce(string_agg(w, ', ' ORDER BY i), '') AS words FROM documents LEFT JOIN (SELECT doc_id, w, min(i) AS i FROM (
SELECT doc_id, trim(unnest(string_split(replace(text, ' ', ','), ',')), ' ') AS w, unnest(range(1, len(string_split(replace(text, ' ', ','), ',')) + 1)) AS i FROM documents) WHERE w <> '' GROUP BY 1, 2) USING (doc_id) GROUP BY 1""")
def n14(spark, d):
    return read(spark, d, "documents").select("doc_id", text.dedupe_csv(F.replace("text", F.lit(" "), F.lit(","))).alias("words"))


@query("n15_drop_trailing_offer", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 1 ELSE 2 END AS n_offers, CASE WHEN event_id % 4 = 0 THEN 'Ticket' WHEN event_id % 4 = 1 THEN 'Entry' ELSE 'Pass' END AS last_name FROM ev""")
def n15(spark, d):
    k = F.col("event_id") % 4
    offer = lambda n, p: F.struct(F.lit(n).alias("name"), F.lit(p).alias("price"))
    offers = F.array(offer("Ticket", "10"), F.when(k == 0, offer("Entry", "0")).when(k == 1, offer("Entry", "5")).otherwise(offer("Pass", "0")))
    cut = nested.drop_trailing(offers, lambda o: (o["price"] == "0") & (o["name"] == "Entry"))
    return ev(spark, d).select("event_id", F.size(cut).alias("n_offers"), F.try_element_at(cut, F.lit(-1))["name"].alias("last_name"))


@query("n16_drop_blocklisted", "SELECT event_id FROM ev WHERE organizer NOT IN (SELECT c_name FROM customer WHERE c_custkey % 10 = 0)")
def n16(spark, d):
    ids = read(spark, d, "customer").filter("c_custkey % 10 = 0").select(F.col("c_name").alias("organizer"))
    return normalize.drop_blocklisted(ev(spark, d), ids, "organizer").select("event_id")


@query("n17_url_domain", r"SELECT page_id, nullif(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)', 1), '^www\.', ''), '') AS domain FROM pages")
def n17(spark, d):
    return read(spark, d, "pages").select("page_id", text.url_domain(F.col("url")).alias("domain"))


@query("n18_apply_defaults", """, patch AS (SELECT 'src' || r_regionkey || '.example.org' AS domain, r_name AS location_name, CASE WHEN r_regionkey <> 4 THEN ['SRC', upper(r_name)] END AS kw FROM region WHERE r_regionkey <> 2)
SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN ev.location_name END, patch.location_name) AS location_name,
array_to_string(CASE WHEN kw IS NOT NULL THEN list_sort(list_distinct(list_concat(coalesce(keywords, []), kw))) ELSE keywords END, '|') AS keywords
FROM ev LEFT JOIN patch ON regexp_replace(regexp_extract(url, '://([^/]*)', 1), '^www\\.', '') = domain""")
def n18(spark, d):
    patches = read(spark, d, "region").filter("r_regionkey <> 2").selectExpr("concat('src', r_regionkey, '.example.org') AS domain", "r_name AS location_name", "CASE WHEN r_regionkey <> 4 THEN array('SRC', upper(r_name)) END AS keywords")
    df = ev(spark, d).withColumn("location_name", F.when(F.col("event_id") % 2 == 0, F.col("location_name")))
    return normalize.apply_defaults(df, patches, ["location_name"]).select("event_id", "location_name", F.array_join("keywords", "|").alias("keywords"))


@query("n19_apply_chain", """SELECT event_id, CASE WHEN contains(url, '//www.') THEN upper(name) || '!' ELSE name || '!' END AS name, CASE WHEN contains(url, 'src1') THEN 'Elsewhere' ELSE location_name END AS location_name, TRUE AS modified FROM ev""")
def n19(spark, d):
    steps = [
        normalize.Step("name", lambda df: F.upper("name"), "//www[.]"),
        normalize.Step("name", lambda df: F.concat("name", F.lit("!"))),
        normalize.Step("location_name", lambda df: F.lit("Elsewhere"), "src1"),
    ]
    return normalize.apply_chain(ev(spark, d), steps).select("event_id", "name", "location_name", "modified")


@query("n19_chain_errors", """SELECT event_id, CASE WHEN event_id % 6 > 1 THEN event_id % 50 END AS seats, CASE WHEN contains(url, '//www.') AND event_id % 6 > 1 THEN upper(name) ELSE name END || CASE WHEN event_id % 5 = 0 THEN '' ELSE '!' END AS name,
array_to_string(list_filter([CASE WHEN event_id % 6 = 0 THEN 'seats: not a int: many' END, CASE WHEN contains(url, '//www.') AND event_id % 6 < 2 THEN 'shout: no seats' END, CASE WHEN event_id % 5 = 0 THEN 'mark: not a date: 2026-13-' || event_id END], lambda x: x IS NOT NULL), '|') AS errors,
event_id % 6 > 1 OR event_id % 5 > 0 AS modified FROM ev""")
def n19_errors(spark, d):
    raw = F.when(F.col("event_id") % 6 == 0, "many").when(F.col("event_id") % 6 > 1, (F.col("event_id") % 50).cast("string"))
    day = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("2026-13-"), F.col("event_id").cast("string"))).otherwise("2026-01-02")
    steps = [
        normalize.Step("seats", lambda df: normalize.attempt_cast(F.col("raw"), "int")),
        normalize.Step("name", lambda df: (F.upper("name"), F.when(F.col("seats").isNull(), "no seats")), "//www[.]", "shout"),
        normalize.Step("name", lambda df: (F.concat("name", F.lit("!")), normalize.attempt_cast(F.col("day"), "date")[1]), name="mark"),
    ]
    df = ev(spark, d).withColumns({"raw": raw, "day": day, "seats": F.lit(None).cast("int")})
    out = normalize.apply_chain(df, steps, errors="errors")
    return out.select("event_id", "seats", "name", F.array_join("errors", "|").alias("errors"), "modified")


@query("n19_count_errors", "SELECT 'seats' AS step, count(*) AS n FROM ev WHERE event_id % 6 = 0 HAVING count(*) > 0 UNION ALL SELECT 'late', count(*) FROM ev WHERE end_ts IS NULL HAVING count(*) > 0")
def n19_count(spark, d):
    steps = [
        normalize.Step("seats", lambda df: normalize.attempt_cast(F.when(F.col("event_id") % 6 == 0, "x").otherwise("1"), "int")),
        normalize.Step("end_ts", lambda df: (F.col("end_ts") + F.expr("INTERVAL 1 HOUR"), F.when(F.col("end_ts").isNull(), "no end")), name="late"),
    ]
    return normalize.count_errors(normalize.apply_chain(ev(spark, d).withColumn("seats", F.lit(0)), steps, errors="errors"))
