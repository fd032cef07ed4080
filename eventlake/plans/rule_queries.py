"""Queries of the rule operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import nested, text, times
from ..operators import rules
from ..operators.rules import Rule
from .registry import EV_SQL, ev, query, read


@query("k01_append_tag", "SELECT event_id, array_to_string(CASE WHEN keywords IS NOT NULL AND name ILIKE '%build%' THEN list_append(keywords, 'BUILD') ELSE keywords END, '|') AS keywords FROM ev")
def k01(spark, d):
    return ev(spark, d).select("event_id", F.array_join(nested.append_tag(F.col("keywords"), text.like_ci(F.col("name"), "%Build%"), "BUILD"), "|").alias("keywords"))


@query("k02_drop_where", "SELECT event_id FROM ev WHERE NOT coalesce(end_ts > start_ts, FALSE)")
def k02(spark, d):
    return rules.drop_where(ev(spark, d), F.expr("end_ts > start_ts")).select("event_id")


@query("k03_json_text", "SELECT event_id, json_extract_string(props, '$.k') AS k, CASE WHEN event_id % 2 = 0 THEN '1' ELSE '0' END AS flag, CAST(NULL AS VARCHAR) AS gone FROM events")
def k03(spark, d):
    flag = F.concat(F.lit('{"f":'), F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"), F.lit(',"n":null}'))
    return read(spark, d, "events").select("event_id", text.json_text(F.col("props"), "$.k").alias("k"), text.json_text(flag, "$.f").alias("flag"), text.json_text(flag, "$.n").alias("gone"))


@query("k04_json_value", """SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, '"' || event_type || '"' AS kind FROM events""")
def k04(spark, d):
    raw = F.to_json(F.struct(F.col("event_type").alias("kind")))
    return read(spark, d, "events").select("event_id", text.json_value(F.col("props"), "$.k").alias("k"), text.json_value(raw, "$.kind").alias("kind"))


@query("k05_like_ci", "SELECT doc_id FROM documents WHERE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%é lic%' OR translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') LIKE '%licensed under%'")
def k05(spark, d):
    return read(spark, d, "documents").filter(text.like_ci(F.col("text"), "%é LIC%") | text.like_ci(F.col("text"), "%Licensed under%")).select("doc_id")


@query("k06_in_list_ci", "SELECT c_custkey, lower(c_mktsegment) IN ('building', 'machinery', 'HOUSEHOLD') AS hit FROM customer")
def k06(spark, d):
    return read(spark, d, "customer").select("c_custkey", text.in_list_ci(F.col("c_mktsegment"), ["building", "machinery", "HOUSEHOLD"]).alias("hit"))


@query("k07_equals", "SELECT event_id, location_name = 'NATION_8' AS upper_hit, location_name = 'nation_8' AS lower_hit FROM ev")
def k07(spark, d):
    return ev(spark, d).select("event_id", (F.col("location_name") == "NATION_8").alias("upper_hit"), (F.col("location_name") == "nation_8").alias("lower_hit"))


@query("k08_record_contains", "SELECT event_id FROM ev WHERE concat_ws(' ', url, name, organizer, location_name) ILIKE '%src3%' OR concat_ws(' ', url, name, organizer, location_name) ILIKE '%#000000001%'")
def k08(spark, d):
    whole = F.to_json(F.struct("url", "name", "organizer", "location_name"))
    return ev(spark, d).filter(whole.ilike("%SRC3%") | whole.ilike("%#000000001%")).select("event_id")


RECORD_RULES = [
    Rule(1, "tag", "name LIKE 'AUTO%'", "SCREENING-Ü"),
    Rule(2, "tag", "lower(record) LIKE '%screening-%'", "FILM"),
    Rule(3, "type", "record LIKE '%SCREENING-_u00dc%' AND location_name LIKE '%1'", "ScreeningEvent"),
    Rule(4, "set", "m_2", fields={"organizer": "upper(concat(organizer, ' ', location_name))"}, needs=(2,)),
    Rule(5, "tag", "record LIKE '%\"type\":\"ScreeningEvent\"%'", "TYPED"),
    Rule(6, "delete", "record LIKE '%FILM%' AND record LIKE '%NATION_13%'"),
    Rule(7, "tag", "record LIKE '%/e/7%' AND NOT m_2 AND lat <> 0", "SEVEN", needs=(2,)),
    Rule(8, "tag", "record LIKE '%\"keywords\":[%\"SEVEN\"]%'", "LAST"),
]


@query("k08_record_rules", """, r AS (SELECT *, name LIKE 'AUTO%' AND keywords IS NOT NULL AS a FROM ev), s AS (SELECT *, a AND location_name LIKE '%1' AS t, NOT a AND contains(url, '/e/7') AND lat <> 0 AS v FROM r)
SELECT event_id, CASE WHEN t THEN 'ScreeningEvent' ELSE type END AS type, CASE WHEN a THEN upper(organizer || ' ' || location_name) ELSE organizer END AS organizer,
array_to_string(CASE WHEN keywords IS NOT NULL THEN list_concat(keywords, list_filter([CASE WHEN a THEN 'SCREENING-Ü' END, CASE WHEN a THEN 'FILM' END, CASE WHEN t THEN 'TYPED' END, CASE WHEN v THEN 'SEVEN' END, CASE WHEN v THEN 'LAST' END], lambda x: x IS NOT NULL)) END, '|') AS keywords FROM s WHERE NOT (a AND location_name = 'NATION_13')""")
def k08_rules(spark, d):
    return rules.apply_rules(ev(spark, d), RECORD_RULES).select("event_id", "type", "organizer", F.array_join("keywords", "|").alias("keywords"))


@query("k09_not_tagged", "SELECT event_id FROM ev WHERE NOT list_contains(keywords, 'BUILDING')")
def k09(spark, d):
    return ev(spark, d).filter(~F.array_contains("keywords", "BUILDING")).select("event_id")


@query("k10_spans_days", "SELECT event_id, s[1:10] <> e[1:10] AS spans, s[1:9] <> e[1:9] AS spans_compat FROM (SELECT event_id, strftime(start_ts, '%Y-%m-%dT%H:%M:%S') AS s, strftime(end_ts, '%Y-%m-%dT%H:%M:%S') AS e FROM ev)")
def k10(spark, d):
    s, e = F.date_format("start_ts", times.ISO), F.date_format("end_ts", times.ISO)
    return ev(spark, d).select("event_id", times.spans_days(s, e).alias("spans"), times.spans_days(s, e, compat=True).alias("spans_compat"))


@query("k11_set_type", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN name LIKE 'AUTO%' THEN 'ExhibitionEvent' ELSE 'Event' END AS type FROM ev")
def k11(spark, d):
    df = ev(spark, d).withColumn("type", F.when(F.col("event_id") % 3 != 0, F.col("type")))
    return rules.set_type(df, F.col("name").like("AUTO%"), "ExhibitionEvent").select("event_id", "type")


@query("k12_set_fields", "SELECT event_id, CASE WHEN location_name = 'NATION_8' THEN '1 Main Road' ELSE organizer END AS address, CASE WHEN lat = 0 THEN NULL WHEN location_name = 'NATION_8' THEN 12.5 ELSE lat END AS lat FROM ev")
def k12(spark, d):
    df = ev(spark, d).withColumn("location", F.struct(F.col("organizer").alias("address"), F.struct(F.expr("nullif(lat, 0D)").alias("latitude")).alias("geo")))
    out = rules.set_fields(df, F.col("location_name") == "NATION_8", "location", {"address": F.lit("1 Main Road"), "geo.latitude": F.lit(12.5)})
    return out.select("event_id", F.col("location.address").alias("address"), F.col("location.geo.latitude").alias("lat"))


@query("k13_url_match", "SELECT page_id, url ILIKE 'https://%' AS secure, url ILIKE '%page%' AS has_page FROM pages")
def k13(spark, d):
    return read(spark, d, "pages").select("page_id", text.like_ci(F.col("url"), "https://%").alias("secure"), text.like_ci(F.col("url"), "%page%").alias("has_page"))


def rule_table() -> list[Rule]:
    """47 invented rules of every action: tags by place, segment, host and organizer, types, patches, deletes and dependent ones."""
    places = [f"NATION_{i}" for i in range(20)]
    out = [
        Rule(1, "delete", "lower(organizer) LIKE '%#000000007%'"), Rule(2, "delete", "location_name = 'NATION_22' AND url LIKE 'https://src%'"), Rule(3, "delete", "end_ts < start_ts"),
        Rule(4, "delete", "url LIKE '%/e/13'"), Rule(5, "type", "name LIKE 'AUTO%'", "ExhibitionEvent"), Rule(6, "type", "name LIKE '%URGENT%'", "BusinessEvent"), Rule(7, "type", "lower(name) LIKE '%household%'", "SaleEvent"),
        Rule(8, "tag", "lower(name) LIKE '%low%' OR organizer LIKE '%9'", "LOW-QUALITY"), Rule(9, "tag", "url LIKE 'https://www.%' AND name LIKE '%HIGH%'", "CURATED"),
        Rule(10, "tag", "lower(name) LIKE '%machinery%' AND NOT lower(name) LIKE '%low%'", "WORKSHOP"), Rule(11, "tag", "m_10 AND lat > 12.9", "NORTH-WORKSHOP", needs=(10,)),
        Rule(12, "set", "location_name = 'NATION_21'", fields={"location_name": "'NATION XXI'", "organizer": "upper(organizer)"}), Rule(13, "tag", "m_12 OR location_name LIKE '%_24'", "FAR", needs=(12,)),
        Rule(14, "type", "m_11", "EducationEvent", needs=(11,)), Rule(15, "tag", "end_ts > start_ts AND lower(name) LIKE '%furniture%'", "MULTIDAY"),
    ]
    out += [Rule(16 + i, "tag", f"location_name LIKE '%{p}%'", p) for i, p in enumerate(places)]
    out += [Rule(36 + i, "tag", f"lower(url) LIKE '%src{i}.%' AND (organizer LIKE '%{i}' OR organizer LIKE '%{i + 5}')", f"HOST{i}") for i in range(5)]
    out += [Rule(41 + i, "tag", f"lat <> 0 AND lng > {77.1 + i * 0.2:.1f} AND lng <= {77.3 + i * 0.2:.1f}", f"BAND{i}") for i in range(5)]
    return [*out, Rule(46, "tag", "NOT m_13 AND NOT m_24 AND location_name IN ('NATION_12', 'NATION_14', 'NATION_17')", "NOTHERE", needs=(13, 24)), Rule(47, "tag", "m_46 AND m_8", "NOTHERE-LOW", needs=(8, 46))]


def rules_sql(table: list[Rule]) -> str:
    """The rule table as DuckDB SQL, one outcome column a rule."""
    deletes = " ".join(f"AND NOT coalesce({r.predicate}, FALSE)" for r in table if r.action == "delete")
    steps, last = [f"r0 AS (SELECT * FROM ev WHERE TRUE {deletes})"], "r0"
    for r in table:
        if r.action != "delete":
            steps.append(f"r{r.rule_id} AS (SELECT *, coalesce({r.predicate}, FALSE) AS m_{r.rule_id} FROM {last})")
            last = f"r{r.rule_id}"
    tags = ", ".join(f"CASE WHEN m_{r.rule_id} THEN '{r.value}' END" for r in table if r.action == "tag")
    types = " ".join(f"WHEN m_{r.rule_id} THEN '{r.value}'" for r in reversed(table) if r.action == "type")
    fields = {k: (r.rule_id, v) for r in table if r.action == "set" for k, v in r.fields.items()}
    plain = ", ".join(f"CASE WHEN m_{fields[c][0]} THEN {fields[c][1]} ELSE {c} END AS {c}" if c in fields else c for c in ("event_id", "organizer", "location_name"))
    return EV_SQL + ", " + ", ".join(steps) + f" SELECT {plain}, CASE {types} ELSE type END AS type, array_to_string(CASE WHEN keywords IS NOT NULL THEN list_concat(keywords, list_filter([{tags}], lambda x: x IS NOT NULL)) END, '|') AS keywords FROM {last}"


@query("k14_apply_rules", rules_sql(rule_table()).removeprefix(EV_SQL))
def k14(spark, d):
    return rules.apply_rules(ev(spark, d), rule_table()).select("event_id", "organizer", "location_name", "type", F.array_join("keywords", "|").alias("keywords"))


def literal_rules() -> list[Rule]:
    """47 rules with some 400 literals: substrings of names, hosts and organizers, and whole place names."""
    some = lambda make, i, n: [make(i * n + j) for j in range(n)]
    out = [Rule(1, "delete", any_of={"organizer": ["#000000007", "#000000011"]}), Rule(2, "delete", "lat = 0", equals={"location_name": ["nation_3", "nation_4", "NATION_5"]})]
    out += [Rule(3 + i, "tag", any_of={"organizer": some(lambda x: f"#{x * 7 % 900:09d}", i, 12)}, value=f"ORG{i}") for i in range(15)]
    out += [Rule(18 + i, "tag", any_of={"name": some(lambda x: ("machine", "build", "house", "auto", "urgent", "low", "high", "spec", "furn", "medium")[x % 10] + "y r "[x % 4].strip(), i, 6)}, value=f"NAME{i}") for i in range(10)]
    out += [Rule(28 + i, "tag", "lat > 12.9", any_of={"url": some(lambda x: f"src{x % 5}.example.org/e/{x}", i, 8)}, value=f"URL{i}") for i in range(9)]
    out += [Rule(37 + i, "tag", equals={"location_name": some(lambda x: f"nation_{x % 27}", i, 6)}, value=f"AT{i}") for i in range(9)]
    return [*out, Rule(46, "type", "m_18", "BusinessEvent", needs=(18,), any_of={"name": ["auto", "automobile"]}), Rule(47, "tag", "m_46 AND NOT m_37", "BOTH", needs=(37, 46))]


def _spelled(r: Rule) -> Rule:
    """The rule with its lists written out in the predicate."""
    parts = [r.predicate, *["(" + " OR ".join(f"contains(lower({c}), '{x}')" for x in some) + ")" for c, some in r.any_of.items()], *[f"lower({c}) IN ({', '.join(repr(x) for x in some)})" for c, some in r.equals.items()]]
    return replace(r, predicate=" AND ".join(parts), any_of={}, equals={})


@query("k14_literal_rules", rules_sql([_spelled(r) for r in literal_rules()]).removeprefix(EV_SQL))
def k14_literals(spark, d):
    return rules.apply_rules(ev(spark, d), literal_rules()).select("event_id", "organizer", "location_name", "type", F.array_join("keywords", "|").alias("keywords"))


@query("k15_explode_offers", "SELECT l_orderkey, CAST(trunc(l_extendedprice) AS INTEGER) AS price_int FROM lineitem WHERE trunc(l_extendedprice) >= 999 AND l_linenumber % 5 <> 4")
def k15(spark, d):
    price = F.when(F.col("l_linenumber") % 5 == 4, "on request").otherwise(F.col("l_extendedprice").cast("string"))
    df = read(spark, d, "lineitem").select("l_orderkey", F.array(F.struct(price.alias("price"))).alias("offers"))
    return rules.explode_offers(df, "offers", 999).select("l_orderkey", "price_int")
