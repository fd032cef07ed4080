"""Queries of the classification, lookup and validation operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import nested, text
from ..operators import lookup, normalize, validate
from .registry import ev, query, read


@query("c01_classify_first", "SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'large|medium') THEN 'Metal' WHEN regexp_matches(lower(p_type), '^small') THEN NULL WHEN regexp_matches(lower(p_type), 'economy') THEN 'Coated' ELSE 'Other' END AS type FROM part WHERE regexp_matches(lower(p_type), 'large|medium') OR NOT regexp_matches(lower(p_type), '^small')")
def c01(spark, d):
    return lookup.classify_records(read(spark, d, "part"), "p_type", [("large|medium", "Metal"), ("^small", None), ("economy", "Coated")], "Other").select("p_partkey", "type")


@query("c02_classify_overrides", "SELECT doc_id, CASE WHEN regexp_matches(text, 'License') THEN 'LiteraryEvent' WHEN regexp_matches(text, '[0-9]') THEN 'ScreeningEvent' ELSE 'Event' END AS type, CASE WHEN regexp_matches(text, 'License') THEN 'workFeatured' WHEN regexp_matches(text, '[0-9]') THEN 'workPresented' END AS work FROM documents")
def c02(spark, d):
    rules = [("[0-9]", "ScreeningEvent", "workPresented"), ("License", "LiteraryEvent", "workFeatured")]
    return lookup.classify_overrides(read(spark, d, "documents").select("doc_id", "text"), "text", rules, "Event").select("doc_id", "type", "work")


@query("c03_detect_language_word", r"SELECT doc_id, CASE WHEN regexp_matches(text, '\bOf\b') THEN 'of' WHEN regexp_matches(text, '\bDer\b') THEN 'de' ELSE 'en' END AS code FROM documents")
def c03(spark, d):
    return read(spark, d, "documents").select("doc_id", lookup.detect_language_word(F.col("text"), {"Der": "de", "Of": "of"}).alias("code"))


@query("c04_detect_subtitle_language", "SELECT doc_id, CASE lang WHEN 'fr' THEN 'fr' WHEN 'en' THEN 'en' END AS code FROM documents")
def c04(spark, d):
    line = F.concat(F.lit("With "), F.when(F.col("lang") == "fr", "FRENCH Subtitles").when(F.col("lang") == "en", "english subtitles").otherwise("no subtitles"))
    return read(spark, d, "documents").select("doc_id", lookup.detect_subtitle_language(line, {"French": "fr", "English": "en"}).alias("code"))


PHRASE = "thereandofderlaquesunouerinateonblions"


@query("c05_gazetteer_match", f"SELECT doc_id, n_name AS place, CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_regionkey AS DOUBLE) END AS lat FROM (SELECT doc_id, min(n_nationkey) AS k FROM documents LEFT JOIN nation ON contains(lower(text), substr('{PHRASE}', n_nationkey + 1, 5)) GROUP BY 1) LEFT JOIN nation ON k = n_nationkey")
def c05(spark, d):
    places = read(spark, d, "nation").select(F.col("n_nationkey").alias("priority"), F.concat(F.lit("(?i)"), F.substr(F.lit(PHRASE), F.col("n_nationkey") + 1, F.lit(5))).alias("pattern"), F.col("n_name").alias("place"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_regionkey").cast("double")).alias("lat"))
    return lookup.gazetteer_match(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", places).select("doc_id", "place", "lat")


@query("c06_any_substring", "SELECT doc_id FROM documents WHERE contains(lower(text), 'license') OR contains(lower(text), 'idiot')")
def c06(spark, d):
    return read(spark, d, "documents").filter(text.any_substring(F.col("text"), ["license", "idiot", "Never"])).select("doc_id")


@query("c07_none_substring", "SELECT page_id FROM pages WHERE NOT (contains(lower(url), '1') OR contains(lower(url), 'news'))")
def c07(spark, d):
    return read(spark, d, "pages").filter(~text.any_substring(F.col("url"), ["1", "news"])).select("page_id")


@query("c08_choose_location", "SELECT event_id, CASE WHEN name LIKE 'AUTO%' THEN 'Hall A' ELSE 'Hall B' END AS place, CASE WHEN name LIKE 'AUTO%' THEN '1 East Road' ELSE '2 West Road' END AS address FROM ev")
def c08(spark, d):
    at = lookup.choose_location(F.concat_ws(" ", "name", "location_name"), "^AUTO", {"name": "Hall A", "address": "1 East Road"}, {"name": "Hall B", "address": "2 West Road"})
    return ev(spark, d).select("event_id", at["name"].alias("place"), at["address"].alias("address"))


@query("c09_map_codes", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'EventScheduled' WHEN '2-HIGH' THEN 'EventPostponed' END AS status, CASE o_orderstatus WHEN 'F' THEN 'SoldOut' WHEN 'O' THEN 'InStock' WHEN 'P' THEN 'LimitedAvailability' END AS availability FROM orders")
def c09(spark, d):
    status = nested.map_codes(F.col("o_orderpriority"), {"1-URGENT": "EventScheduled", "2-HIGH": "EventPostponed"})
    strict = nested.map_codes(F.col("o_orderstatus"), {"F": "SoldOut", "O": "InStock", "P": "LimitedAvailability"}, strict=True)
    return read(spark, d, "orders").select("o_orderkey", status.alias("status"), strict.alias("availability"))


@query("c10_age_band", "SELECT event_id, CASE WHEN keywords[1] = 'BUILDING' THEN '18+' WHEN keywords[2] = '5-LOW' THEN '3-12' ELSE '12+' END AS ages FROM ev")
def c10(spark, d):
    return ev(spark, d).select("event_id", lookup.age_band(F.col("keywords"), [("BUILDING", "18+"), ("5-LOW", "3-12")]).alias("ages"))


@query("c11_member_name", "SELECT c_custkey, CASE WHEN c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3) THEN c_nationkey END AS venue FROM customer")
def c11(spark, d):
    known = read(spark, d, "nation").filter("n_regionkey = 3").select(F.col("n_nationkey").alias("c_nationkey"))
    return lookup.member_name(read(spark, d, "customer"), "c_nationkey", known).select("c_custkey", "venue")


@query("c12_split_location", "SELECT c_custkey, c_name AS place, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'Annex, ' || c_mktsegment || ', ' || n_name END AS address FROM customer JOIN nation ON c_nationkey = n_nationkey")
def c12(spark, d):
    df = read(spark, d, "customer").join(read(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    raw = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_name", F.lit(" – "), "c_mktsegment", F.lit(", Springfield"))).otherwise(F.concat("c_name", F.lit(" | Annex, "), "c_mktsegment", F.lit(", "), "n_name"))
    at = text.split_location(raw, "Springfield")
    return df.select("c_custkey", at["name"].alias("place"), at["address"].alias("address"))


@query("c13_title_parts", "SELECT p_partkey, p_name AS before_bar, string_split(p_name, ' ')[1] AS without_last, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS venue, p_name || ' - ' || p_brand AS joined FROM part")
def c13(spark, d):
    venue = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" at "), "p_brand")).otherwise(F.col("p_brand"))
    return read(spark, d, "part").select(
        "p_partkey", text.title_before(F.concat("p_name", F.lit(" | Brand "), "p_brand")).alias("before_bar"), text.title_without_last(F.col("p_name"), " ", 1).alias("without_last"),
        text.title_venue(venue).alias("venue"), F.concat_ws(" - ", "p_name", "p_brand").alias("joined"),
    )


@query("c14_compose_name", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ': ' ELSE '' END || c_name || '/Live in ' || CASE WHEN c_custkey % 3 = 0 THEN 'Old Town' ELSE n_name END AS title FROM customer JOIN nation ON c_nationkey = n_nationkey")
def c14(spark, d):
    df = read(spark, d, "customer").join(read(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"))
    title = lookup.compose_name(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")), F.array(F.col("c_name"), F.lit("Live")), F.when(F.col("c_custkey") % 3 == 0, "Old Town"), F.col("n_name"))
    return df.select("c_custkey", title.alias("title"))


@query("c15_extract_capture", "SELECT doc_id, coalesce(nullif(regexp_extract(text, 'under the ([A-Z][a-z]+)', 1), ''), nullif(regexp_extract(text, 'under ([A-Z]+ [A-Z-]+)', 1), '')) AS capture FROM documents")
def c15(spark, d):
    return read(spark, d, "documents").select("doc_id", lookup.extract_capture(F.col("text"), ["under the ([A-Z][a-z]+)", "under ([A-Z]+ [A-Z-]+)"]).alias("capture"))


@query("c16_keywords_build", "SELECT p_partkey, array_to_string(list_sort([p_brand, 'PART', string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]]), '|') AS keywords FROM part")
def c16(spark, d):
    parts = F.split("p_name", " ")
    listed = text.csv_keywords(F.concat(parts[0], F.lit(" , "), parts[1], F.lit(",")))
    return read(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(F.concat(F.array("p_brand", F.lit("PART")), listed)), "|").alias("keywords"))


@query("c17_build_url", "SELECT p_partkey, 'https://shop.example.org/?p=' || replace(replace(p_name || ' ' || p_brand, '#', '%23'), ' ', '%20') || '#id=' || p_partkey AS url FROM part")
def c17(spark, d):
    return read(spark, d, "part").select("p_partkey", text.build_url("https://shop.example.org/?p={slug}#id={id}", slug=F.concat_ws(" ", "p_name", "p_brand"), id=F.col("p_partkey").cast("string")).alias("url"))


@query("c18_sport_from_slug", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'tennis' WHEN 1 THEN 'Football' END AS sport FROM pages")
def c18(spark, d):
    slug = F.when(F.col("page_id") % 3 == 0, "open-city-2024-tennis-final").when(F.col("page_id") % 3 == 1, "soccer-night").otherwise("chess")
    return read(spark, d, "pages").select("page_id", lookup.sport_from_slug(slug, {"soccer": "Football", "run": "Running"}).alias("sport"))


def faulty(spark, d):
    """Event records with injected faults."""
    k = F.col("event_id")
    return ev(spark, d).select(
        "event_id", "url", F.when(k % 23 == 0, None).when(k % 29 == 0, "").otherwise(F.col("name")).alias("name"), F.when(k % 7 == 0, "Party").otherwise(F.col("type")).alias("type"),
        F.when(k % 5 == 0, "north").otherwise(F.col("lat").cast("string")).alias("latitude"), F.when(k % 3 == 0, "https://schema.org").when(k % 3 == 1, "http://schema.org").otherwise("https://example.org").alias("context"),
        F.when(k % 31 == 0, F.lit("not a url")).otherwise(F.col("url")).alias("link"), "location_name",
    )


CHECKS = validate.Checks(required=("name", "url"), numbers=("latitude",), allowed={"type": ("Event", "MusicEvent")}, patterns={"link": "^https?://"}, min_length={"name": 1})
_FAULTY = """(SELECT *, list_filter([CASE WHEN event_id % 23 = 0 THEN 'name is required' END, CASE WHEN event_id % 5 = 0 THEN 'latitude is not a number' END, CASE WHEN event_id % 7 = 0 THEN 'type is not allowed' END], lambda x: x IS NOT NULL) AS errors,
list_filter([CASE WHEN event_id % 31 = 0 THEN 'link does not match' END, CASE WHEN event_id % 29 = 0 AND event_id % 23 <> 0 THEN 'name is too short' END], lambda x: x IS NOT NULL) AS warnings FROM ev)"""
_PCT = "round(100 * valid / total, 1) AS valid_pct, round(100 * invalid / total, 1) AS invalid_pct, round(100 * warned / total, 1) AS warned_pct"


_NUMBER = validate.Shape(("number", "string"))
_PLACE = validate.Shape(("object",), properties={"name": validate.Shape(("string", "null")), "geo": validate.Shape(("object",), properties={"latitude": _NUMBER, "longitude": _NUMBER})})
SHAPED = replace(CHECKS, shapes={
    "image": validate.Shape(any_of=(validate.Shape(("string",)), validate.Shape(("array",), items=validate.Shape(("string",))))),
    "location": validate.Shape(any_of=(validate.Shape(("string",)), _PLACE)), "offers": validate.Shape(("object", "array")),
})


@query("v01_validate_records", f"""SELECT event_id, array_to_string(list_concat(errors, CASE WHEN event_id % 13 = 0 THEN ['offers is of a wrong type'] ELSE [] END), '|') AS errors,
array_to_string(list_concat(warnings, list_concat(CASE WHEN event_id % 17 IN (2, 3) THEN ['image fits no alternative'] ELSE [] END, CASE WHEN event_id % 19 IN (3, 4, 5) THEN ['location fits no alternative'] ELSE [] END)), '|') AS warnings FROM {_FAULTY}""")
def v01(spark, d):
    k = F.col("event_id")
    name = F.to_json(F.struct(F.col("location_name").alias("name")))
    inside = lambda x: F.concat(F.lit('{"geo":{"latitude":'), F.col("latitude") if x is None else F.lit(x), F.lit("}}"))
    image = F.when(k % 17 == 0, F.to_json(F.array("url", "link"))).when(k % 17 == 1, "[]").when(k % 17 == 2, "[1]").when(k % 17 == 3, '{"url":"x"}').otherwise(F.concat(F.lit('"'), F.col("url"), F.lit('"')))
    location = F.when(k % 19 == 0, name).when(k % 19 == 1, '{"name":null}').when(k % 19 == 2, inside('"12.9"')).when(k % 19 == 3, '{"name":5}').when(k % 19 == 4, inside("[1]")).when(k % 19 == 5, "[]").when(k % 19 == 6, inside("12.5")).when(k % 19 == 7, '"a hall"')
    offers = F.when(k % 13 == 0, '"free"').when(k % 13 == 1, "[]").when(k % 13 == 2, "{}")
    out = validate.validate_records(faulty(spark, d).withColumns({"image": image, "location": location, "offers": offers}), SHAPED)
    return out.select("event_id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


_TEXT = validate.Shape(("string",), min_length=1)
NESTED = validate.Checks(shapes={
    "location": validate.Shape(("object",), required=("name", "geo"), properties={
        "name": _TEXT, "geo": validate.Shape(("object",), required=("latitude",), properties={"latitude": _NUMBER, "kind": validate.Shape(("string",), enum=("point", "place"))}),
        "address": validate.Shape(properties={"postalCode": validate.Shape(("string",), pattern="^[0-9]{5}$"), "street": _TEXT, "floor": validate.Shape(("integer",))}),
    }),
    "offers": validate.Shape(("array",), items=validate.Shape(("object",), required=("price",), properties={
        "price": validate.Shape(("string",), pattern="^[0-9]+$"), "currency": validate.Shape(enum=("EUR", "INR", None)), "name": _TEXT,
        "seller": validate.Shape(any_of=(validate.Shape(("string",)), validate.Shape(("object",), required=("name",), properties={"name": validate.Shape(("string",))}))),
    })),
})


@query("v01_validate_nested", """SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 13 = 0 THEN 'location.geo is required' WHEN event_id % 7 = 0 THEN 'location.geo.latitude is required' WHEN event_id % 7 = 1 THEN 'location.geo.latitude is of a wrong type' END,
CASE WHEN event_id % 13 <> 0 AND event_id % 11 = 0 THEN 'location.geo.kind is not allowed' END, CASE WHEN event_id % 9 = 0 THEN 'location.address.floor is of a wrong type' END,
CASE WHEN event_id % 17 = 0 THEN 'offers is of a wrong type' END, CASE WHEN event_id % 17 = 1 THEN 'offers[0] is of a wrong type' END], lambda x: x IS NOT NULL) || CASE WHEN event_id % 17 > 1 THEN flatten([CASE (event_id + i) % 6 WHEN 0 THEN ['offers[' || i || '].price is required'] WHEN 1 THEN ['offers[' || i || '].currency is not allowed'] ELSE [] END FOR i IN range(event_id % 4)]) ELSE [] END, '|') AS errors,
array_to_string(list_filter([CASE WHEN event_id % 5 = 0 THEN 'location.address.postalCode does not match' END, CASE WHEN event_id % 3 = 0 THEN 'location.address.street is too short' END], lambda x: x IS NOT NULL) ||
CASE WHEN event_id % 17 > 1 THEN flatten([CASE (event_id + i) % 6 WHEN 2 THEN ['offers[' || i || '].price does not match'] WHEN 3 THEN ['offers[' || i || '].name is too short'] WHEN 4 THEN ['offers[' || i || '].seller fits no alternative'] ELSE [] END FOR i IN range(event_id % 4)]) ELSE [] END, '|') AS warnings FROM ev""")
def v01_nested(spark, d):
    k = F.col("event_id")
    geo = F.struct(F.when(k % 7 == 1, F.array(F.lit("1"))).alias("latitude"), F.when(k % 11 == 0, "area").when(k % 11 == 1, "place").otherwise("point").alias("kind"))
    geo = F.when(k % 7 == 1, F.to_json(geo)).when(k % 7 == 0, F.concat(F.lit('{"kind":"'), geo["kind"], F.lit('"}'))).otherwise(F.concat(F.lit('{"latitude":'), F.when(k % 2 == 0, "12.5").otherwise('"12.5"'), F.lit(',"kind":"'), geo["kind"], F.lit('"}')))
    address = F.concat(F.lit('{"postalCode":"'), F.when(k % 5 == 0, "x1").otherwise("56001"), F.lit('","street":"'), F.when(k % 3 == 0, "").otherwise("Main"), F.lit('","floor":'), F.when(k % 9 == 0, "1.5").when(k % 9 == 1, "2.0").otherwise("3"), F.lit("}"))
    location = F.concat(F.lit('{"name":"'), F.col("location_name"), F.lit('"'), F.when(k % 13 != 0, F.concat(F.lit(',"geo":'), geo)).otherwise(""), F.lit(',"address":'), address, F.lit("}"))
    offer = """CASE (event_id + i) % 6 WHEN 0 THEN '{"currency":null}' WHEN 1 THEN '{"price":"10","currency":"XYZ"}' WHEN 2 THEN '{"price":"on call"}' WHEN 3 THEN '{"price":"5","name":""}' WHEN 4 THEN '{"price":"5","seller":{"id":1}}' ELSE '{"price":"5","currency":"EUR","seller":{"name":"a"}}' END"""
    offers = F.when(k % 17 == 0, '{"price":"1"}').when(k % 17 == 1, "[5]").otherwise(F.expr(f"concat('[', array_join(transform(filter(array(0, 1, 2), i -> i < event_id % 4), i -> {offer}), ','), ']')"))
    out = validate.validate_records(ev(spark, d).select("event_id", location.alias("location"), offers.alias("offers")), NESTED)
    return out.select("event_id", F.array_join("errors", "|").alias("errors"), F.array_join("warnings", "|").alias("warnings"))


@query("v02_required_semantic", "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 'unknown context' WHEN event_id % 23 = 0 THEN 'name is missing' END AS semantic_error FROM ev")
def v02(spark, d):
    return validate.check_required_semantic(faulty(spark, d)).select("event_id", "semantic_error")


@query("v03_validation_stats", f"SELECT *, {_PCT} FROM (SELECT location_name, count(*) AS total, count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid, count(*) FILTER (len(warnings) > 0) AS warned FROM {_FAULTY} GROUP BY 1)")
def v03(spark, d):
    return validate.validation_stats(validate.validate_records(faulty(spark, d), CHECKS), ["location_name"])


@query("v04_validation_report", f"SELECT event_id, url, CAST(len(errors) AS INTEGER) AS n_errors, CAST(len(warnings) AS INTEGER) AS n_warnings FROM {_FAULTY} WHERE len(errors) + len(warnings) > 0")
def v04(spark, d):
    return validate.validation_report(validate.validate_records(faulty(spark, d), CHECKS)).select("event_id", "url", F.size("errors").alias("n_errors"), F.size("warnings").alias("n_warnings"))


@query("v05_isolate_bad_json", "SELECT event_id, event_id % 9 <> 0 AS good FROM events")
def v05(spark, d):
    raw = read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, F.substring("props", 1, F.length("props") - 1)).otherwise(F.col("props")).alias("raw"))
    good, bad = validate.split_bad_json(raw, "raw")
    return good.select("event_id", F.lit(True).alias("good")).union(bad.select("event_id", F.lit(False)))


@query("v06_count_by_source", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def v06(spark, d):
    return validate.count_by(read(spark, d, "documents"), "source")


@query("v07_count_modified", "SELECT count(*) FILTER (contains(url, '//www.')) AS n_modified, count(*) AS n FROM ev")
def v07(spark, d):
    before = ev(spark, d)
    after = normalize.apply_chain(before, [normalize.Step("name", lambda df: F.concat("name", F.lit("!")), "//www[.]")])
    return validate.count_modified(before, after, "event_id", ["name", "location_name"])


@query("v08_tag_counts", "SELECT tag, count(*) AS n FROM (SELECT unnest(keywords) AS tag FROM ev) GROUP BY 1")
def v08(spark, d):
    return validate.tag_counts(ev(spark, d))


@query("v09_drop_incomplete", "SELECT event_id FROM ev WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 AND end_ts IS NOT NULL")
def v09(spark, d):
    df = faulty(spark, d).join(ev(spark, d).select("event_id", "end_ts"), "event_id")
    return validate.drop_incomplete(df, ["name", "end_ts"]).select("event_id")
