"""Readers, writers, streams and the cases that queries do not reach."""

import html
import html.entities
import json
import random
import re
import time
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventlake.functions import matching, text, times
from eventlake.operators import extract, lookup, normalize, reshape, rules, validate
from eventlake.operators.rules import Rule
from eventlake.plans import source_queries  # noqa: F401
from eventlake.plans.registry import QUERIES, SQL
from eventlake.sources import readers, writers
from eventlake.streaming.curate import curate_stream


def one(spark, col, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(col.alias("x")).first()["x"]


def test_record_files(spark, tmp_path):
    (tmp_path / "alpha.json").write_text('[{"url": "u1", "keywords": ["a"]}, {"url": "u2", "keywords": "b, c"}, {"name": "no url"}]')
    (tmp_path / "beta.json").write_text('[{"url": "u3"}, {"url": "u4", "keywords": {"k": 1}}, {"url": "u5", "keywords": ["BETA"], "offers": [{"price": "1"}]}]')
    got = {r["url"]: (r["keywords_kind"], r["keywords"]) for r in readers.read_record_files(spark, str(tmp_path)).collect()}
    assert got == {"u1": ("list", ["a", "ALPHA"]), "u2": ("string", [", ALPHA, b, c"]), "u3": ("absent", ["BETA"]), "u4": ("object", []), "u5": ("list", ["BETA"])}


def test_url_lists_end_at_a_blank_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("u1\n u2 \n\nu3\n")
    (tmp_path / "b.txt").write_text("u4")
    assert sorted(r["url"] for r in readers.read_url_lists(spark, str(tmp_path)).collect()) == ["u1", "u2", "u4"]


def test_calendars(spark, tmp_path):
    (tmp_path / "empty.ics").write_text("")
    (tmp_path / "a.ics").write_text("BEGIN:VCALENDAR\nBEGIN:VEVENT\nUID:1\nSUMMARY:One\\, two\nDTSTART:20260102T030405Z\nATTACH;FMTTYPE=image/png:https://e.org/x.png\nEND:VEVENT\nBEGIN:VEVENT\nUID:2\nDTSTART;VALUE=DATE:20260103\nEND:VEVENT\nEND:VCALENDAR\n")
    got = {r["uid"]: r for r in readers.read_ics(spark, str(tmp_path)).collect()}
    assert set(got) == {"1", "2"} and got["1"]["name"] == "One, two" and got["1"]["attach"] == ["https://e.org/x.png"]
    assert str(got["1"]["begin"]) == "2026-01-02 03:04:05" and str(got["2"]["begin"]) == "2026-01-03 00:00:00" and got["2"]["categories"] == []


def test_feeds(spark, tmp_path):
    entry = "<entry><title>t{0}</title><link href='l{0}'/><content>c</content></entry>"
    (tmp_path / "a.xml").write_text("<feed xmlns='http://www.w3.org/2005/Atom'>" + "".join(entry.format(i) for i in range(7)) + "</feed>")
    assert [r["title"] for r in readers.read_feed(spark, str(tmp_path), 3).orderBy("nth").collect()] == ["t0", "t1", "t2"]


def test_ragged_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,name\n1,a\n2,b,extra\n3\n")
    got = readers.read_star_csv(spark, str(tmp_path), {"id": "int", "name": "string", "flag": "string"})
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, "b", None), (3, None, None)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("u", None), ("v", "n")], "url string, name string")
    writers.write_events(df, f"{tmp_path}/e")
    writers.write_events(df, f"{tmp_path}/e")
    assert sorted(r["event_json"] for r in spark.read.parquet(f"{tmp_path}/e").collect()) == ['{"url":"u"}'] * 2 + ['{"url":"v","name":"n"}'] * 2
    checked = validate.validate_records(df, validate.Checks(required=("name",)))
    writers.write_report(checked, f"{tmp_path}/r")
    assert spark.read.json(f"{tmp_path}/r").count() == 1


def test_time_ranges(spark):
    base = F.lit("2026-03-04").cast("timestamp")
    cases = {"3 - 6 PM": ("15:00", "18:00"), "10 AM to 1 PM": ("10:00", "13:00"), "9:30 -11:30 AM": ("09:30", "11:30"), "12 PM - 1:15 pm": ("12:00", "13:15"), "11 - 12": None, "": None, "7 PM to 9": ("19:00", "21:00")}
    for raw, want in cases.items():
        got = one(spark, times.parse_time_range(F.lit(raw), base))
        assert (got and (got["start"].strftime("%H:%M"), got["end"].strftime("%H:%M"))) == want, raw


def test_to_zone_is_idempotent(spark):
    for raw in ("2026-01-02T03:04:05Z", "2026-01-02T03:04:05", "2026-01-02", "2026-01-02 03:04", "junk", "2026-13-45T00:00:00Z"):
        once = one(spark, times.to_zone(F.col("x")), x=raw)
        assert one(spark, times.to_zone(F.col("x")), x=once) == once
    assert one(spark, times.to_zone(F.lit("2026-01-02T23:00:00Z"))) == "2026-01-03T04:30:00+05:30"
    assert one(spark, times.to_zone(F.lit("junk"))) == "junk"


def test_text_functions(spark):
    assert one(spark, text.like_ci(F.lit("CAFÉ Noir"), "%noir")) is True and one(spark, text.like_ci(F.lit("É"), "é")) is False
    assert one(spark, text.html_unescape(F.lit("a &amp;lt; b &lt;"))) == "a &lt; b <"
    assert one(spark, text.numeric_entity(F.lit("128512"))) == "😀" and one(spark, text.numeric_entity(F.lit("x"))) is None
    assert one(spark, text.dedupe_csv(F.lit("b, a,b,,a"))) == "b, a"
    assert tuple(one(spark, text.split_location(F.lit("Hall – Annex, 1 Road, Town"), "Town"))) == ("Hall", "Annex, 1 Road")
    assert one(spark, text.url_domain(F.lit("https://user@www.a.org:80/x"))) == "a.org:80"
    assert one(spark, text.price_int(F.lit("₹ 1,234.20"))) == "1235" and one(spark, text.price_int(F.lit("free"))) is None
    assert one(spark, text.json_text(F.lit('{"a": "true", "b": true}'), "$.a")) == "true" and one(spark, text.json_text(F.lit('{"a": "true", "b": true}'), "$.b")) == "1"


def test_rules_are_checked():
    with pytest.raises(ValueError, match="declares"):
        rules.check_rules([Rule(1, "tag", "true", "A"), Rule(2, "tag", "m_1", "B")])
    with pytest.raises(ValueError, match="earlier"):
        rules.check_rules([Rule(1, "tag", "m_2", "A", needs=(2,)), Rule(2, "tag", "true", "B")])
    with pytest.raises(ValueError, match="declaring"):
        rules.check_rules([Rule(1, "tag", "true", "Abc"), Rule(2, "tag", "array_contains(keywords, 'abc')", "B")])
    with pytest.raises(ValueError):
        rules.check_rules([Rule(1, "jump", "true")])


def test_rules_keep_order_and_nulls(spark):
    df = spark.createDataFrame([(1, ["x"], "Event"), (2, None, None), (3, [], "Event")], "id int, keywords array<string>, type string")
    table = [Rule(1, "tag", "id >= 1", "A"), Rule(2, "type", "m_1", "B", needs=(1,)), Rule(3, "tag", "id = 1", "A"), Rule(4, "delete", "id > 2 AND null")]
    assert sorted(map(tuple, rules.apply_rules(df, table).collect())) == [(1, ["x", "A", "A"], "B"), (2, None, None), (3, ["A"], "B")]


def test_defaults_are_idempotent(spark):
    df = spark.createDataFrame([("https://www.a.org/1", None, ["k"]), ("https://b.org/2", "own", None), ("https://c.org", None, None)], "url string, place string, keywords array<string>")
    patches = spark.createDataFrame([("a.org", "P", ["z", "b"]), ("b.org", "Q", None)], "domain string, place string, keywords array<string>")
    once = normalize.apply_defaults(df, patches, ["place"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, normalize.apply_defaults(once, patches, ["place"]).collect())) == [("https://b.org/2", "own", None), ("https://c.org", None, None), ("https://www.a.org/1", "P", ["b", "k", "z"])]


def test_jsonld_edge_cases(spark):
    html = '<script type="application/ld+json">{"@type":"Event","name":"a\nb"}</script><script type="application/ld+json">[null, {}, {"@type":"X"}]</script><script type="application/ld+json">{"broken</script>'
    got = extract.extract_jsonld(spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string"), "html", ["id"])
    assert sorted((r["id"], r["item"]) for r in got.collect()) == [(1, '{"@type":"Event","name":"a b"}'), (1, '{"@type":"X"}')]


@pytest.mark.parametrize("constant", [20_000, 0])
def test_gazetteer_of_any_size(spark, monkeypatch, constant):
    monkeypatch.setattr(lookup, "CONSTANT_LITERALS", constant)
    places = spark.createDataFrame([(2, "a", "A", 1.5), (1, "b+", "B", None), (2, "(?i)C", "C", 2.5), (3, None, "N", 0.0)], "priority int, pattern string, place string, lat double")
    texts = spark.createDataFrame([(1, "xxabby", "k"), (2, "a c", "k"), (3, "C", "k"), (4, None, "k"), (5, "", None)], "id int, t string, priority string")
    got = lookup.gazetteer_match(texts, "id", "t", places)
    assert sorted(tuple(r) for r in got.select("id", "place", "lat").collect()) == [(1, "B", None), (2, "C", 2.5), (3, "C", 2.5), (4, None, None), (5, None, None)]
    assert got.columns == ["id", "t", "priority", "place", "lat"]
    assert lookup.gazetteer_match(texts, "id", "t", places.limit(0)).filter("place is null").count() == 5


@pytest.mark.parametrize(("n", "constant"), [(10, 20_000), (300, 20_000), (5_000, 20_000), (300, 0), (5_000, 0)])
def test_gazetteers_of_literals_words_and_patterns(spark, monkeypatch, n, constant):
    monkeypatch.setattr(lookup, "CONSTANT_LITERALS", constant)
    r = random.Random(n)
    words = ["".join(r.choices("abcd", k=r.randint(2, 5))) for _ in range(60)] + ["é", "a.b", "New York", "new", "york city", "c+"]
    q = lambda w: re.escape(w).replace("\\ ", " ")
    make = [q, lambda w: f"(?i){q(w.upper())}", lambda w: rf"\b{q(w)}\b", lambda w: rf"(?i)\b{q(w)}", lambda w: f"{q(w)}|{q(w[::-1])}", lambda w: rf"{q(w)}\b"]
    patterns = [r.choice(make)(f"{r.choice(words)} {r.choice(words)}"[: r.randint(3, 12)].strip()) for _ in range(n - 4)] + ["[ab]{4}x", "^zz", r"d\d", "a|"[:1] + "q"]
    texts = [" ".join(r.choices(words + ["NEW YORK", "zz", "d1", "x_y"], k=r.randint(0, 12))) for _ in range(60)] + [None, "", "zz top", "aaaaaaaax"]
    rows = [(None if i % 9 == 0 else i % 5, t) for i, t in enumerate(texts)]  # null and repeated keys
    places = spark.createDataFrame([(i // 3, p, f"place {i}") for i, p in enumerate(patterns)], "priority int, pattern string, place string")
    got = lookup.gazetteer_match(spark.createDataFrame(rows, "key int, t string"), "key", "t", places)

    def best(t):  # as the engine of the patterns, words and case are those of ASCII
        hits = [(i // 3, p, f"place {i}") for i, p in enumerate(patterns) if t is not None and re.search(p, t, re.ASCII)]
        return min(hits)[2] if hits else None

    assert sorted(map(str, got.collect())) == sorted(str(Row(key=k, t=t, place=best(t))) for k, t in rows)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_literals_in_one_scan(spark):
    literals = ["a", "ab", "abc", "b.c", "é", "xyz"]
    for t in ("xxabcx", "ab.c", "", "éa", "xy", "a\nab"):
        assert sorted(one(spark, matching.all_found(F.col("t"), literals), t=t)) == sorted(x for x in literals if x in t)


def test_jsonld_positions_do_not_clash(spark):
    many = ",".join('{"@type":"Place","name":"p"}' for _ in range(1_001))
    html = f'<script type="application/ld+json">[{many}]</script><script type="application/ld+json">{{"@type":"Event","name":"first"}}</script><script type="application/ld+json">{{"@type":"Event","name":"second"}}</script>'
    items = extract.extract_jsonld(spark.createDataFrame([(1, html)], "id int, html string"), "html", ["id"])
    assert items.select("pos").distinct().count() == items.count() == 1_003
    assert [json.loads(r["event"])["name"] for r in extract.pick_event(items, "id", ["Event"]).collect()] == ["first"]


def test_grouped_items_in_order_despite_ties(spark):
    df = spark.createDataFrame([(1, 2, 9), (1, 2, 3), (1, 2, 3), (1, 1, 50)], "k int, line int, q int")
    got = reshape.group_collect(df, ["k"], F.struct("line", "q")).first()["items"]
    assert [tuple(x) for x in got] == [(1, 50), (2, 3), (2, 3), (2, 9)]


def test_slots_without_a_day_and_records_without_slots(spark):
    slot = "array<struct<day: date, active: boolean>>"
    rows = [(1, "a", "2026-01-05", [("2026-01-02", True), ("2026-01-09", False), ("2025-12-31", True), (None, True)]), (2, "b", "2026-01-06", []), (3, "c", "2025-01-01", None), (4, "d", None, None), (5, "a test", "2026-01-06", None), (6, "e", "2026-02-02", [("2026-01-09", False)])]
    df = spark.createDataFrame([(i, t, d, None if s is None else [{"day": x, "active": y} for x, y in s]) for i, t, d, s in rows], "id int, title string, date string, slots array<struct<day: string, active: boolean>>")
    df = df.withColumn("slots", F.col("slots").cast(slot)).withColumn("date", F.to_date("date"))
    got = reshape.explode_slots(df, "slots", lambda s: s["active"], "title", lambda s: s["day"], F.col("date"), F.lit("2026-01-01").cast("date"))
    assert sorted((r["id"], str(r["slot_day"]), r["slot"] is None) for r in got.collect()) == [(1, "2026-01-02", False), (2, "2026-01-06", True)]
    assert got.columns == ["id", "title", "date", "slot", "slot_day"]


def test_shapes(spark):
    place = validate.Shape(any_of=(validate.Shape(("string",)), validate.Shape(("object",), properties={"name": validate.Shape(("string", "null"))})))
    for raw, want in {'"x"': True, "5": False, "{}": True, '{"name": null}': True, '{"name": 3}': False, "[]": False, "null": False}.items():
        assert one(spark, validate.fits(F.try_parse_json(F.col("x")), place), x=raw) is want, raw
    rows = spark.createDataFrame([(1, '["a"]'), (2, '["a", 1]'), (3, None), (4, "{broken")], "id int, image string")
    out = validate.validate_records(rows, validate.Checks(shapes={"image": validate.Shape(("array",), items=validate.Shape(("string",)))}))
    assert {r["id"]: r["errors"] for r in out.collect()} == {1: [], 2: ["image[1] is of a wrong type"], 3: [], 4: []}


def told(value, shape, path):
    """faults() row by row."""
    kind = {str: "string", bool: "boolean", dict: "object", list: "array", type(None): "null"}.get(type(value), "number")
    out = []
    if shape.types and kind not in shape.types and not ("integer" in shape.types and kind == "number" and value == int(value)):
        out.append((path, "type"))
    if shape.enum and not any(x == value and type(x) is type(value) for x in shape.enum):
        out.append((path, "enum"))
    if shape.pattern and kind == "string" and not re.search(shape.pattern, value):
        out.append((path, "pattern"))
    if shape.min_length and kind == "string" and len(value) < shape.min_length:
        out.append((path, "minLength"))
    if kind == "object":
        out += [(f"{path}.{x}", "required") for x in shape.required if x not in value]
        for x, own in shape.properties.items():
            out += told(value[x], own, f"{path}.{x}") if x in value else []
    if shape.items and kind == "array":
        for i, x in enumerate(value):
            out += told(x, shape.items, f"{path}[{i}]")
    if shape.any_of and all(told(value, own, path) for own in shape.any_of):
        out.append((path, "anyOf"))
    return out


def test_faults_at_every_depth(spark):
    r, S = random.Random(7), validate.Shape
    leaf = [S(("string",), pattern="^a", min_length=2), S(("integer", "null")), S(enum=("a", 1, None, True)), S(("number", "string"))]
    shape = S(("object",), required=("a", "b"), properties={
        "a": S(("array",), items=S(("object", "string"), required=("c",), properties={"c": leaf[0], "d": leaf[1], "e": S(("array",), items=leaf[2])}, min_length=3)),
        "b": S(any_of=(leaf[0], S(("object",), required=("x",), properties={"x": leaf[3]}), S(("array",), items=leaf[1]))),
    })

    def value(depth):
        k = r.random()
        if depth and k < 0.45:
            return {x: value(depth - 1) for x in r.sample("abcdex", r.randint(0, 5))}
        if depth and k < 0.7:
            return [value(depth - 1) for _ in range(r.randint(0, 3))]
        return r.choice(["a", "ab", "b", "", 1, 2.5, True, None, "é"])

    values = [value(4) for _ in range(300)] + [{"a": [{"c": "xb", "e": [1, 2]}, "ab"], "b": {"x": []}}, {}]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(values)], "i int, raw string")
    got = {x["i"]: [tuple(f) for f in x["f"]] for x in df.select("i", validate.faults(F.try_parse_json("raw"), shape, F.lit("$")).alias("f")).collect()}
    assert got == {i: told(x, shape, "$") for i, x in enumerate(values)}
    assert {k for x in got.values() for p, k in x if p.count(".") + p.count("[") >= 2} >= {"required", "type", "enum", "pattern", "minLength"}


def test_typed_values(spark):
    deep = {"stringValue": "end"}
    for _ in range(6):
        deep = {"arrayValue": {"values": [deep]}}
    raw = json.dumps({"fields": {"a": {"mapValue": {}}, "b": {"arrayValue": {}}, "c": {"doubleValue": 1.5}, "d": deep, "e": {"nullValue": None}}})
    want = {"a": "{}", "b": "[]", "c": '{"doubleValue":1.5}', "e": None, "f": None}
    for name, value in want.items():
        assert one(spark, extract.unwrap_typed_values(F.col("x"), name), x=raw) == value, name
    assert one(spark, extract.unwrap_typed_values(F.col("x"), "d"), x=raw) == '[[[[[["end"]]]]]]'


def test_random_typed_values(spark):
    r = random.Random(9)

    def make(depth):
        """A typed value and its plain one."""
        k = r.random() if depth else 1
        keys = r.sample(["a", "fields", "values", "mapValue", "stringValue", "x{[", 'q"', "\\", "\ufdd1"], r.randint(0, 3))
        if k < 0.4:
            inner = {x: make(depth - 1) for x in keys}
            return {"mapValue": {"fields": {x: t for x, (t, _) in inner.items()}} if inner or r.random() < 0.5 else {}}, {x: p for x, (_, p) in inner.items()}
        if k < 0.8:
            inner = [make(depth - 1) for _ in range(r.randint(0, 3))]
            return {"arrayValue": {"values": [t for t, _ in inner]} if inner or r.random() < 0.5 else {}}, [p for _, p in inner]
        if k < 0.85:
            return {"geoPointValue": {"latitude": 1.5, "of": [1, {"b": 2}]}}, {"geoPointValue": {"latitude": 1.5, "of": [1, {"b": 2}]}}
        kind, x = r.choice([("stringValue", r.choice(["", 'a"b', "]}}", '{"mapValue":{}}', "é\\", "\ufdd4\ufdd0"])), ("integerValue", "12"), ("booleanValue", True), ("nullValue", None), ("timestampValue", "2026-01-01T00:00:00Z")])
        return {kind: x}, x

    cases = [make(r.randint(1, 14)) for _ in range(150)]
    df = spark.createDataFrame([(i, json.dumps({"fields": {"v": t}}, ensure_ascii=i % 2 == 0)) for i, (t, _) in enumerate(cases)], "i int, raw string")
    got = {x["i"]: x["v"] for x in df.select("i", extract.unwrap_typed_values(F.col("raw"), "v").alias("v")).collect()}
    for i, (t, plain) in enumerate(cases):
        if isinstance(plain, (dict, list)):
            assert json.loads(got[i]) == plain, t
        else:
            assert got[i] == {True: "true", None: None}.get(plain, plain), t


def test_links_resolve_as_the_standard_says(spark):
    parts = ["a", "b.html", ".", "..", "", "...", ".c", "d..", "e;f"]
    r, cases = random.Random(3), []
    for _ in range(600):
        base = r.choice(["https://h.org", "http://h.org:80/", "https://h.org/a/b/c.html?x=/../y", "https://h.org/a/", "https://u@h.org/a?b"])
        href = r.choice(["", "/", "//o.org/", "?q=", "http://o.org/", "https://o.org"]) + "/".join(r.choices(parts, k=r.randint(1, 5))) + r.choice(["", "?q=/../a"])
        cases.append((base, href))
    cases += [("https://h.org/a", "mailto:x@y"), ("https://h.org/a", "?"), ("https://h.org", "x")]
    df = spark.createDataFrame(cases, "base string, href string")
    tidy = lambda x: re.sub("/+$", "", x.removesuffix("?"))
    for row in df.select("base", "href", text.resolve_url(F.col("base"), F.col("href")).alias("url")).collect():
        if "//" not in row["href"].removeprefix("//").removeprefix("http://").removeprefix("https://") and not row["href"].startswith("///"):  # empty segments are kept by us
            whole = re.match("(https?:)?(//[^/?#]*)(.*)", row["href"])  # the library leaves dots in links with a host
            assert tidy(row["url"]) == tidy(urljoin(*(((whole[1] or row["base"].split("/")[0]) + whole[2], whole[3]) if whole else (row["base"], row["href"])))), row
    assert df.limit(1).select(text.resolve_url(F.lit(None).cast("string"), F.lit("a/b"))).first()[0] == "a/b"


def test_references_unescape_as_in_browsers(spark):
    r = random.Random(4)
    names = list(html.entities.html5)
    bits = ["&", ";", "#", "x", "amp", "lt;", "copy", "notit;", " ", "1", "é", "&#", "&#x", "&amp;"]
    cases = [f"&{x}" for x in names] + [f"&{x}z" for x in names if not x.endswith(";")] + [f"&#{n};" for n in [*range(0, 260), 8217, 0xD800, 0xFFFE, 0xFDD0, 0x1FFFF, 0x10FFFF, 0x110000, 10**30]] + [f"&#x{n:X}" for n in range(0, 70_000, 371)]
    cases += ["".join(r.choices(bits, k=r.randint(1, 9))) for _ in range(2000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, x string")
    wrong = [(cases[x["i"]], x["y"]) for x in df.select("i", text.html_unescape(F.col("x")).alias("y")).collect() if x["y"] != html.unescape(cases[x["i"]])]
    assert not wrong


def test_json_in_ascii(spark):
    for x in ("plain", "é€😀\t", ""):
        assert one(spark, text.ascii_json(F.to_json(F.struct("x"))), x=x) == json.dumps({"x": x}, separators=(",", ":"))


def test_calendar_zones(spark):
    lines = {
        "z": "DTSTART:20260701T100000Z", "ny": "DTSTART;TZID=America/New_York:20260701T100000", "winter": "DTSTART;TZID=America/New_York:20260101T100000", "float": "DTSTART:20260701T100000",
        "lost": "DTSTART;TZID=Custom:20260701T100000", "day": "DTSTART;VALUE=DATE:20260701", "bad": "DTSTART:tomorrow", "end": "DTSTART:20260701T100000Z\nDTEND;TZID=Asia/Kolkata:20260701T100000", "weeks": "DTSTART:20260701T100000Z\nDURATION:P1WT1H", "none": "SUMMARY:x",
    }
    df = spark.createDataFrame([("BEGIN:VCALENDAR\n" + "".join(f"BEGIN:VEVENT\nUID:{k}\n{v}\nEND:VEVENT\n" for k, v in lines.items()),)], "t string")
    got = {r["uid"]: (str(r["begin"]), str(r["end"]), r["all_day"]) for r in readers.parse_ics(df, "t", (), "Asia/Kolkata", "UTC").select("uid", F.col("begin").cast("string"), F.col("end").cast("string"), "all_day").collect()}
    assert got == {
        "z": ("2026-07-01 10:00:00", "None", False), "ny": ("2026-07-01 14:00:00", "None", False), "winter": ("2026-01-01 15:00:00", "None", False), "float": ("2026-07-01 04:30:00", "None", False), "lost": ("2026-07-01 10:00:00", "None", False),
        "day": ("2026-07-01 00:00:00", "None", True), "bad": ("None", "None", False), "end": ("2026-07-01 10:00:00", "2026-07-01 04:30:00", False), "weeks": ("2026-07-01 10:00:00", "2026-07-08 11:00:00", False), "none": ("None", "None", None),
    }


def test_failing_steps_leave_their_rows(spark):
    df = spark.createDataFrame([("u1", "5", 1), ("u2", "x", 2), ("v", "y", 3), (None, "z", 4)], "url string, raw string, n int")
    steps = [normalize.Step("n", lambda d: normalize.attempt_cast(F.col("raw"), "int"), "^u"), normalize.Step("n", lambda d: (F.lit(100) / F.col("n")).cast("int"), name="later")]
    got = normalize.apply_chain(df, steps, errors="errors")
    assert sorted(map(tuple, got.select("raw", "n", "errors", "modified").collect())) == [("5", 20, [], True), ("x", 50, ["n: not a int: x"], True), ("y", 33, [], True), ("z", 4, [], False)]
    assert [tuple(x) for x in normalize.count_errors(got).collect()] == [("n", 1)]
    assert normalize.apply_chain(df, steps).columns == [*df.columns, "modified"]


def test_rules_over_the_record(spark):
    rows = [("a", ["k"], "Event"), ("b", None, "Event"), ("c", ["k"], None), ("dé", [], "Event")]
    df = spark.createDataFrame(rows, "name string, keywords array<string>, type string")
    table = [
        Rule(1, "tag", "name <> 'b'", "ONE"), Rule(2, "tag", "record LIKE '%ONE%'", "TWO"), Rule(3, "set", "record LIKE '%u00e9%'", fields={"name": "'e'"}), Rule(4, "type", "record LIKE '%TWO%'", "T"),
        Rule(5, "delete", "record LIKE '%\"name\":\"c\"%'"), Rule(6, "tag", "m_4 AND name = 'dé'", "BASE", needs=(4,)), Rule(7, "tag", "TRUE", "ANY", any_of={"name": ["A", "a", "x"]}, equals={"type": ["event"]}),
    ]
    got = {r["name"]: (r["keywords"], r["type"]) for r in rules.apply_rules(df, table).collect()}
    assert got == {"a": (["k", "ONE", "TWO", "ANY"], "T"), "b": (None, "Event"), "e": (["ONE", "TWO", "BASE"], "T")}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "event_id bigint, url string, keywords array<string>, type string, name string")
    assert rules.apply_rules(none, [Rule(1, "tag", "name = 'x'", "A")]).count() == 0
    stats = validate.validation_stats(validate.validate_records(none, validate.Checks(required=("name",)))).first()
    assert stats["total"] == 0 and stats["valid_pct"] is None


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i % 3}", ["k"], "Event") for i in range(6)], "id int, url string, keywords array<string>, type string")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    curate_stream(stream, [Rule(1, "delete", "id = 0"), Rule(2, "tag", "url = 'u1'", "ONE")], f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    got = sorted((r["id"], r["keywords"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(i, ["k", "ONE"] if i % 3 == 1 else ["k"]) for i in range(1, 6)]


def test_rich_text_query_keeps_whole_texts(spark, tmp_path):
    from eventlake.plans.source_queries import x10

    long = "word " * 30 + "end"
    spark.createDataFrame([(1, 0, "user", long), (1, 1, "bot", "short")], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert x10(spark, str(tmp_path)).collect()[0]["flat"] == f"user {long} bot short"


def test_calendar_of_over_a_million_events(spark):
    df = spark.range(1).select(F.concat(F.lit("BEGIN:VCALENDAR\n"), F.repeat(F.lit("BEGIN:VEVENT\nUID:a\nEND:VEVENT\n"), 1_000_001)).alias("text"))
    df = df.union(spark.createDataFrame([(None,), ("",)], "text string"))
    assert readers.parse_ics(df, "text").filter("uid = 'a'").count() == 1_000_001


def test_pages_with_unfinished_references_unescape_as_in_sql(spark, tmp_path):
    pages = ["cut&amp</title>", "a &quot</h1>", "x=1&copy=2&lt", "&amp;lt; &amp;amp; &&amp;; &lt;p&gt; &quot;&copy;&middot;", "&eacute; &nbsp; &#39; &#x27; &AMP; &LT;", "&", "&;", "", "none", None]
    spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["x06_html_unescape"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, got.select("page_id", "digest", "letter").collect())) == sorted(con.execute(SQL["x06_html_unescape"]).fetchall())
    assert one(spark, text.html_unescape(F.lit("cut&amp</title> &lt;&eacute;&#39;"), {"lt": "<"})) == "cut&amp</title> <&eacute;&#39;"


def test_typed_values_in_few_scans(spark):
    typed, plain = {"stringValue": "}} ]}}"}, "}} ]}}"
    for i in range(90):
        typed, plain = ({"arrayValue": {"values": [typed, {"doubleValue": 1.5}]}}, [plain, {"doubleValue": 1.5}]) if i % 2 else ({"mapValue": {"fields": {"[k}": typed, "spot": {"geoPointValue": {"latitude": 1.5}}}}}, {"[k}": plain, "spot": {"geoPointValue": {"latitude": 1.5}}})
    df = spark.range(1500).select(F.concat(F.lit('{"fields":{"v":'), F.replace(F.lit(json.dumps(typed)), F.lit(" ]"), F.concat(F.lit(" "), F.col("id").cast("string"), F.lit("]"))), F.lit("}}")).alias("raw"))
    df.limit(1).select(extract.unwrap_typed_values(F.col("raw"), "v")).collect()
    start = time.monotonic()
    got = df.select(extract.unwrap_typed_values(F.col("raw"), "v").alias("v")).collect()
    assert time.monotonic() - start < 25
    assert [json.loads(x["v"]) for x in got] == [json.loads(json.dumps(plain).replace(" ]", f" {i}]")) for i in range(1500)]


def test_typed_values_keep_what_is_of_no_kind(spark):
    long = 'a"b' * 20_000
    beside = {"arrayValue": {"values": [{"integerValue": "1"}], "x": {"mapValue": {"fields": {"y": {"stringValue": long}}}}}}
    cases = {"a": {"mapValue": {"fields": {"b": beside, "c": {"arrayValue": {"values": [{"integerValue": "2"}]}}}}}, "d": {"mapValue": {"fields": {}}, "stringValue": "x"}, "e": {"arrayValue": {"values": [{"stringValue": long}]}}}
    want = {"a": {"b": {"arrayValue": {"values": ["1"], "x": {"y": long}}}, "c": ["2"]}, "e": [long]}
    for name, value in want.items():
        assert json.loads(one(spark, extract.unwrap_typed_values(F.col("x"), name), x=json.dumps({"fields": cases}))) == value, name
    assert one(spark, extract.unwrap_typed_values(F.col("x"), "d"), x=json.dumps({"fields": cases})) == "x"


def test_faults_of_deep_shapes_read_each_place_once(spark):
    S = validate.Shape
    shape, value, want = S(("integer",), enum=(1,)), 2.5, [("", "type"), ("", "enum")]
    for i in range(16):
        shape, value = S(("object", "array"), required=("a", "b"), properties={"a": shape, "A": S(("string",), pattern="x")}, min_length=1), {"a": value, "A": "y" if i == 15 else "x", "b": None}
        want = ([(".A", "pattern")] if i == 15 else []) + want
        want = [(f".a{p}" if (p, k) != (".A", "pattern") else p, k) for p, k in want]
    want = sorted(want)
    df = spark.range(50).select(F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit(json.dumps(value)), 300), ","), F.lit("]")).alias("raw"))
    start = time.monotonic()
    got = df.select(validate.faults(F.try_parse_json("raw"), S(("array",), items=shape), F.lit("$")).alias("f")).collect()
    assert time.monotonic() - start < 20
    assert all(sorted((x["path"][1:], x["kind"]) for x in row["f"]) == sorted((f"[{i}]{p}", k) for i in range(300) for p, k in want) for row in got) and len(got) == 50


def test_records_are_read_in_turns_with_the_same_faults(spark):
    S = validate.Shape
    shapes = {"a": S(("object",), required=("x", "X"), properties={"x": S(("object", "null"), required=("y`z",)), "X": S(items=S(("integer",))), "w": S(any_of=(S(("string",)), S(properties={"v": S(("array",))})))}), "b": S(), "c": S(enum=(1, "1"))}
    values = [None, "{", "null", "5", '"1"', "1", "[]", "{}", '{"x": 1, "X": [1, 1.5, 2.0, "a"]}', '{"x": null, "X": {}, "w": 1}', '{"x": {"y`z": 0}, "X": [], "w": {"v": {}}}', '{"X": 1, "w": {"v": []}}']
    df = spark.createDataFrame([(x, y, z) for x in values for y, z in zip(values, reversed(values), strict=True)], "a string, b string, c string")
    parsed = {c: F.try_parse_json(c) for c in shapes}
    want = F.concat(*[validate.faults(parsed[c], s, F.lit(c)) for c, s in shapes.items()])
    got = validate.with_faults(df.withColumn("want", want), parsed, shapes, "found")
    assert got.columns == ["a", "b", "c", "want", "found"]
    rows = got.collect()
    assert all(x["want"] == x["found"] for x in rows) and len(rows) == len(values) ** 2
    told_of = lambda raw: {(f["path"], f["kind"]) for x in rows if x["a"] == raw for f in x["found"] if f["path"][0] == "a"}
    assert told_of(values[8]) == {("a.x", "type"), ("a.X[1]", "type"), ("a.X[3]", "type")}
    assert told_of(values[9]) == set() and told_of(values[10]) == {("a.w", "anyOf")} and told_of(values[11]) == {("a.x", "required")}
    assert told_of("{}") == {("a.x", "required"), ("a.X", "required")} and told_of("5") == {("a", "type")} and not told_of(None) and not told_of("{")
