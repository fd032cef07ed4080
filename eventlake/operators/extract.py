"""Records out of pages and embedded payloads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_group, resolve_url, url_path, url_slug

_JSONLD = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"


def extract_jsonld(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """keep, pos, item: every JSON-LD item of every page; arrays give many. Broken blocks and falsy items go.

    Control characters within strings are read as blanks. pos counts the items of all good blocks of a page.
    """

    def items(block: Column) -> Column:
        raw = F.trim(F.regexp_replace(block, r"[\x00-\x1F]+", " "))
        listed = F.when(raw.startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw))
        return F.when(F.try_parse_json(raw).isNotNull(), listed).otherwise(F.array().cast("array<string>"))

    blocks = F.regexp_extract_all(F.col(html), F.lit(_JSONLD), F.lit(1))
    rows = pages.select(*keep, F.posexplode(F.flatten(F.transform(blocks, items))).alias("pos", "item"))
    return rows.filter(F.try_parse_json("item").isNotNull() & ~F.trim("item").isin("{}", "null", "[]", "false", "0", '""'))


def pick_event(items: DataFrame, key: str, types: Sequence[str]) -> DataFrame:
    """One event per page: the first @graph member of a known type, else the first top-level item of one; else no row."""
    member = F.from_json(F.get_json_object("item", "$.@graph"), "array<string>")
    inner = items.select(key, "pos", F.posexplode(member).alias("at", "event")).withColumn("rank", F.lit(0))
    outer = items.select(key, "pos", F.lit(0).alias("at"), F.col("item").alias("event"), F.lit(1).alias("rank"))
    every = inner.unionByName(outer).filter(F.get_json_object("event", "$.@type").isin(list(types)))
    first = F.row_number().over(Window.partitionBy(key).orderBy("rank", "pos", "at"))
    return every.withColumn("nth", first).filter("nth = 1").select(key, "event")


def extract_meta(html: Column, name: str) -> Column:
    """Content of <meta name=...>."""
    return first_group(html, rf"(?is)<meta[^>]*name\s*=\s*[\"']{name}[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']")


def extract_links(pages: DataFrame, html: str, base: str, include: str | None = None, exclude: str | None = None, n_segments: int | None = None, strip_query: bool = True) -> DataFrame:
    """url: distinct links of all pages, resolved against the page's URL in base; fragments go."""
    href = pages.select(F.col(base).alias("base"), F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?i)href\s*=\s*[\"']([^\"'#]+)"), F.lit(1))).alias("href"))
    url = resolve_url(F.col("base"), F.trim("href"))
    url = F.regexp_replace(url, r"\?.*$", "") if strip_query else url
    out = href.select(F.regexp_replace(url, "/+$", "").alias("url"))
    if include:
        out = out.filter(F.col("url").rlike(include))
    if exclude:
        out = out.filter(~F.col("url").rlike(exclude))
    if n_segments is not None:
        out = out.filter(F.size(F.filter(F.split(url_path(F.col("url")), "/"), lambda x: x != "")) == n_segments)
    return out.distinct()


def extract_script_json(pages: DataFrame, html: str, script_id: str, path: str, keep: Sequence[str]) -> DataFrame:
    """keep, pos, item: records of the list at path in the JSON of <script id=...>; missing ones give no rows."""
    raw = first_group(F.col(html), rf"(?is)<script[^>]*id\s*=\s*[\"']{script_id}[\"'][^>]*>(.*?)</script>")
    return pages.select(*keep, F.posexplode(F.from_json(F.get_json_object(raw, path), "array<string>")).alias("pos", "item"))


def extract_fields(html: Column, spec: Mapping[str, Sequence[str]]) -> list[Column]:
    """One column per field of spec: the first of its patterns that captures something."""
    return [F.coalesce(*[first_group(html, p) for p in patterns]).alias(name) for name, patterns in spec.items()]


def canonical_slug(html: Column, url: Column) -> Column:
    """Slug of the page's canonical link, else of its URL."""
    link = first_group(html, r"(?is)<link[^>]*rel\s*=\s*[\"']canonical[\"'][^>]*href\s*=\s*[\"']([^\"']+)[\"']")
    return F.coalesce(url_slug(link), url_slug(url))


def repair_json(raw: Column, broken_end: str, suffix: str) -> Column:
    """A truncated JSON text with its known missing tail; null if it still doesn't parse."""
    fixed = F.when(raw.endswith(broken_end), F.concat(raw, F.lit(suffix))).otherwise(raw)
    return F.when(F.try_parse_json(fixed).isNotNull(), fixed)


#: Stand-ins of brackets that are done with ([, ], {, }) and of those inside strings, and a mark: control characters, which
#: stand in JSON text as escapes only.
_DONE, _INSIDE, _MARK = "\x01\x02\x03\x04", "\x05\x06\x07\x08", "\x0e"
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SCALAR = rf'\{{"(?:stringValue|timestampValue|integerValue|booleanValue|nullValue)":({_STRING}|[^\[\]{{}},"]+)\}}'
#: What opens a typed list or map that is not empty.
_OPENS = r'\{"(?:arrayValue":\{"values":(\[)|mapValue":\{"fields":(\{))'
#: An object of another kind, with objects but no scalars of known kinds in it. A brace before a quote is inside a string
#: only if what follows the quote can follow a string.
_OTHER = rf'\{{(?="[^,:\]}}])(?:[^"\[\]{{}}]++|{_STRING}|\{{(?!"(?:string|timestamp|integer|boolean|null)Value":)(?:[^"\[\]{{}}]++|{_STRING})*+\}})*+\}}'
#: Text without stand-ins and marks, and without two closing braces in a row inside a string.
_SAFE = rf'^(?:[^"{_DONE}{_INSIDE}{_MARK}]++|"[^"\\}}{_DONE}{_INSIDE}{_MARK}]*+(?:(?:\\.|\}}(?!\}}))[^"\\}}{_DONE}{_INSIDE}{_MARK}]*+)*+")*+\z'
#: Marked text in which every bracket is a string's, another kind's or a typed list's or map's.
_WHOLE = rf'^(?:[^"\[\]{{}}]++|{_STRING}|[\[{{]{_MARK}|[\]}}]\}}\}}|\{{\}}{_MARK}|{_OTHER}{_MARK})*+\z'


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is evaluated once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _each(text: Column, old: Sequence[str], new: Sequence[str]) -> Column:
    for a, b in zip(old, new, strict=True):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _masked(text: Column) -> Column:
    """JSON text with stand-ins for brackets inside strings."""
    used = _DONE + _INSIDE + _MARK
    text = F.when(text.rlike(f"[{used}]"), _each(text, used, [f"\\u{ord(c):04x}" for c in used])).otherwise(text)
    tokens = F.regexp_extract_all(text, F.lit(rf'{_STRING}|[^"]+'), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.startswith('"') & t.rlike(r"[\[\]{}]"), F.translate(t, "[]{}", _INSIDE)).otherwise(t)), "")


def _at_once(text: Column) -> Column:
    """A typed value without its types, in a fixed number of scans: one takes the types off scalars and openings, and marks
    these and objects of other kinds. If nothing else is left, every ]}} ends a list, and the other closing braces end maps,
    three each. Null if something else is left."""
    opened = F.regexp_replace(F.replace(text, F.lit('{"arrayValue":{}}'), F.lit('{"arrayValue":{"values":[]}}')), rf'{_OPENS}|{_SCALAR}|\{{"mapValue":(\{{\}})\}}|({_OTHER})', f"$1$2$3$4$5{_MARK}")
    return _once(opened, lambda t: F.when(t.rlike(_WHOLE), _each(t, ("]}}", "}}}", _MARK), ("]", "}", ""))))


def _level_by_level(text: Column) -> Column:
    """A typed value without its types, lists and maps from the innermost outwards: brackets that are done with are replaced,
    so that each pass sees the next. What opens as a typed list or map and has something beside its values or fields stays
    as it is."""
    inner, (l, r, m, n) = r"([^\[\]{}]*+)", _DONE
    passes = (
        (rf"{_MARK}\[{inner}\](?!\}}\}})", f'{{"arrayValue":{{"values":{l}$1{r}'), (rf"{_MARK}\{{{inner}\}}(?!\}}\}})", f'{{"mapValue":{{"fields":{m}$1{n}'),
        (rf"{_MARK}\[{inner}\]\}}\}}|(?<!{_MARK})\[{inner}\]", f"{l}$1$2{r}"), (rf"{_MARK}\{{{inner}\}}\}}\}}|(?<!{_MARK})\{{{inner}\}}", f"{m}$1$2{n}"),
    )

    def once(t: Column) -> Column:
        for pattern, new in passes:
            t = F.regexp_replace(t, pattern, new)
        return t

    def every(t: Column) -> Column:
        step = lambda a, x: F.struct(
            (a["now"] + F.when(x.startswith(_MARK), 3).when(x.isin("[", "{"), 1).otherwise(-1)).alias("now"), F.greatest(a["most"], a["now"] + 1).alias("most"))
        depth = F.aggregate(F.regexp_extract_all(t, F.lit(rf"{_MARK}?[\[\]{{}}]"), F.lit(0)), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"]
        return F.aggregate(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), t, lambda t, _: F.when(t.rlike(r"[\[\]{}]"), once(t)).otherwise(t))

    text = _each(F.regexp_replace(text, _SCALAR, "$1"), ('{"arrayValue":{}}', '{"mapValue":{}}'), (l + r, m + n))
    return _each(_once(F.regexp_replace(text, _OPENS, f"{_MARK}$1$2"), every), _DONE, "[]{}")


def _plain_json(value: Column) -> Column:
    """JSON text of a typed value, at any depth: at once if it has typed lists, maps and small objects of other kinds only,
    else level by level."""
    whole = lambda t: _each(F.coalesce(_at_once(t), _level_by_level(t)), _INSIDE, "[]{}")
    return F.coalesce(F.when(value.rlike(_SAFE), _at_once(value)), _once(_masked(value), whole))


def unwrap_typed_values(raw: Column, field: str) -> Column:
    """A document-database value ({"stringValue": ..} and the like) at $.fields.<field> without its types.

    Scalars become plain text; arrays and maps, nested in each other to any depth, become JSON text. Unknown kinds stay
    as typed JSON; an absent field or a null value is null.
    """

    def plain(value: Column) -> Column:
        at = lambda kind: F.get_json_object(value, f"$.{kind}")
        nested = F.when(value.rlike(f"^{_OPENS}") & value.rlike(_SAFE), _at_once(value))  # has no other kind beside it
        other = F.when(~value.rlike(r'^\s*\{\s*"nullValue"'), _plain_json(value))
        return F.coalesce(nested, at("stringValue"), at("timestampValue"), at("booleanValue"), at("integerValue"), other)

    return _once(F.get_json_object(raw, f"$.fields.{field}"), plain)
