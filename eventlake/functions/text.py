"""Column functions over text, URLs and HTML."""

from __future__ import annotations

import json
import os.path
from collections.abc import Mapping, Sequence
from html.entities import html5
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

def non_empty(col: Column) -> Column:
    """The value, or null if it is the empty string."""
    return F.nullif(col, F.lit(""))


def first_group(col: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, or null where the pattern does not match or the group is empty."""
    return non_empty(F.regexp_extract(col, pattern, group))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def like_ci(col: Column, pattern: str) -> Column:
    """LIKE that folds the case of A-Z only."""
    return ascii_lower(col).like("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in pattern))


def in_list_ci(col: Column, values: Sequence[str]) -> Column:
    """Whether the lower-cased value is in the list; upper-case entries never match."""
    return F.lower(col).isin(list(values))


def any_substring(col: Column, values: Sequence[str]) -> Column:
    """Whether the lower-cased text contains any of the values as they stand."""
    lowered, found = F.lower(col), F.lit(False)
    for v in values:
        found = found | lowered.contains(v)
    return found


def json_text(col: Column, path: str) -> Column:
    """A JSON field as text: scalars bare, arrays and objects as JSON, null or missing as null, true as 1, false as 0.

    The last holds for booleans only; the strings "true" and "false" stay.
    """
    got = F.get_json_object(col, path)
    kind = F.try_variant_get(F.try_parse_json(col), path, "boolean")
    quoted = F.to_json(F.try_variant_get(F.try_parse_json(col), path, "variant")).startswith('"')
    return F.when(kind.isNotNull() & ~quoted & got.isin("true", "false"), F.when(got == "true", "1").otherwise("0")).otherwise(got)


def json_value(col: Column, path: str) -> Column:
    """A JSON field in JSON form: strings keep their quotes."""
    return F.to_json(F.try_variant_get(F.try_parse_json(col), path, "variant"))


def ascii_json(col: Column) -> Column:
    """JSON text with every character beyond ASCII as an escape, beyond U+FFFF as two."""
    code = lambda x: F.lower(F.hex(F.encode(x, "UTF-16BE")))
    escape = lambda x: F.regexp_replace(code(x), "(.{4})", r"\\u$1")
    parts = F.regexp_extract_all(col, F.lit(r"[\x00-\x7F]+|[^\x00-\x7F]"), F.lit(0))
    escaped = F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), escape(x)).otherwise(x)), "")
    return F.when(col.rlike(r"[^\x00-\x7F]"), escaped).otherwise(col)


def html_to_text(col: Column, sep: str = "\n") -> Column:
    """Text of a page: comments, scripts and styles go, block ends become sep, tags go, blanks collapse."""
    x = F.regexp_replace(col, r"(?s)<!--.*?-->", "")
    x = F.regexp_replace(x, r"(?is)<(script|style)\b.*?</(script|style)\s*>", "")
    x = F.regexp_replace(x, r"(?i)<br\s*/?>|</(p|div|li|h[1-6]|tr|ul|ol|table|section|article|header|footer|title)\s*>", sep)
    x = F.regexp_replace(x, r"<[^>]*>", "")
    x = F.regexp_replace(x, r"[ \t\r\f]+", " ")
    x = F.regexp_replace(x, r" ?\n ?", "\n")
    x = F.regexp_replace(x, r"\n+", "\n")
    return F.regexp_replace(x, r"^[ \n]+|[ \n]+$", "")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or ord(c) > 127 else f"\\x{ord(c):02x}" for c in text)


def tree_pattern(literals: Sequence[str]) -> str:
    """A pattern of the longest of the literals at a place: common beginnings stand once, longer ones are tried first."""

    def grow(rest: list[str]) -> str:
        longer = [x for x in rest if x]
        if not longer:
            return ""
        branches = []
        for _, some in groupby(longer, key=lambda x: x[0]):
            some = list(some)
            start = os.path.commonprefix([some[0], some[-1]])
            branches.append(_quoted(start) + grow([x[len(start) :] for x in some]))
        return f"(?:{'|'.join(branches)})" + ("?" if len(longer) < len(rest) else "")

    return grow(sorted(set(literals)))


def _code_point(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")


def numeric_reference(n: Column) -> Column:
    """What a numeric character reference stands for: C1 controls are read as Windows-1252, no code point is U+FFFD, and
    controls and noncharacters are nothing."""
    windows = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    old = F.element_at(F.array(*[F.lit(windows[i]) for i in range(0x80, 0xA0)]), (n - 0x7F).cast("int"))
    bad = n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
    gone = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    return F.when(bad, "\ufffd").when(n.between(0x80, 0x9F), old).when(gone, "").otherwise(_code_point(n))


def _names(table: Mapping[str, str]) -> tuple[dict[str, dict[str, str]], list[str]]:
    """A table of named references by first letter, and the old names that count without a semicolon, too."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, char in sorted(table.items(), key=lambda x: (len(x[0]), x[0])):
        if name.endswith(";"):
            by_letter.setdefault(name[0], {})[name[:-1]] = char
    return by_letter, [x for x in table if not x.endswith(";")]


def html_unescape(col: Column, only: Mapping[str, str] | None = None) -> Column:
    """Character references as characters, each once: named ones of the whole public table, decimal and hexadecimal ones.

    Old names and numbers count without a semicolon, too, as in browsers; what is no reference stays. With only, a table
    such as {"lt": "<"}, nothing but its names counts, and those with their semicolon.
    """
    by_letter, old = _names(html5 if only is None else {f"{name};": char for name, char in only.items()})
    names = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")
    lookup = lambda name: F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)

    def after(part: Column) -> Column:
        """What follows an ampersand."""
        decimal, hexadecimal = F.regexp_extract(part, "^#([0-9]+)", 1), F.regexp_extract(part, "^#[xX]([0-9a-fA-F]+)", 1)
        name = F.regexp_extract(part, "^([A-Za-z][A-Za-z0-9]{0,31});", 1)
        short = F.regexp_extract(part, f"^({tree_pattern(old)})", 1) if old else F.lit("")
        rest = lambda n: F.substr(part, F.lit(n + 1) if isinstance(n, int) else n + 1)
        marked = lambda used: F.regexp_replace(F.substr(part, F.length(used) + 1), "^;", "")
        number = F.when(F.length(F.ltrim(F.lit("0"), hexadecimal)) <= 8, F.conv(hexadecimal, 16, 10).try_cast("bigint"))
        numbers = only is None
        return (
            F.when(F.lit(numbers) & (decimal != ""), F.concat(numeric_reference(decimal.try_cast("bigint")), marked(F.concat(F.lit("#"), decimal))))
            .when(F.lit(numbers) & (hexadecimal != ""), F.concat(numeric_reference(number), marked(F.concat(F.lit("#x"), hexadecimal))))
            .when((name != "") & lookup(name).isNotNull(), F.concat(lookup(name), rest(F.length(name) + 1)))
            .when(short != "", F.concat(lookup(short), rest(F.length(short))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    parts = F.split(col, "&")
    return F.when(col.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), after), ""))).otherwise(col)


def numeric_entity(col: Column) -> Column:
    """Character of a decimal code point; null if it is none."""
    n = col.try_cast("bigint")
    return F.when(n.between(1, 0x10FFFF), _code_point(n))


def clean_text(col: Column) -> Column:
    """Runs of dashes and no-break spaces to line ends, <br> to a blank, then trimmed."""
    x = F.regexp_replace(col, r"--+", "\n")
    x = F.replace(x, F.lit(" "), F.lit("\n"))
    return F.trim(F.regexp_replace(x, r"(?i)<br\s*/?>", " "))


def label_value(col: Column, label: str) -> Column:
    """What stands after the label in the first line that contains it; null without one."""
    line = F.try_element_at(F.filter(F.split(col, "\n"), lambda x: x.contains(label)), F.lit(1))
    return F.trim(F.substring(line, F.locate(label, line) + len(label), F.length(line)))


def url_domain(col: Column) -> Column:
    """Host (and port) of a URL without one leading www."""
    return F.regexp_replace(first_group(col, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)"), r"^www\.", "")


def url_path(col: Column) -> Column:
    return F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def drop_dot_segments(path: Column) -> Column:
    """A path without . and .. segments: a fold over its segments that keeps those above."""
    parts, no = F.split(path, "/"), F.array().cast("array<string>")
    above = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
    step = lambda a, x: F.when(x == ".", a).when(x == "..", above(a)).otherwise(F.array_append(a, x))
    kept = F.array_join(F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), no, step), "/")
    ended = F.when(path.rlike(r"/\.\.?$") & (kept != ""), F.concat(kept, F.lit("/"))).otherwise(kept)
    return F.when(path.contains("/."), F.concat(F.lit("/"), ended)).otherwise(path)


def resolve_url(base: Column, href: Column) -> Column:
    """A link of a page as an absolute URL: scheme, host, path or folder of the page's own URL fill what the link lacks.

    Links of schemes without a host, such as mailto, stay; without a host in the base, relative links stay.
    """
    scheme, host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(path, "^(.*/)", 1), F.lit("")), F.lit("/"))
    whole = (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(host, href))
        .when(href == "", F.regexp_replace(base, "#.*$", "")).when(href.startswith("?"), F.concat(host, path, href)).otherwise(F.concat(host, folder, href))
    )
    split = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)([^?#]*)(.*)$"
    piece = lambda n: F.regexp_extract(whole, split, n)
    return F.when(href.isNull() | base.isNull() & ~href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(whole.rlike(split) & piece(2).contains("/."), F.concat(piece(1), drop_dot_segments(piece(2)), piece(3))).when((host == "") & ~href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href).otherwise(whole)


def url_slug(col: Column) -> Column:
    """Last segment of a URL's path, without query or fragment; null if the path has none."""
    return first_group(F.regexp_replace(url_path(col), "/+$", ""), r"([^/]+)$")


def dedupe_csv(col: Column) -> Column:
    """Comma-separated values without repeats, first occurrences kept, blanks trimmed, empty parts dropped."""
    parts = F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_distinct(parts), ", ")


def csv_keywords(col: Column) -> Column:
    """One comma-separated string as an array of trimmed, non-empty keywords."""
    return F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")


def split_location(col: Column, city: str) -> Column:
    """struct(name, address) of "A - B, rest": dashes and pipes unified, the first comma part split on the dash.

    The first piece is the name; the rest, without a trailing city name, is the address.
    """
    x = F.translate(col, "–—|", "---")
    head, tail = F.split(x, ",", 2), F.split(F.regexp_extract(x, "^([^,]*)", 1), "-")
    rest = F.concat(F.slice(tail, 2, F.greatest(F.size(tail), F.lit(1))), F.transform(F.split(F.coalesce(F.get(head, F.lit(1)), F.lit("")), ","), lambda p: p))
    rest = F.filter(F.transform(rest, lambda p: F.trim(p)), lambda p: p != "")
    last = F.try_element_at(rest, F.lit(-1))
    rest = F.when(F.lower(last) == city.lower(), F.slice(rest, 1, F.greatest(F.size(rest) - 1, F.lit(0)))).otherwise(rest)
    return F.struct(F.trim(F.get(tail, F.lit(0))).alias("name"), F.array_join(rest, ", ").alias("address"))


def title_before(col: Column, mark: str = "|") -> Column:
    return F.trim(F.substring_index(col, mark, 1))


def title_without_last(col: Column, mark: str = " ", n: int = 2) -> Column:
    """All but the last n parts; everything if there are no more than n."""
    parts = F.split(col, f"\\Q{mark}\\E")
    return F.when(F.size(parts) > n, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - n, F.lit(1))), mark)).otherwise(col)


def title_venue(col: Column, mark: str = " at ") -> Column:
    """What stands after the last mark; null without one."""
    return F.when(col.contains(mark), F.trim(F.substring_index(col, mark, -1)))


def build_url(template: str, **parts: Column) -> Column:
    """A template's {name} places filled with URL-encoded values (blanks as %20)."""
    out, rest = [], template
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        out += [F.lit(before), F.replace(F.url_encode(parts[name]), F.lit("+"), F.lit("%20"))]
    return F.concat(*out, F.lit(rest))


def price_int(col: Column) -> Column:
    """A price in text or number as the ceiling in whole units, as text; currency signs and commas go; junk is null."""
    return F.ceil(F.regexp_replace(col.cast("string"), r"[^0-9.\-]", "").try_cast("decimal(20,6)")).cast("string")


def price_minor(*cols: Column) -> Column:
    """A sum of minor units as units with two decimals."""
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return (total / 100).cast("decimal(20,2)")
