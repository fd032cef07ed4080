"""Column functions over arrays, maps and structs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def unwrap_singleton(col: Column) -> Column:
    """The element of a one-element array; null for any other array."""
    return F.when(F.size(col) == 1, F.get(col, F.lit(0)))


def first_of(col: Column) -> Column:
    """First element, or null."""
    return F.try_element_at(col, F.lit(1))


def first_where(col: Column, pred: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(col, pred), F.lit(1))


def map_codes(col: Column, codes: Mapping[str, str], default: str | None = None, strict: bool = False) -> Column:
    """A code's meaning; unknown ones become default, or raise with strict."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), col)
    if strict:
        return F.when(col.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("unknown code "), col)))
    return F.coalesce(found, F.lit(default)) if default is not None else found


def classify_first(cases: Sequence[tuple[Column, str | None]], default: str | None) -> Column:
    """The type of the first case that holds; null conditions don't hold."""
    out = F.lit(default)
    for cond, value in reversed(cases):
        out = F.when(cond, F.lit(value)).otherwise(out)
    return out


def classify_last(cases: Sequence[tuple[Column, str | None]], default: str | None) -> Column:
    """The type of the last case that holds."""
    return classify_first(list(reversed(cases)), default)


def append_tag(keywords: Column, pred: Column, tag: str, kind: Column | None = None) -> Column:
    """Append a tag without removing repeats; null or non-list keywords stay."""
    hit = pred if kind is None else pred & (kind == "list")
    return F.when(hit & keywords.isNotNull(), F.array_append(keywords, F.lit(tag))).otherwise(keywords)


def sorted_union(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def drop_trailing(col: Column, pred: Callable[[Column], Column]) -> Column:
    """The array without its last element if that matches."""
    last = F.try_element_at(col, F.lit(-1))
    return F.when(F.coalesce(pred(last), F.lit(False)), F.slice(col, 1, F.greatest(F.size(col) - 1, F.lit(0)))).otherwise(col)


def array_sum(col: Column, kind: str = "double") -> Column:
    return F.aggregate(col, F.lit(0).cast(kind), lambda a, x: a + F.coalesce(x.cast(kind), F.lit(0).cast(kind)))


def build_offers(tiers: Column, slot: Column) -> Column:
    """Offers of the active tiers; availability from the first capacity entry of the slot.

    tiers: array<struct<name, price, is_active, capacity: array<struct<slot, available>>>>.
    """

    def offer(t: Column) -> Column:
        left = F.try_element_at(F.filter(t["capacity"], lambda c: c["slot"] == slot), F.lit(1))["available"]
        return F.struct(t["name"].alias("name"), t["price"].alias("price"), F.when(left > 0, "InStock").otherwise("SoldOut").alias("availability"), left.alias("remaining"))

    return F.transform(F.filter(tiers, lambda t: t["is_active"]), offer)


def free_or_paid(tiers: Column) -> Column:
    """True if no active tier costs anything and no tier is priced; false otherwise."""
    paid = F.exists(F.filter(tiers, lambda t: t["is_active"]), lambda t: t["price"] > 0)
    return ~paid & ~F.exists(tiers, lambda t: t["price"] > 0)


def split_addons(offers: Column, words: Sequence[str]) -> Column:
    """struct(offers, addons): offers whose name contains one of the words are add-ons."""

    def is_addon(o: Column) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | F.lower(o["name"]).contains(w)
        return found

    return F.struct(F.filter(offers, lambda o: ~is_addon(o)).alias("offers"), F.filter(offers, is_addon).alias("addons"))


def pick_variant(variants: Column, pred: Callable[[Column], Column]) -> Column:
    """The first variant that matches, else the first."""
    return F.coalesce(first_where(variants, pred), first_of(variants))


def zip_keys(header: Column, row: Column) -> Column:
    """A map from header names to a row's values; surplus ones on either side go."""
    n = F.least(F.size(header), F.size(row))
    return F.map_from_arrays(F.slice(header, F.lit(1), n), F.slice(row, F.lit(1), n))


def flatten_rich_text(paragraphs: Column) -> Column:
    """Text nodes of paragraphs (array<struct<nodes: array<struct<text>>>>) joined by blanks."""
    return F.array_join(F.flatten(F.transform(paragraphs, lambda p: F.transform(p["nodes"], lambda n: n["text"]))), " ")
