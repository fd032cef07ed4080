"""Steps that bring records to their canonical form."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.nested import map_codes, sorted_union
from ..functions.text import url_domain


def set_defaults(df: DataFrame, context: str, url: str = "url", record_url: str = "record_url") -> DataFrame:
    """Force the context; a record without a url of its own gets the row's."""
    return df.withColumn("context", F.lit(context)).withColumn(record_url, F.coalesce(record_url, url))


def rename_if_present(df: DataFrame, alias: str, target: str) -> DataFrame:
    """A non-empty alias replaces the target."""
    return df.withColumn(target, F.coalesce(F.nullif(F.col(alias), F.lit("")), F.col(target))).drop(alias)


def tag_outside_radius(df: DataFrame, lat: str, lng: str, center: tuple[float, float], km: float, tag: str, keywords: str = "keywords") -> DataFrame:
    """Tag records farther than km from the centre; keywords become a sorted set then. Without coordinates or list nothing changes."""
    far = haversine_km(F.lit(center[0]), F.lit(center[1]), F.col(lat), F.col(lng)) > km
    return df.withColumn(keywords, F.when(far & F.col(keywords).isNotNull(), F.array_sort(F.array_distinct(F.array_append(keywords, F.lit(tag))))).otherwise(F.col(keywords)))


def normalize_language(df: DataFrame, col: str, names: Mapping[str, str], out: str = "in_language") -> DataFrame:
    """struct(name, code); unknown languages have the code und."""
    return df.withColumn(out, F.struct(F.col(col).alias("name"), map_codes(F.col(col), names, "und").alias("code")))


def unwrap_typed_scalar(raw: Column, type_: str, field: str) -> Column:
    """The field of an object of the given @type; other values stay."""
    return F.when(F.get_json_object(raw, "$.@type") == type_, F.get_json_object(raw, f"$.{field}")).otherwise(raw)


def drop_blocklisted(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not listed; the optimizer sends a small list to every task."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def apply_defaults(df: DataFrame, patches: DataFrame, fields: Sequence[str], url: str = "url", keywords: str = "keywords") -> DataFrame:
    """Fill fields from the defaults of the URL's domain; the record wins, keywords become the sorted union.

    patches: domain (unique), fields, keywords. Records without a patch stay as they are; a record without keywords gets the
    patch's, a patch without keywords adds none.
    """
    side = patches.select("domain", *[F.col(f).alias(f"_{f}") for f in fields], F.col(keywords).alias("_keywords"))
    out = df.withColumn("domain", url_domain(F.col(url))).join(side, "domain", "left")
    none = F.array().cast("array<string>")
    union = sorted_union(F.coalesce(keywords, none), F.coalesce("_keywords", none))
    out = out.withColumn(keywords, F.when(F.col("_keywords").isNotNull(), union).otherwise(F.col(keywords)))
    for f in fields:
        out = out.withColumn(f, F.coalesce(f, f"_{f}"))
    return out.drop("domain", "_keywords", *[f"_{f}" for f in fields])


#: A step's new value, or the value and what went wrong: text, null where nothing did.
Outcome = Column | tuple[Column, Column]


@dataclass
class Step:
    """One step of a chain: a column's new value, on rows whose URL matches. A step that can fail gives an error, too."""

    column: str
    value: Callable[[DataFrame], Outcome]
    url_pattern: str = ".*"
    name: str | None = None


def attempt(value: Column, source: Column, what: str) -> tuple[Column, Column]:
    """A value that is null where its present source can't be converted, and that as an error."""
    return value, F.when(source.isNotNull() & value.isNull(), F.concat(F.lit(f"{what}: "), source.cast("string")))


def attempt_cast(source: Column, kind: str) -> tuple[Column, Column]:
    return attempt(source.try_cast(kind), source, f"not a {kind}")


def apply_chain(df: DataFrame, steps: Sequence[Step], url: str = "url", errors: str | None = None) -> DataFrame:
    """Run steps in order, each on the rows that its pattern selects, and add `modified`: whether any column changed.

    A step that fails on a row leaves the row as it was, and later steps go on. With errors, a column of that name has
    the failures of each row in order, as "step: error".
    """
    touched = list(dict.fromkeys(s.column for s in steps))
    out = df.withColumns({f"_old_{c}": F.col(c) for c in touched})
    failed = []
    for i, s in enumerate(steps):
        got = s.value(out)
        value, error = got if isinstance(got, tuple) else (got, None)
        here = F.col(url).rlike(s.url_pattern)
        if error is not None:
            out = out.withColumn(f"_error_{i}", F.when(here, error))
            failed.append((i, s.name or s.column))
            here = here & F.col(f"_error_{i}").isNull()
        out = out.withColumn(s.column, F.when(here, value).otherwise(F.col(s.column)))
    changed = F.lit(False)
    for c in touched:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    out = out.withColumn("modified", changed)
    if errors:
        told = [F.concat(F.lit(f"{name}: "), F.col(f"_error_{i}")) for i, name in failed]
        out = out.withColumn(errors, F.array_compact(F.array(*told)) if told else F.array().cast("array<string>"))
    return out.drop(*[f"_old_{c}" for c in touched], *[f"_error_{i}" for i, _ in failed])


def count_errors(df: DataFrame, errors: str = "errors") -> DataFrame:
    """How many rows each step failed on: step, n."""
    return df.select(F.explode(errors).alias("error")).groupBy(F.substring_index("error", ": ", 1).alias("step")).agg(F.count("*").alias("n"))
