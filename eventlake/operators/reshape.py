"""Explode, expand, join, group, dedupe and sort records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nested import zip_keys


def explode_slots(
    df: DataFrame, slots: str, pred: Callable[[Column], Column], title: str, day: Callable[[Column], Column] | None = None, fallback: Column | None = None, today: Column | None = None
) -> DataFrame:
    """One row per slot that pred selects; untitled records and titles with "test" go.

    With day (slot -> its date) rows get slot_day, and those without one go. A record that has no slots at all then
    gives one row of a null slot by the record's own date, fallback, if that is given. Days before today go.
    """
    rest = [c for c in df.columns if c != slots]
    good = F.col(title).isNotNull() & (F.trim(title) != "") & ~F.lower(title).contains("test")
    chosen = F.filter(slots, pred)
    if fallback is not None:
        one = F.array(F.lit(None).cast(df.schema[slots].dataType.elementType))
        chosen = F.when(F.coalesce(F.size(slots), F.lit(0)) <= 0, one).otherwise(chosen)
        df, rest = df.withColumn("_fallback", fallback), [*rest, "_fallback"]
    out = df.filter(good).select(*rest, F.explode(chosen).alias("slot"))
    if day is not None:
        own = day(F.col("slot"))
        out = out.withColumn("slot_day", own if fallback is None else F.when(F.col("slot").isNull(), F.col("_fallback")).otherwise(own)).filter("slot_day is not null")
        if today is not None:
            out = out.filter(F.col("slot_day") >= today)
    return out.drop("_fallback")


def explode_trips(df: DataFrame, days: str, header: Column) -> DataFrame:
    """One row per trip of a map of days to maps of slots to arrays of trips: day, slot and trip, a map by header names."""
    rest = [c for c in df.columns if c != days]
    by_day = df.select(*rest, header.alias("_header"), F.explode(days).alias("day", "_slots"))
    by_slot = by_day.select(*rest, "_header", "day", F.explode("_slots").alias("slot", "_trips"))
    return by_slot.select(*rest, "_header", "day", "slot", F.explode("_trips").alias("_trip")).select(*rest, "day", "slot", zip_keys(F.col("_header"), F.col("_trip")).alias("trip"))


def slot_fragment_url(df: DataFrame, key: str, url: str, start: str, available: Column) -> DataFrame:
    """Add #yyyy-MM-ddTHHmm to the URL where a record has several available slots; unavailable rows go."""
    n = F.count("*").over(Window.partitionBy(key))
    out = df.filter(available).withColumn("_n", n)
    fragment = F.concat(F.col(url), F.lit("#"), F.date_format(start, "yyyy-MM-dd'T'HHmm"))
    return out.withColumn(url, F.when(F.col("_n") > 1, fragment).otherwise(F.col(url))).drop("_n")


def expand_daily(df: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """One row per day from start to end at the same wall times, the name with " (MMM dd)" if there are several.

    An absent end is the start; rows whose end lies before the start stay as they are.
    """
    last = F.coalesce(F.to_date(end), F.to_date(start))
    span = F.greatest(F.datediff(last, F.to_date(start)), F.lit(0))
    out = df.withColumn("_span", span).withColumn("_day", F.explode(F.sequence(F.lit(0), F.col("_span"))))
    shift = F.make_dt_interval(F.col("_day"))
    back = F.make_dt_interval(F.col("_span") - F.col("_day"))
    out = out.withColumn(name, F.when(F.col("_span") > 0, F.concat(F.col(name), F.lit(" ("), F.date_format(F.col(start) + shift, "MMM dd"), F.lit(")"))).otherwise(F.col(name)))
    return out.withColumn(start, F.col(start) + shift).withColumn(end, F.when(F.col("_span") > 0, F.col(end) - back).otherwise(F.col(end))).drop("_span", "_day")


def explode_nested_dates(df: DataFrame, venues: str, dates: str) -> DataFrame:
    """One row per date of the only venue; records with none or several go."""
    rest = [c for c in df.columns if c != venues]
    return df.filter(F.size(venues) == 1).select(*rest, F.explode(F.get(F.col(venues), F.lit(0))[dates]).alias("date"))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an explicit order."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth = 1").drop("_nth")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def sort_records(df: DataFrame, start: str, url: str) -> DataFrame:
    return df.orderBy(start, url)


def group_collect(df: DataFrame, keys: Sequence[str], item: Column, out: str = "items") -> DataFrame:
    """One row per key with its items in sorted order. Groups are single records' parts, so bounded by a record's size."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(out))


def reverse_lookup_join(shows: DataFrame, formats: DataFrame, key: str) -> DataFrame:
    """Left join with the first format by position of each key; null without any."""
    first = formats.groupBy(key).agg(F.min_by(F.struct(*[c for c in formats.columns if c not in (key, "pos")]), "pos").alias("format"))
    return shows.join(first, key, "left").select(*shows.columns, "format.*")


def star_join(sessions: DataFrame, *dimensions: tuple[DataFrame, str]) -> DataFrame:
    """Inner joins of a fact table with its dimensions; the optimizer picks broadcast joins for small ones."""
    for dimension, key in dimensions:
        sessions = sessions.join(dimension, key)
    return sessions


def union_sources(*parts: DataFrame) -> DataFrame:
    """All rows by column name; missing columns are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def join_detail(listing: DataFrame, detail: DataFrame, key: str, pred: Column) -> DataFrame:
    """Rows enriched with their detail; rows without one that pred selects go."""
    return listing.join(detail.filter(pred), key)


def left_join_collect(listing: DataFrame, children: DataFrame, key: str, item: Column, out: str = "items") -> DataFrame:
    """Every row with its children in sorted order, an empty array without any."""
    grouped = group_collect(children, [key], item, out)
    return listing.join(grouped, key, "left").withColumn(out, F.coalesce(out, F.array().cast(grouped.schema[out].dataType)))


def carry_forward(current: DataFrame, previous: DataFrame, source: str) -> DataFrame:
    """Current rows, and the previous ones of sources that are absent now."""
    return current.unionByName(previous.join(current.select(source).distinct(), source, "left_anti").select(*current.columns))
