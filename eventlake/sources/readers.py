"""Readers: each returns a lazy DataFrame over landed files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_group

#: Fields of a record file that are read, all as raw text, since their shapes vary.
RECORD_FIELDS = ("url", "name", "startDate", "endDate", "description", "location", "organizer", "offers", "keywords", "image", "inLanguage")


def keywords_kind(raw: Column) -> Column:
    """Shape of a raw keywords value: absent, list, object or string."""
    return F.when(raw.isNull() | (raw == "null"), "absent").when(raw.startswith("["), "list").when(raw.startswith("{"), "object").otherwise("string")


def tag_source(df: DataFrame, raw: str, tag: Column) -> DataFrame:
    """keywords (array) and keywords_kind of a raw keywords column with a source tag added.

    A list gets the tag unless it has it; a text is kept as one entry with ", TAG, " before it; an absent value becomes
    the tag alone; an object becomes an empty array.
    """
    kind = keywords_kind(F.col(raw))
    listed = F.array_union(F.from_json(F.col(raw), "array<string>"), F.array(tag))
    joined = F.array(F.concat(F.lit(", "), tag, F.lit(", "), F.col(raw)))
    value = F.when(kind == "list", listed).when(kind == "string", joined).when(kind == "absent", F.array(tag)).otherwise(F.array().cast("array<string>"))
    return df.withColumn("keywords_kind", kind).withColumn("keywords", value)


def read_record_files(spark: SparkSession, path: str, tag: str = r"([^/]*?)(?:\.[^./]*)?$") -> DataFrame:
    """Records of all JSON-array files in a folder, tagged with their file's upper-cased base name, or what group 1 of
    another pattern finds in the file's path; rows without url go.

    Values that are no plain text stay as raw JSON text.
    """
    schema = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])
    raw = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("source", F.upper(F.regexp_extract(F.col("_metadata.file_path"), tag, 1)))
    return tag_source(raw.filter("url is not null").withColumnRenamed("keywords", "raw_keywords"), "raw_keywords", F.col("source"))


def cut_at_blank(df: DataFrame, file: str, place: str, line: str) -> DataFrame:
    """Lines before the first blank one of each file, trimmed."""
    first = F.min(F.when(F.trim(line) == "", F.col(place))).over(Window.partitionBy(file))
    return df.withColumn("_first", first).filter(F.col("_first").isNull() | (F.col(place) < F.col("_first"))).select(file, place, F.trim(line).alias(line))


def read_url_lists(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, url of the lists in a folder; a blank line ends its file."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "url"))
    return cut_at_blank(rows, "file", "line_no", "url")


def ics_time(value: Column, parameters: Column, assume_zone: str = "UTC", fallback_zone: str | None = None, zone_names: Mapping[str, str] | None = None) -> Column:
    """The instant of a calendar's date property; null if it is none.

    Z is UTC, TZID names a zone (under the names of zone_names, too) and a zone of an unknown name is fallback_zone; a time
    without either is in assume_zone, which is also the default fallback. A date is midnight, whatever the zone.
    """
    named = first_group(parameters, '(?i);TZID="?([^";:]+)')
    if zone_names:
        known = F.create_map(*[F.lit(x) for kv in zone_names.items() for x in kv])
        named = F.coalesce(F.try_element_at(known, named), named)
    local = F.try_to_timestamp(F.regexp_replace(value, "Z$", ""), F.lit("yyyyMMdd'T'HHmmss"))
    in_zone = F.try_to_timestamp(F.concat_ws(" ", value, named), F.lit("yyyyMMdd'T'HHmmss VV"))
    away = F.coalesce(in_zone, F.to_utc_timestamp(local, fallback_zone or assume_zone))
    instant = F.when(value.endswith("Z"), local).when(named.isNotNull(), away).otherwise(F.to_utc_timestamp(local, assume_zone))
    return F.coalesce(instant, F.try_to_timestamp(value, F.lit("yyyyMMdd")))


def ics_seconds(duration: Column) -> Column:
    """Seconds of a duration such as P1DT2H or -PT15M; null if it is none."""
    parts = r"^([+-]?)P(?:([0-9]+)W)?(?:([0-9]+)D)?(?:T(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?)?$"
    total = F.lit(0).cast("bigint")
    for group, unit in ((2, 604_800), (3, 86_400), (4, 3_600), (5, 60), (6, 1)):
        total = total + F.coalesce(first_group(duration, parts, group).try_cast("bigint"), F.lit(0)) * unit
    return F.when(duration.rlike(parts), F.when(duration.startswith("-"), -total).otherwise(total))


def parse_ics(df: DataFrame, text: str, keep: tuple[str, ...] = (), assume_zone: str = "UTC", fallback_zone: str | None = None, zone_names: Mapping[str, str] | None = None) -> DataFrame:
    """One row per VEVENT of calendar texts: uid, name, begin, end, all_day, description, url, location, categories, attach.

    begin and end are instants, read as ics_time says; all_day tells that the event begins on a date. Without an end
    the duration gives it.
    """
    flat = F.regexp_replace(text, "\r?\n[ \t]", "")
    parts = F.split(flat, "BEGIN:VEVENT")
    events = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    rows = df.select(*keep, F.explode(F.transform(events, lambda e: F.substring_index(e, "END:VEVENT", 1))).alias("e"))
    line = lambda k: rf'(?md)^{k}((?:;(?:"[^"\n]*"|[^":\n])*)?):([^\r\n]*)'
    get = lambda k, group=2: F.trim(first_group(F.col("e"), line(k), group))
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit("\\,"), F.lit(",")), F.lit("\\;"), F.lit(";"))
    when = lambda k: ics_time(get(k), get(k, 1), assume_zone, fallback_zone, zone_names)
    begin = when("DTSTART")
    end = F.coalesce(when("DTEND"), F.timestamp_micros(F.unix_micros(begin) + ics_seconds(get("DURATION")) * 1_000_000))
    lists = F.regexp_extract_all("e", F.lit(line("ATTACH")), F.lit(2))
    return rows.select(
        *keep, get("UID").alias("uid"), plain(get("SUMMARY")).alias("name"), begin.alias("begin"), end.alias("end"), get("DTSTART").rlike("^[0-9]{8}$").alias("all_day"),
        plain(get("DESCRIPTION")).alias("description"), get("URL").alias("url"), plain(get("LOCATION")).alias("location"),
        F.coalesce(F.split(get("CATEGORIES"), ","), F.array().cast("array<string>")).alias("categories"), lists.alias("attach"),
    )


def read_ics(spark: SparkSession, path: str, **zones) -> DataFrame:
    """parse_ics over every calendar file of a folder."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return parse_ics(files, "value", ("file",), **zones)


def read_feed(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """file, title, content, link of the first n entries of each feed; malformed feeds give nothing."""
    schema = T.StructType([
        T.StructField("title", T.StringType()), T.StructField("content", T.StructType([T.StructField("_VALUE", T.StringType())])),
        T.StructField("link", T.StructType([T.StructField("_href", T.StringType())])), T.StructField("published", T.StringType()),
    ])
    rows = spark.read.format("xml").option("rowTag", "entry").option("mode", "DROPMALFORMED").schema(schema).load(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "title", F.col("content._VALUE").alias("content"), F.col("link._href").alias("link"))
    nth = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("nth", nth).filter(F.col("nth") <= n).select("file", "nth", "title", "content", "link")


def read_star_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A CSV with a header; columns (name -> type) are picked by name, values that don't fit are null, surplus or missing cells are tolerated."""
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    have = set(rows.columns)
    return rows.select(*[(F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])
