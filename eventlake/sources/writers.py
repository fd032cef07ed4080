"""Writers: appending sinks for records and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.validate import validation_report


def to_event_json(df: DataFrame, url: str = "url") -> DataFrame:
    """url and event_json, the record as JSON without null fields."""
    return df.select(F.col(url).alias("url"), F.to_json(F.struct(*df.columns)).alias("event_json"))


def write_events(df: DataFrame, path: str) -> None:
    """Append (url, event_json) rows; nothing is deduplicated."""
    to_event_json(df).write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Write the rows with errors or warnings as JSON lines."""
    validation_report(df).write.mode("overwrite").json(path)


def write_star_csv(tables: Mapping[str, tuple[DataFrame, Sequence[str], str | None]], path: str) -> None:
    """Write each table with its columns in the given order, sorted by its key if it has one, as CSV with a header."""
    for name, (df, columns, key) in tables.items():
        out = df.select(*columns)
        (out.orderBy(key) if key else out).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
