"""Structured Streaming form of the curation steps: they are stateless, so the batch functions run on streams as they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.rules import Rule, apply_rules


def curate_stream(records: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str, watermark: tuple[str, str] | None = None, key: str = "url") -> StreamingQuery:
    """Apply a rule table to a stream of records and append the result to Parquet files; processes what is there and ends.

    With a watermark (time column, delay) repeated keys within the delay are dropped.
    """
    out = apply_rules(records, rules)
    if watermark:
        out = out.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
