"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are summed in Spark over all training rows; the log-probability matrix (buckets x languages) is
broadcast and documents are scored in numpy, a bounded slice of text at a time.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save, small

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Languages that are learnt and scored at once, so that a matrix has at most BUCKETS * LANGUAGES floats; more take more passes.
LANGUAGES = 200
SLICE = 500_000  # characters that are hashed at once
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def ngrams(text: str, before: int = 0) -> np.ndarray:
    """Hashed n-grams of a lower-cased text whose non-letters count as blanks, but for those that end in its first characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    points = np.where((points < 65) | ((points > 90) & (points < 97)) | ((points > 122) & (points < 128)), np.uint64(32), points)
    found, rolled = [], np.zeros(len(points), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(points) < n:
            break
        rolled = rolled[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            found.append((rolled[max(0, before - n + 1) :] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48))
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def slices(text: str) -> Iterator[np.ndarray]:
    """The n-grams of a whole text, slice by slice; each begins with the characters before it that its n-grams reach back to."""
    text, back = text.lower(), max(ORDERS) - 1
    for i in range(0, len(text), SLICE):
        before = min(i, back)
        yield ngrams(text[i - before : i + SLICE], before)


def counts(docs: DataFrame) -> DataFrame:
    """lang, bucket, n over all rows with a non-null lang; a null text has no n-grams but still counts (bucket -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        rows: dict[str, int] = defaultdict(int)

        def sums_so_far() -> Iterator[pa.RecordBatch]:
            for lang, n in rows.items():
                own = sums[lang]
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (len(at) + 1)), pa.array(np.r_[-1, at].astype(np.int32)), pa.array(np.r_[n, own[at]])], names=["lang", "bucket", "n"])
            sums.clear()
            rows.clear()

        for batch in small(batches):
            if len(rows) > 64:  # a task holds the sums of few languages at a time
                yield from sums_so_far()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows[lang] += 1
                for x in slices(text.as_py() or ""):
                    if len(x) < 4096:
                        np.add.at(sums[lang], x, 1)
                    else:
                        sums[lang] += np.bincount(x, minlength=BUCKETS)
        yield from sums_so_far()

    found = docs.filter(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, "lang string, bucket int, n long")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Part:
    """Some languages of a model, in order, with their log priors and log-probability matrix (buckets x languages)."""

    langs: list[str]
    priors: np.ndarray
    matrix: np.ndarray


def fit(docs: DataFrame, alpha: float = 0.5) -> list[Part]:
    """A model learnt from every row of docs with a lang, in parts of at most LANGUAGES languages.

    Null texts count for the prior only; rows of a null or repeated doc_id count each.
    """
    table = save(counts(docs), "counts")
    rows = {r["lang"]: r["n"] for r in table.filter("bucket < 0").collect()}  # one row a language
    langs, total = sorted(rows), sum(rows.values())
    parts = []
    for i in range(0, len(langs), LANGUAGES):
        own = langs[i : i + LANGUAGES]
        at = {x: j for j, x in enumerate(own)}
        found = table.filter((F.col("bucket") >= 0) & F.col("lang").isin(own)).toArrow()  # at most BUCKETS * LANGUAGES rows
        matrix = np.full((BUCKETS, len(own)), alpha)
        column = np.array([at[x] for x in found.column("lang").to_pylist()], np.int64)
        matrix[found.column("bucket").to_numpy(), column] += found.column("n").to_numpy()
        parts.append(Part(own, np.log(np.array([rows[x] for x in own]) / total), np.log(matrix / matrix.sum(axis=0)).astype(np.float32)))
    discard(table)
    return parts


def log_likelihood(matrix: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sum of the matrix rows of the n-grams x; those of many n-grams are counted first."""
    if len(x) < 20_000:
        return matrix[x].sum(axis=0, dtype=np.float64)
    counts = np.bincount(x, minlength=BUCKETS)
    return sum(counts[i : i + 4096].astype(np.float64) @ matrix[i : i + 4096].astype(np.float64) for i in range(0, BUCKETS, 4096))


def _score(docs: DataFrame, part: Part, keep: str) -> DataFrame:
    """keep, number, doc_id, lang (null without letters), top (its log score) and logsum (of all scores) by one part of a model."""
    sent = docs.sparkSession.sparkContext.broadcast(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in small(batches):
            pred, top, logsum = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                if text is None or not has_letter(text):
                    pred.append(None)
                    top.append(None)
                    logsum.append(None)
                    continue
                total = own.priors + sum(log_likelihood(own.matrix, x) for x in slices(text))
                best = int(np.argmax(total))
                pred.append(own.langs[best])
                top.append(float(total[best]))
                logsum.append(float(total[best] + np.log(np.exp(total - total[best]).sum())))
            yield pa.RecordBatch.from_arrays([batch.column(keep), batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(top, pa.float64()), pa.array(logsum, pa.float64())], names=[keep, "doc_id", "lang", "top", "logsum"])

    return docs.mapInArrow(run, f"{keep} long, doc_id long, lang string, top double, logsum double")


def predict(docs: DataFrame, model: list[Part]) -> DataFrame:
    """doc_id, lang_pred, score for every row; `und` and 0 for null or letterless texts, or without a model.

    Only text is read; rows of a null or repeated doc_id are predicted each, other columns are ignored, whatever their
    names, and an empty table gives no rows. Ties go to the first language in order.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not model:
        return narrow.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if len(model) == 1:
        found = _score(narrow.withColumn("row", F.lit(0).cast("long")), model[0], "row")
        share = F.exp(F.col("top") - F.col("logsum"))
    else:  # every part scores every text; the best of all is the best of the parts' best
        numbered = save(narrow.withColumn("row", F.monotonically_increasing_id()), "numbered")
        found = functools.reduce(DataFrame.union, [_score(numbered, part, "row") for part in model])
        found = found.groupBy("row", "doc_id").agg(F.max("top").alias("top"), F.max("logsum").alias("most"), F.collect_list(F.struct("top", "lang", "logsum")).alias("parts"))
        found = found.withColumn("lang", F.array_min(F.transform(F.filter("parts", lambda x: x["top"] == F.col("top")), lambda x: x["lang"])))
        total = F.aggregate("parts", F.lit(0.0), lambda s, x: s + F.coalesce(F.exp(x["logsum"] - F.col("most")), F.lit(0.0)))
        share = F.exp(F.col("top") - F.col("most")) / total
    return found.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang_pred"), F.when(F.col("lang").isNull(), 0.0).otherwise(F.least(share, F.lit(1.0))).alias("score"))
