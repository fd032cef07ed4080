"""Repeated passages: substring dedup over word windows and line dedup over line windows.

A window is a fixed number of consecutive items (words or lines) of one document. Winnowing picks the smallest
k-gram hash of each window as its fingerprint; equal windows have equal fingerprints wherever they stand, so
a window can only repeat if its fingerprint occurs at another place.

Substring dedup looks up the first document of each window in a log-structured index of sorted immutable runs, first
for stretches (all consecutive windows of one fingerprint, hashed as a whole) and then for single windows, where
a fingerprint stands in different stretches of the batch and all earlier ones. Line dedup joins the positions of each
fingerprint that agree on a whole window with the first of them, and extends matches both ways along their diagonal
as far as neighbouring windows match too.
"""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, ItemHashes, Items, RollingHash, check_warehouse, discard, expand, free, join_first, maybe_broadcast, mix, parted, save, small, texts

WINDOWS = "w1 long, w2 long, doc_id long, at int"


def words(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than blank and \\x09-\\x0D."""
    return (text or b"").split()


def lines(text: bytes | None) -> list[bytes]:
    """Non-blank lines without white space at either end."""
    return [x for y in (text or b"").split(b"\n") if (x := y.strip())]


class Winnower:
    """Window hashes and window fingerprints of item sequences: k items a gram, w grams a window."""

    def __init__(self, items: Callable[[bytes | None], list[bytes]], k: int, w: int):
        self.items, self.k, self.w, self.size = items, k, w, k + w - 1

    def __getstate__(self):
        return {"items": self.items, "k": self.k, "w": self.w, "size": self.size}

    def start(self) -> None:
        hashes = ItemHashes(1)
        self.all = hashes.lines if self.items is lines else hashes.words
        self.rolling = [RollingHash(0x9E3779B97F4A7C15), RollingHash(0xD1342543DE82EF95)]

    def fingerprints(self, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First item, row and smallest gram hash of each window of a slice; no window crosses rows."""
        if len(items.hashes) < self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        low, width = self.rolling[0].windows(items.hashes, self.k), 1
        while 2 * width <= self.w:  # minima of twice as many grams at each step
            low, width = np.minimum(low[:-width], low[width:]), 2 * width
        low = np.minimum(low[: len(low) - (self.w - width)], low[self.w - width :]) if width < self.w else low
        row = items.rows()
        at = np.flatnonzero(row[: len(low)] == row[self.size - 1 :])
        return at, row[at], low[at]

    def stretches(self, items: Items) -> tuple[np.ndarray, ...]:
        """row, fingerprint, hash of the whole stretch, first window in its row and number of windows of each stretch."""
        at, row, low = self.fingerprints(items)
        starts = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (row[1:] != row[:-1])]) if len(at) else np.zeros(0, np.int64)
        n = np.diff(np.r_[starts, len(at)])
        at, row, low = at[starts], row[starts], low[starts]
        whole = self.rolling[1].spans(items.second, at, n + self.size - 1)
        return row, low, whole, at - items.bounds[row], n

    def windows(self, items: Items, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hashes of the windows that begin at some items."""
        return tuple(r.windows(h, self.size)[at] for r, h in zip(self.rolling, (items.hashes, items.second), strict=True))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


class FingerprintIndex:
    """A log-structured index of passages, in sorted immutable runs: what is new in a batch is written as another run.

    Runs of stretches have the first document of each stretch (w1 its fingerprint, w2 its hash). Runs of prints have one
    row for each fingerprint (w1): the smallest and largest first document (low, high) of its stretches. Runs of windows
    have the first document of each single window by 128-bit hash (w1, w2), of fingerprints whose stretches differ
    between documents. Texts are kept, so that windows of earlier documents can be hashed once a later stretch needs them.

    Each run is a table bucketed by a hash that no common passage makes uneven, since equal rows are one, and sorted in
    each bucket, so that a merge join reads it without a shuffle. A batch is joined with every run; from fanout runs
    on, compact() merges them into one. Batches must come in order of doc_id. An index of the same name reopens the
    runs that the catalog has.
    """

    #: Columns by which runs are bucketed and sorted.
    KEYS = {"run": ("w1", "w2"), "stretch": ("w2", "w1"), "print": ("w1",), "text": ("doc_id",)}

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None, fanout: int = 3):
        check_warehouse(spark)
        self.spark, self.name = spark, (name or f"fingerprints_{uuid.uuid4().hex}").lower()
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = [m for t in spark.catalog.listTables() if (m := re.fullmatch(re.escape(self.name) + r"_(run|stretch|print|text)(\d+)", t.name))]
        found.sort(key=lambda m: int(m[2]))
        self.runs, self.stretches, self.prints, self.texts = ([m[0] for m in found if m[1] == kind] for kind in self.KEYS)
        self.fanout, self.written = fanout, max((int(m[2]) for m in found), default=0)

    def _write(self, df: DataFrame, kind: str) -> str:
        self.written += 1
        table, keys = f"{self.name}_{kind}{self.written}", self.KEYS[kind]
        df.repartition(self.buckets, keys[0]).write.format("parquet").bucketBy(self.buckets, keys[0]).sortBy(*keys).saveAsTable(table)
        return table

    def _known(self, own: DataFrame, runs: list[str], keys: tuple[str, str]) -> DataFrame:
        """own, which has the keys, with known: the first document that a run has for them."""
        for i, run in enumerate(runs):
            old = self.spark.table(run).select(F.col(keys[0]).alias("o1"), F.col(keys[1]).alias("o2"), F.col("first").alias(f"old{i}"))
            own = own.join(old, (own[keys[0]] == old.o1) & (own[keys[1]] == old.o2), "left").drop("o1", "o2")
        known = F.coalesce(*[F.col(f"old{i}") for i in range(len(runs))], F.lit(None).cast("long"))
        return own.withColumn("known", known).drop(*[f"old{i}" for i in range(len(runs))])

    def add(self, batch: DataFrame) -> DataFrame:
        """Rows of the stored batch (w1, w2, doc_id, at) with a hash that an earlier document of the index or the batch has."""
        own = batch.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("rows"))
        own = save(self._known(own, self.runs, ("w1", "w2")), "batch")
        self.runs.append(self._write(own.filter("known is null").select("w1", "w2", "first"), "run"))
        if len(self.runs) > self.fanout:
            self.runs = self.compact(self.runs, "run")
        again = save(own.filter("known is not null or last > first").select("w1", "w2", F.coalesce("known", "first").alias("first"), "rows"), "again")
        out = save(join_first(batch, again, ["w1", "w2"], "rows").filter("first < doc_id").select("doc_id", "at"), "added")
        discard(own, again)
        return out

    def add_stretches(self, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Stretches of the batch (doc_id, at, n, repeated, many) that repeat or whose fingerprint has other stretches in
        other documents (many), and the documents of earlier batches (doc_id, w1) whose fingerprint w1 does so only since
        this batch: single windows of both have to be compared. The batch has w1, w2, doc_id, at and n.

        Equal stretches are one, so those of different first documents differ; a fingerprint of one first document
        has all its stretches there, which is where they are found again.
        """
        place = batch.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("rows"))
        own = save(self._known(place, self.stretches, ("w2", "w1")), "own")
        fresh = own.filter("known is null")
        ends = (F.min("low").alias("old_low"), F.max("high").alias("old_high"))
        older = self.prints
        self.prints = [*older, self._write(fresh.groupBy("w1").agg(F.min("first").alias("low"), F.max("first").alias("high")), "print")]
        now = self.spark.table(self.prints[-1])
        old = self.spark.createDataFrame([], "w1 long, low long, high long")
        for run in older:
            old = old.union(self.spark.table(run).join(now.select("w1"), "w1", "left_semi").select("w1", "low", "high"))
        state = now.join(old.groupBy("w1").agg(*ends), "w1", "left").filter(F.least("low", "old_low") != F.greatest("high", "old_high"))
        state = save(state.select("w1", "old_low", F.coalesce(F.col("old_low") != F.col("old_high"), F.lit(False)).alias("was_many")), "state")
        info = own.join(state.select("w1", F.lit(True).alias("many")), "w1", "left").filter("known is not null or last > first or many")
        info = save(info.select("w1", "w2", F.coalesce("known", "first").alias("first"), F.coalesce("many", F.lit(False)).alias("many"), "rows"), "info")
        out = save(join_first(batch, info, ["w1", "w2"], "rows").select("doc_id", "at", "n", (F.col("first") < F.col("doc_id")).alias("repeated"), "many"), "known")
        opened = save(state.filter("not was_many and old_low is not null").select(F.col("old_low").alias("doc_id"), "w1"), "opened")
        self.stretches.append(self._write(fresh.select("w1", "w2", "first"), "stretch"))
        if len(self.stretches) > self.fanout:
            self.stretches, self.prints = self.compact(self.stretches, "stretch"), self.compact(self.prints, "print")
        discard(own, state, info)
        return out, opened

    def last(self) -> int | None:
        """The largest doc_id that the index has."""
        ends = [self.spark.table(t).agg(F.max("doc_id")).first()[0] for t in self.texts]
        return max((x for x in ends if x is not None), default=None)

    def keep(self, docs: DataFrame) -> None:
        """Keep the texts of a call, from which later ones hash windows."""
        self.texts.append(self._write(_narrow(docs).filter("doc_id is not null"), "text"))

    def kept(self) -> DataFrame:
        """doc_id, text of all documents of the index."""
        out = self.spark.createDataFrame([], "doc_id long, text string")
        for table in self.texts:
            out = out.union(self.spark.table(table))
        return out

    def compact(self, runs: list[str], kind: str) -> list[str]:
        """Merge runs into one and drop the old ones. No two runs have the same (w1, w2); prints of one w1 are united."""
        merged = None
        for run in runs:
            part = self.spark.table(run)
            merged = part if merged is None else merged.unionByName(part)
        if kind == "print":
            merged = merged.groupBy("w1").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        new = self._write(merged, kind)
        for run in runs:
            self.spark.sql(f"DROP TABLE {run}")
        return [new]

    def drop(self) -> None:
        for table in (*self.runs, *self.stretches, *self.prints, *self.texts):
            self.spark.sql(f"DROP TABLE {table}")
        self.runs, self.stretches, self.prints, self.texts = [], [], [], []


def all_stretches(docs: DataFrame, winnow: Winnower) -> DataFrame:
    """w1 (fingerprint), w2 (hash of the stretch), doc_id, at, n: every stretch of every document, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow.start()
        for batch in small(batches):
            row, low, whole, at, n = winnow.stretches(winnow.all(batch.column("text")))
            ids = batch.column("doc_id").to_numpy()[row]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (low.view(np.int64), whole.view(np.int64), ids, at.astype(np.int32), n.astype(np.int32))], names=["w1", "w2", "doc_id", "at", "n"])

    return save(_narrow(docs.filter("doc_id is not null")).mapInArrow(run, "w1 long, w2 long, doc_id long, at int, n int"), "stretches")


def _window_batch(winnow: Winnower, items: Items, ids: np.ndarray, row: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """w1, w2, doc_id, at of the windows that begin at some items of a slice."""
    a, b = winnow.windows(items, at)
    columns = (a.view(np.int64), b.view(np.int64), ids[row], (at - items.bounds[row]).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["w1", "w2", "doc_id", "at"])


def stretch_windows(docs: DataFrame, stretches: DataFrame, winnow: Winnower) -> DataFrame:
    """w1, w2, doc_id, at: hashes of the single windows of stretches (doc_id, at, n) of docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow.start()
        for batch in small(batches):
            items, lists = winnow.all(batch.column("text")), batch.column("parts")
            row, parts = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten()
            first, n = parts.field("at").to_numpy().astype(np.int64), parts.field("n").to_numpy().astype(np.int64)
            yield _window_batch(winnow, items, batch.column("doc_id").to_numpy(), np.repeat(row, n), expand(items.bounds[row] + first, n))

    grouped = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("parts"))  # at most as many as the document has words
    return docs.join(grouped, "doc_id").select("doc_id", "text", "parts").mapInArrow(run, WINDOWS)


def print_windows(docs: DataFrame, prints: DataFrame, winnow: Winnower) -> DataFrame:
    """w1, w2, doc_id, at: hashes of the single windows of docs (doc_id, text) that have one of the fingerprints (doc_id, w1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow.start()
        for batch in small(batches):
            items, lists = winnow.all(batch.column("text")), batch.column("prints")
            at, row, low = winnow.fingerprints(items)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            kept = np.concatenate([a + np.flatnonzero(np.isin(low[a:b], lists[i].values.to_numpy().view(np.uint64))) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))])
            yield _window_batch(winnow, items, batch.column("doc_id").to_numpy(), row[kept], at[kept])

    grouped = prints.groupBy("doc_id").agg(F.collect_list("w1").alias("prints"))  # at most as many as the document has words
    few = docs.join(maybe_broadcast(prints.select("doc_id").distinct()), "doc_id", "left_semi")
    return few.join(grouped, "doc_id").select("doc_id", "text", "prints").mapInArrow(run, WINDOWS)


def _removal(docs: DataFrame, covered: DataFrame, winnow: Winnower, schema: str, finish: Callable, few: bool = False) -> DataFrame:
    """Apply finish(text, items, removed item mask) to every document; covered has doc_id, at and n: its repeated windows.

    With few, only texts that may have such windows are shuffled, at any size of the table; covered is then a stored table.
    """
    places = covered.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias("ats"))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in small(batches):
            rows = []
            lists = batch.column("ats")
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True)):
                items = winnow.items(text)
                gone = np.zeros(len(items) + winnow.size + 1, np.int32)
                if lists[i].is_valid:
                    at, n = (lists[i].values.field(x).to_numpy() for x in ("at", "n"))
                    np.add.at(gone, at, 1)
                    np.subtract.at(gone, at + n + winnow.size - 1, 1)
                rows.append((doc_id, *finish(text, items, np.cumsum(gone)[: len(items)] > 0)))
            types = types or {"long": pa.int64(), "string": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(c, types[x.split()[1]]) for c, x in zip(zip(*rows, strict=True), schema.split(", "), strict=True)] if rows else [pa.array([], types[x.split()[1]]) for x in schema.split(", ")], names=names)

    rows = _narrow(docs)
    if not few:
        return rows.join(places, "doc_id", "left").mapInArrow(run, schema)
    rows, rest = parted(rows, covered)
    rows = rows.join(places.hint("merge"), "doc_id", "left")
    return rows.unionByName(rest.withColumn("ats", F.lit(None).cast(rows.schema["ats"].dataType))).mapInArrow(run, schema)


#: Words of a gram for windows of 50: few enough that a fingerprint stands for about 20 windows, and enough that grams rarely meet by chance.
GRAM = 10


def substring_dedup(docs: DataFrame, window: int = 50, batches: int = 2, index: FingerprintIndex | None = None, fanout: int = 2) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (its text without the repeated words).

    A word goes if a window of `window` words that covers it also starts in a document with a smaller doc_id;
    windows are judged on the input. doc_id must be unique; null texts have no words, and rows with a null doc_id
    are kept whole. Other columns are ignored. An empty table gives no rows. The documents are added to the
    index in `batches` ranges of doc_id, as increments of a growing corpus. With an index of earlier calls, which had
    the same window, their documents are the earlier ones too; doc_ids must then be larger than theirs.
    """
    spark, k = docs.sparkSession, min(GRAM, window)
    winnow = Winnower(words, k, window - k + 1)
    cuts = [F.lit(i / batches) for i in range(1, batches)]
    low, high, inner = docs.agg(F.min("doc_id").cast("long"), F.max("doc_id").cast("long"), F.percentile_approx(F.col("doc_id").cast("long"), F.array(*cuts) if cuts else F.array(F.lit(1.0)))).first()
    given, found = index is not None, []
    index = index or FingerprintIndex(spark, fanout=fanout)
    last = index.last()
    if low is not None and last is not None and low <= last:
        raise ValueError(f"doc_id {low} does not follow {last}, the last one of the index")
    if low is not None:
        if given:
            index.keep(docs)
        corpus = index.kept() if given else _narrow(docs.filter("doc_id is not null"))
        stretches = all_stretches(docs, winnow)
        bounds = sorted({x for x in inner[: batches - 1] if x < high} | {high})  # batches of about as many documents, whatever their ids
        for before, upto in zip([None, *bounds], bounds, strict=False):
            ours = (F.col("doc_id") <= upto) if before is None else (F.col("doc_id") > before) & (F.col("doc_id") <= upto)
            known, opened = index.add_stretches(stretches.filter(ours))
            single = stretch_windows(corpus.filter(ours), known.filter("many and not repeated").select("doc_id", "at", "n"), winnow)
            if not opened.isEmpty():
                earlier = corpus.filter(F.col("doc_id") <= (low - 1 if before is None else before))
                single = single.union(print_windows(earlier, opened, winnow))
            single = save(single, "windows")
            again = index.add(single)
            found.append(known.filter("repeated").select("doc_id", "at", "n").union(again.filter(ours).select("doc_id", "at", F.lit(1).alias("n"))))
            discard(single, opened)
        discard(stretches)
    if not given:
        index.drop()
    covered = functools.reduce(DataFrame.union, found) if found else spark.createDataFrame([], "doc_id long, at int, n int")

    def finish(text, items, gone):
        kept = items if not gone.any() else [x for x, y in zip(items, gone.tolist(), strict=True) if not y]
        kept = b" ".join(kept)
        return len(items), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()

    return _removal(docs, covered, winnow, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string", finish)


def line_windows(docs: DataFrame, winnow: Winnower, min_words: int) -> DataFrame:
    """w1, w2, doc_id, at, n: each window of lines by its fingerprint (w1) and its whole hash (w2), with n = 1, and
    each line of at least min_words words alone, with n = 2 - winnow.size: n + winnow.size - 1 lines are covered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow.start()
        for batch in small(batches):
            items, ids = winnow.all(batch.column("text")), batch.column("doc_id").to_numpy()
            at, row, low = winnow.fingerprints(items)
            long = np.flatnonzero(items.sizes >= min_words)
            rows = np.r_[row, items.rows()[long]]
            w1 = np.r_[low, mix(items.hashes[long] + np.uint64(1))]
            w2 = np.r_[winnow.windows(items, at)[1], mix(items.second[long] + np.uint64(2))]
            n = np.r_[np.ones(len(at), np.int32), np.full(len(long), 2 - winnow.size, np.int32)]
            places = np.r_[at, long] - items.bounds[rows]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (w1.view(np.int64), w2.view(np.int64), ids[rows], places.astype(np.int32), n)], names=["w1", "w2", "doc_id", "at", "n"])

    return save(_narrow(docs.filter("doc_id is not null")).mapInArrow(run, "w1 long, w2 long, doc_id long, at int, n int"), "lines")


def line_matches(docs: DataFrame, winnow: Winnower, min_words: int) -> DataFrame:
    """doc_id, at, n, src_doc, src_at: the longest runs of n + winnow.size - 1 lines that stand at an earlier place too.

    Positions of one fingerprint and window are joined with the first of them; matches on one diagonal (place here
    less place there) whose windows follow each other extend each other to one run.
    """
    rows = line_windows(docs, winnow, min_words)
    first = rows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    first = save(first.select("w1", "w2", F.col("first.doc_id").alias("src_doc"), F.col("first.at").alias("src_at"), "rows"), "first")
    later = join_first(rows, first, ["w1", "w2"], "rows").filter("doc_id > src_doc or (doc_id = src_doc and at > src_at)")
    later = later.select("doc_id", "at", "n", "src_doc", "src_at").repartition("doc_id")
    same = Window.partitionBy("doc_id", "src_doc", F.col("at") - F.col("src_at"), "n").orderBy("at")
    runs = later.withColumn("island", F.col("at") - F.row_number().over(same))
    runs = runs.groupBy("doc_id", "src_doc", (F.col("at") - F.col("src_at")).alias("diagonal"), "n", "island").agg(F.min("at").alias("at"), F.min("src_at").alias("src_at"), F.count("*").alias("c"))
    out = save(runs.select("doc_id", "at", (F.col("n") + F.col("c") - 1).cast("int").alias("n"), "src_doc", "src_at"), "matches")
    discard(rows, first)
    return out


#: Words from which a single line counts as a passage of its own.
LONG_LINE = 50


def _line_winnow(min_lines: int) -> Winnower:
    k = max(1, (min_lines + 1) // 2)
    return Winnower(lines, k, min_lines - k + 1)


def _without_lines(text: bytes, gone: np.ndarray) -> bytes:
    drop = iter(gone.tolist())
    return b"\n".join([line for line in text.split(b"\n") if not line.strip() or not next(drop)])


def line_dedup(docs: DataFrame, min_lines: int = 2, min_words: int = LONG_LINE) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, text (without the later copies of repeated runs of lines).

    Lines are compared without white space at either end; blank ones don't count and stay. A run of min_lines or
    more lines, or one line of min_words or more words, repeats if the same lines in the same order begin at an earlier place, that is in a document with a
    smaller doc_id or before it in the same one. Every line of the later run goes. Null texts stay null, rows with
    a null doc_id stay whole. doc_id must be unique; other columns are ignored.
    """
    winnow = _line_winnow(min_lines)

    def finish(text, items, gone):
        if text is None or not gone.any():
            return len(items), 0, None if text is None else text.decode()
        return len(items), int(gone.sum()), _without_lines(text, gone).decode()

    return _removal(docs, line_matches(docs, winnow, min_words), winnow, "doc_id long, n_lines long, n_removed long, text string", finish, few=True)


def drop_repeated_lines(docs: DataFrame, min_lines: int = 2, min_words: int = LONG_LINE) -> DataFrame:
    """docs with all their columns, texts as line_dedup leaves them, and as the last one lines_removed (int), with
    underscores before it if docs have a column of that name."""
    winnow, names = _line_winnow(min_lines), docs.columns
    repeated, n_removed = free("_repeated", names), free("lines_removed", names)
    matches = line_matches(docs, winnow, min_words)
    places = matches.groupBy("doc_id").agg(F.collect_list(F.struct("at", "n")).alias(repeated))
    if matches.count() <= BROADCAST_ROWS:  # then texts stay where they are
        places = F.broadcast(places)
    schema = T.StructType([*docs.schema.fields, T.StructField(n_removed, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out, removed = [], []
            at = batch.column(repeated)
            for i, text in enumerate(texts(batch)):
                gone = np.zeros(0, bool)
                if at[i].is_valid:
                    items = winnow.items(text)
                    gone = np.zeros(len(items), bool)
                    for j, n in zip(*(at[i].values.field(x).to_numpy() for x in ("at", "n")), strict=True):
                        gone[j : j + n + winnow.size - 1] = True
                    text = _without_lines(text, gone)
                out.append(None if text is None else text.decode())
                removed.append(int(gone.sum()))
            yield pa.RecordBatch.from_arrays([*[pa.array(out, pa.string()) if x == "text" else batch.column(x) for x in names], pa.array(removed, pa.int32())], names=[*names, n_removed])

    return docs.join(places, "doc_id", "left").select(*names, repeated).mapInArrow(run, schema)
