"""Helpers that the corpus operators share: shared tables, word hashes and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join may be sent to every executor; larger sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Bytes of its texts up to which a side with texts may be.
BROADCAST_BYTES = 64 << 20
#: Rows from which a key is dealt over tasks.
HOT = 2_000
#: Entries that a task's cache of encoded words holds at most.
CACHE_WORDS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local session may go without it and gets a temporary folder: elsewhere a folder of one machine would lose rows.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-eventlake-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def check_warehouse(spark: SparkSession) -> None:
    """Refuse tables of the catalog outside a local session unless spark.sql.warehouse.dir was set: its default is a folder of one machine."""
    if not spark.sparkContext.master.startswith("local") and not spark.sparkContext.getConf().contains("spark.sql.warehouse.dir"):
        raise ValueError("spark.sql.warehouse.dir has to name a folder that driver and executors share")


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: a cut in the lineage that outlives executors."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what save() wrote for tables that nothing reads any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if df, a stored table of narrow rows, has at most limit rows; else leave it to be shuffled."""
    return F.broadcast(df) if df.count() <= limit else df


def without(docs: DataFrame, ids: DataFrame, tag: str) -> DataFrame:
    """docs without the rows of the given doc_ids, which are stored, counted and broadcast if there are few; a null doc_id stays."""
    return docs.join(maybe_broadcast(save(ids.select("doc_id").distinct(), tag)), "doc_id", "left_anti").select(*docs.columns)


#: Bits of a bitmap of doc_ids: 8 MB.
SLOTS = 1 << 26


def parted(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The docs (doc_id, text) that may have one of the doc_ids of the stored table ids, and those that surely have none.

    A bitmap of hashes tells them apart, which has SLOTS bits at most however many ids there are; more ids than that
    leave nothing sure.
    """
    slots = lambda df: df.withColumn("_slot", F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
    bits = slots(ids.select("doc_id")).groupBy("_bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    place = "bitmap_bit_position(_slot)"
    byte = f"CAST(conv(hex(substring(_bits, CAST({place} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    may = F.expr(f"coalesce(shiftright({byte}, CAST({place} % 8 AS INT)) & 1, 0) = 1")
    told = slots(docs).join(F.broadcast(bits), "_bucket", "left").withColumn("_may", may)
    return tuple(told.filter(F.col("_may") == x).select(*docs.columns) for x in (True, False))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, tasks get at most so many rows at once from the tables that are stored there."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: For each byte whether it is white space: blank and \x09-\x0D.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Items:
    """Items (words or lines) of the texts of a slice: two independent 64-bit hashes, and bounds: those of row r are bounds[r]..bounds[r + 1]."""

    hashes: np.ndarray
    second: np.ndarray
    bounds: np.ndarray
    sizes: np.ndarray | None = None

    def rows(self) -> np.ndarray:
        """The row of each item."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def expand(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. n[0] numbers, then those from starts[1], and so on."""
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class ItemHashes:
    """Hashes all items of a slice of texts at once: sums over blocks of eight bytes, each mixed with its place, mixed again."""

    def __init__(self, seed: int, lower: bool = False):
        self.seeds = mix(np.array([2 * seed + 1, 2 * seed + 2], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.lower = lower  # A-Z count as a-z

    def _sums(self, content: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(lengths):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        blocks = (lengths + 7) // 8
        starts = np.cumsum(blocks) - blocks
        padded = np.zeros(8 * int(blocks.sum()), np.uint8)
        padded[np.repeat(8 * starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(content))] = _LOWER[content] if self.lower else content
        block, place = padded.view("<u8"), np.arange(len(padded) // 8) - np.repeat(starts, blocks)
        step = (place + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        first, second = (mix(np.add.reduceat(mix(mix(block ^ seed) + step), starts) + lengths.astype(np.uint64)) for seed in self.seeds)
        return first, second

    @staticmethod
    def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of a text column, nulls as empty, and where each row begins (and the last one ends)."""
        column = column.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        return data, offsets - offsets[0]

    def words(self, column: pa.Array) -> Items:
        """Runs of bytes other than blank and \\x09-\\x0D."""
        data, offsets = self._bytes(column)
        inside = ~_BLANK[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begin = offsets[:-1][offsets[:-1] < len(data)]
        first[begin] = inside[begin]  # no word goes on in the next text
        starts = np.flatnonzero(first)
        content = data[inside]
        at = np.cumsum(inside)[starts] - 1
        return Items(*self._sums(content, np.diff(np.r_[at, len(content)])), np.searchsorted(starts, offsets))

    def lines(self, column: pa.Array) -> Items:
        """Non-blank lines without white space at either end; sizes are their numbers of words."""
        data, offsets = self._bytes(column)
        inside = ~_BLANK[data]
        black = np.flatnonzero(inside)
        if not len(black):
            return Items(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64))
        line, row = np.cumsum(data == 10)[black], np.searchsorted(offsets, black, "right")
        new = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])])
        starts, lengths = black[new], black[np.r_[new[1:], len(black)] - 1] - black[new] + 1
        word = inside.copy()
        word[1:] &= ~inside[:-1]
        word[starts] = True
        return Items(*self._sums(data[expand(starts, lengths)], lengths), np.searchsorted(starts, offsets), np.add.reduceat(word.astype(np.int64), starts))


def free(name: str, taken: Iterable[str]) -> str:
    """The name, with as many underscores before it as it takes to differ from all taken ones in any case."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class RollingHash:
    """Hashes of all windows of k consecutive items, in a few vector operations for any k."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << n.bit_length()
            for name, b in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def windows(self, h: np.ndarray, k: int) -> np.ndarray:
        n = len(h)
        if n < k or k < 1:
            return np.zeros(0, np.uint64)
        self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self.powers[:n], out=total[1:])
        return mix((total[k:] - total[:-k]) * self.inverses[: n - k + 1])

    def spans(self, h: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Hashes of spans of any sizes, which also tell spans of different sizes apart."""
        self._grow(len(h) + 1)
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.powers[: len(h)], out=total[1:])
        return mix((total[starts + sizes] - total[starts]) * self.inverses[starts] + sizes.astype(np.uint64))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


#: Bytes that a slice of a batch holds at most, unless a single row has more.
SLICE_BYTES = 1 << 20


def small(batches: Iterable[pa.RecordBatch], rows: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded rows and bytes, so that what is made of a slice stays small."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if batch.num_rows > rows or (batch.num_rows > 1 and batch.nbytes > SLICE_BYTES):
            half = batch.num_rows // 2
            yield from cut(batch.slice(0, half))
            yield from cut(batch.slice(half))
        else:
            yield batch

    for batch in batches:
        yield from cut(batch)


def join_first(rows: DataFrame, first: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows joined with the stored table first, which has one row and a count of rows for each key it has.

    Keys of more than HOT rows, which are few, are broadcast if their number, which is counted, allows it, so that
    no task gets all rows of one of them.
    """
    hot = first.filter(F.col(count) > HOT)
    n = hot.count()
    if not n or n > BROADCAST_ROWS:
        return rows.join(first.drop(count), keys)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(first.filter(F.col(count) <= HOT).drop(count), keys)
    return cold.unionByName(rows.join(F.broadcast(hot.drop(count)), keys))


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it; holds one group and one batch at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = table.column(key).to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(keys)], strict=True):
            if held and keys[start] != last:
                yield pa.concat_tables(held)
                held = []
            last = keys[start]
            held.append(table.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)
