"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Only the number of pieces of each length decides how best-fit decreasing fills its bins, so the driver plans
on that histogram (at most one row per length) and Spark tokenises, ranks and places the pieces.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CACHE_WORDS, save, small

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
#: Where two white-space characters meet, or a special token stands, a text is tokenised as a whole.
WHOLE = re.compile(r"\s\s|<\|")


#: Letters below this are classed alike by every version of Unicode, so that both libraries cut them alike.
PLAIN = "\u0250"
OTHER = re.compile(f"[^\x00-{chr(ord(PLAIN) - 1)}]")


class _Chunks(dict):
    """Token ids of a chunk (little-endian 32-bit), by the chunk without its prefix."""

    def __init__(self, plain, other, prefix: str):
        super().__init__()
        self.plain, self.other, self.prefix = plain, other, prefix

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = self.prefix + chunk
        ids = self.plain(text) if max(text) < PLAIN else self.other(text)
        self[chunk] = value = np.asarray(ids, "<u4").tobytes()
        return value


@functools.lru_cache(2)
def encoder(path: str, ranks: tuple[str, str] | None = None):
    """text -> token ids as little-endian bytes, equal to those of the tokenizer file on the whole text.

    This kind of tokenizer never joins characters across a single space or line end that stands between
    other characters, so that each word's ids can be looked up once they are known. With ranks, a file of the same
    vocabulary as ranks and its splitting pattern, texts of plain letters, and else such words, are encoded by the faster library.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    other = plain = lambda x: tokenizer.encode(x, add_special_tokens=False).ids
    if ranks:
        import base64

        import tiktoken

        with open(ranks[0], "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = tiktoken.Encoding("plain", pat_str=ranks[1], mergeable_ranks=table, special_tokens={}).encode_ordinary
    first, later = _Chunks(plain, other, ""), _Chunks(plain, other, " ")
    line_end = first["\n"]

    def encode(text: str) -> bytes:
        if WHOLE.search(text):
            return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if ranks and not OTHER.search(text):
            return np.asarray(plain(text), "<u4").tobytes()
        out: list[bytes] = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(line_end)
            words = line.split(" ")
            if words[0]:
                out.append(first[words[0]])
            out += map(later.__getitem__, words[1:])
        return b"".join(out)

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, ranks: tuple[str, str] | None = None) -> DataFrame:
    """The documents' pieces: doc_id, piece, start, length, ids_crc32, and where they stand among pieces of
    their length in their task (part, nth). A null text is empty; each document ends with id 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(tokenizer_path, ranks), defaultdict(int)
        part = TaskContext.get().partitionId()
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in small(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + b"\0\0\0\0"
                total = len(ids) // 4
                start, piece = 0, 0
                while start < total:
                    length = ((total - 1) % capacity + 1) if not start else capacity
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


class Capacities:
    """A segment tree over remaining capacities: the smallest one at or above a need that has an open bin."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, at: int, is_open: bool) -> None:
        i = at + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on counts: (length, first piece of that length, pieces, first bin, place) steps.

    Bins in the same state are one range, so the plan's size depends on the number of lengths, not of pieces.
    """
    tree, held, plan, bins = Capacities(capacity), defaultdict(list), [], 0

    def put(left: int, first: int, count: int) -> None:
        if left and count:
            held[left].append((first, count))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        done, total = 0, histogram[length]
        while done < total and (left := tree.tightest(length)) is not None:
            first, count = held[left].pop()
            take = min(count, total - done)
            if take < count:
                held[left].append((first + take, count - take))
            tree.set(left, bool(held[left]))
            plan.append((length, done, take, first, capacity - left))
            put(left - length, first, take)
            done += take
        if done < total:  # new bins, each filled as far as it goes: the bin just opened is the tightest
            per = capacity // length
            full, rest = divmod(total - done, per)
            for count, deep in ((full, per), (1, rest)):
                if count and deep:
                    for i in range(deep):
                        plan.append((length, done, count, bins, i * length))
                        done += count
                    put(capacity - deep * length, bins, count)
                    bins += count
    return plan


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, ranks: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The tokenizer's files (tokenizer_path, and ranks as encoder() takes them) lie on every machine.
    docs has doc_id and text; other columns are ignored, whatever their names, and rows of a null or repeated doc_id are packed each. Documents longer than
    capacity are cut into capacity-token pieces of which the first may be shorter. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = save(pieces(docs, tokenizer_path, capacity, ranks), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    ranked = cut.join(counts.select("length", "part", before.alias("before")), ["length", "part"])
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    plan = sorted(best_fit_plan(histogram, capacity))
    columns = spark.sparkContext.broadcast([np.array(x, np.int64) for x in zip(*plan, strict=True)] if plan else None)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if columns.value is None:
            return
        lengths, firsts, _, bins, places = columns.value
        keys = lengths * (1 << 48) + firsts
        for batch in batches:
            nth = batch.column("nth").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * (1 << 48) + nth, "right") - 1
            kept = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bins[at] + nth - firsts[at]), pa.array(places[at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("nth"))
    return rows.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
