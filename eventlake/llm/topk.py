"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are put in an order in which neighbours are alike (by nearest of a few pivots) and cut into document-range
blocks. Each block keeps the largest and smallest value of every term; a query's bound for a block is the sum of its
terms' best contributions. Scoring a query within its own range of blocks gives a first k-th score; only blocks whose
bound reaches it go to the query, and they are visited by falling bound and scored through their forward index (a
dense matrix) until no bound can reach the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, save

#: Vectors in a block that is bounded and scored together, blocks in a range, queries in a pack, bounds in a group.
BLOCK, RANGE, PACK, GROUP = 128, 32, 4096, 2048
#: Vectors that order the others: those of the smallest hashes of their ids. They change the work, never the result.
PIVOTS = 128

_PACKED = "ids binary, v binary, wide boolean, width int"


def to_integers(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """id, v: floor(scale * x) of each component; rows with a null id and vectors null or with null or non-finite components go.

    A component that does not fit in 63 bits then is an error.
    """
    ok = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x):
        x = x.cast("double") * scale
        return F.when(F.abs(x) < 2.0**62, F.floor(x).cast("long")).otherwise(F.raise_error(F.lit("a vector's component is too large for 64 bits")).cast("long"))

    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("id"), F.transform("embedding", whole).alias("v"))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list column; shorter vectors count as padded with 0."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), int(lengths.max(initial=0))), np.int64)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lists)), lengths), at] = lists.flatten().to_numpy()
    return out


def _pad(*matrices: np.ndarray) -> list[np.ndarray]:
    width = max((x.shape[1] for x in matrices), default=0)
    return [x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in matrices]


def _pack(ids: np.ndarray, v: np.ndarray) -> tuple[bytes, bytes, bool, int]:
    wide = bool(len(v)) and v.size > 0 and int(np.abs(v).max()) >= 2**31
    return ids.tobytes(), np.ascontiguousarray(v, np.int64 if wide else np.int32).tobytes(), wide, v.shape[1]


def _unpack(ids: bytes, v: bytes, wide: bool, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(v, np.int64 if wide else np.int32).reshape(len(ids), width).astype(np.int64)


def _kind(q: np.ndarray, c: np.ndarray) -> type:
    """Type in which products of both are exact; floats go through BLAS, and numbers of any size are Python's."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    return np.float64 if largest < 2**53 else np.int64 if largest < 2**62 else object


def _bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and block, the sum of the terms' best contributions; never less, where floats have to round."""
    q, high, low = (x.astype(np.float64) for x in _pad(q, high, low))
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    most = np.maximum(np.abs(high), np.abs(low))
    if _kind(q, most) is not np.float64:
        bounds += (q.shape[1] + 4) * 2.0**-52 * (np.abs(q) @ most.T)
    return bounds


def ordered(rows: DataFrame, more: list[str], tasks: int) -> DataFrame:
    """rows (id, v, near and more) in order of the nearest pivot and the id, range by range over at most so many tasks."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("near", "id", "v", *more).repartitionByRange(max(1, min(tasks, most)), "near", "id").sortWithinPartitions("near", "id")


def with_pivot(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows (id, v) with near, the number of the nearest pivot."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                v, p = _pad(_matrix(part.column("v")), sent.value)
                v, p = v.astype(np.float64), p.astype(np.float64)
                near = ((p * p).sum(axis=1) - 2 * (v @ p.T)).argmin(axis=1) if len(p) else np.zeros(len(v), np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), pa.array(near.astype(np.int32))], names=["id", "v", "near"])

    return rows.select("id", "v").mapInArrow(run, "id long, v array<long>, near int")


def forward_blocks(rows: DataFrame, k: int, tasks: int) -> DataFrame:
    """Stored blocks and queries of rows (id, v, near, query).

    A block has its number, its range, its packed ids and vectors and the packed corners high and low. A query (block
    is null) has its id, v and near, and first, the k-th score among the vectors of its range, if there are k.
    """

    def corners(parts: list[np.ndarray], task: int, rng: int) -> list[tuple]:
        out = []
        for b, (ids, v) in enumerate(parts):
            ids_, v_, wide, width = _pack(ids, v)
            _, ends, wide_ends, _ = _pack(ids[:2], np.stack([v.max(axis=0), v.min(axis=0)]))
            out.append((((task << 32) + rng) * RANGE + b, (task << 32) + rng, ids_, v_, wide, width, ends, wide_ends))
        return out

    def finish(ids: np.ndarray, v: np.ndarray, query: np.ndarray, near: np.ndarray, task: int, rng: int) -> Iterator[pa.RecordBatch]:
        doc_ids, docs = ids[~query], v[~query]
        own = corners([(doc_ids[i : i + BLOCK], docs[i : i + BLOCK]) for i in range(0, len(docs), BLOCK)], task, rng)
        q_ids, q = ids[query], v[query]
        first: list[int | None] = [None] * len(q)
        for i in range(0, len(q), 512):
            kind = _kind(q[i : i + 512], docs)
            scores = q[i : i + 512].astype(kind) @ docs.astype(kind).T
            for j, row in enumerate(scores):
                row = row[doc_ids != q_ids[i + j]]
                if len(row) >= k:
                    first[i + j] = min(max(int(np.partition(row, len(row) - k)[len(row) - k]), -(2**63)), 2**63 - 1)
        n, m = len(own), len(q)
        column = lambda i, t: pa.array([r[i] for r in own] + [None] * m, t)
        lists = pa.array([None] * n + [x.tolist() for x in q], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [column(0, pa.int64()), column(1, pa.int64()), column(2, pa.binary()), column(3, pa.binary()), column(4, pa.bool_()), column(5, pa.int32()), column(6, pa.binary()), column(7, pa.bool_()),
             pa.array([None] * n + q_ids.tolist(), pa.int64()), lists, pa.array([None] * n + near[query].tolist(), pa.int32()), pa.array([None] * n + first, pa.int64())],
            names=["block", "range", "ids", "v", "wide", "width", "ends", "wide_ends", "id", "q", "near", "first"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rng = TaskContext.get().partitionId(), 0
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                new = [part.column("id").to_numpy(), _matrix(part.column("v")), part.column("query").to_numpy(zero_copy_only=False), part.column("near").to_numpy()]
                if held is None:
                    held = new
                else:
                    old, more = _pad(held[1], new[1])
                    held = [np.concatenate([held[0], new[0]]), np.concatenate([old, more]), *(np.concatenate([held[i], new[i]]) for i in (2, 3))]
                if len(held[0]) >= BLOCK * RANGE:
                    cut = BLOCK * RANGE
                    yield from finish(*(x[:cut] for x in held), task, rng)
                    held, rng = [x[cut:] for x in held], rng + 1
        if held is not None and len(held[0]):
            yield from finish(*held, task, rng)

    schema = f"block long, range long, {_PACKED}, ends binary, wide_ends boolean, id long, q array<long>, near int, first long"
    return save(ordered(rows, ["query"], tasks).mapInArrow(run, schema), "forward")


def packs(queries: DataFrame) -> DataFrame:
    """Stored packs of at most PACK queries (id, v, near, first) that stand together in the order of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i in range(0, batch.num_rows, PACK):
                part = batch.slice(i, PACK)
                packed = _pack(part.column("id").to_numpy(), _matrix(part.column("v")))
                first = np.array([-(2**63) if x is None else x for x in part.column("first").to_pylist()], np.int64).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(((task << 32) + n, *packed, first), (pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.int32(), pa.binary()), strict=True)], names=["pack", "ids", "v", "wide", "width", "first"])
                n += 1

    return save(ordered(queries, ["first"], -(-queries.count() // PACK)).mapInArrow(run, f"pack long, {_PACKED}, first binary"), "packs")


def reached_blocks(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """Stored pack, range, block: blocks whose bound reaches the first k-th score of some query of the pack.

    Bounds go out in groups of GROUP blocks without their vectors; every pack meets every group.
    """
    groups = max(1, -(-blocks.count() // GROUP))
    ends = blocks.select("block", "range", "ends", "wide_ends", "width", F.pmod(F.xxhash64("range"), F.lit(groups)).cast("int").alias("g"))
    every = packed.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(pack: pa.Table, group: pa.Table) -> pa.Table:
        good = np.zeros(group.num_rows, bool)
        if pack.num_rows and group.num_rows:
            row = pack.slice(0, 1).to_pylist()[0]
            _, q = _unpack(row["ids"], row["v"], row["wide"], row["width"])
            first = np.frombuffer(row["first"], np.int64)
            corners = [np.frombuffer(x["ends"], np.int64 if x["wide_ends"] else np.int32).reshape(2, x["width"]).astype(np.int64) for x in group.to_pylist()]
            width = max(x.shape[1] for x in corners)
            corners = np.stack([np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in corners])
            for j in range(0, len(q), 1024):
                good |= (_bounds(q[j : j + 1024], corners[:, 0], corners[:, 1]) >= first[j : j + 1024, None]).any(axis=0)
        return group.select(["p", "range", "block"]).rename_columns(["pack", "range", "block"]).filter(pa.array(good))

    right = every.select(F.col("pack").alias("p"), F.col("g").alias("h")).join(ends.withColumnRenamed("g", "h"), "h").groupBy("p", "h")
    return save(every.select("pack", "g", "ids", "v", "wide", "width", "first").groupBy("pack", "g").cogroup(right).applyInArrow(run, "pack long, range long, block long"), "reached")


def best_of_range(pack: pa.Table, blocks: pa.Table, k: int) -> pa.Table:
    """query_id, vec_id, score: each query's k best among the blocks of one range, visited by falling bound."""
    row = pack.slice(0, 1).to_pylist()[0]
    q_ids, q = _unpack(row["ids"], row["v"], row["wide"], row["width"])
    first = np.frombuffer(row["first"], np.int64)
    found = [_unpack(x["ids"], x["v"], x["wide"], x["width"]) for x in blocks.sort_by("block").to_pylist()]
    q, *vs = _pad(q, *[v for _, v in found])
    kinds = [_kind(q, v) for v in vs]
    kind = next((x for x in (object, np.int64) if x in kinds), np.float64)
    bounds = _bounds(q, np.stack([v.max(axis=0) for v in vs]), np.stack([v.min(axis=0) for v in vs]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    q, vs = q.astype(kind), [v.astype(kind) for v in vs]
    out: list[tuple] = []
    for i in range(len(q)):
        ids, scores, kth = np.zeros(0, np.int64), np.zeros(0, kind), first[i]
        for b in order[i]:
            if bounds[i, b] < kth:
                break
            own, got = found[b][0], vs[b] @ q[i]
            keep = (got >= kth) & (own != q_ids[i])
            if keep.any():
                ids, scores = np.concatenate([ids, own[keep]]), np.concatenate([scores, got[keep]])
                if len(ids) >= k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    kth = max(kth, int(scores[-1]))
        if kind is object and any(not -(2**63) <= x < 2**63 for x in scores):
            raise OverflowError("scores don't fit in 64 bits")
        out.append((np.full(len(ids), q_ids[i]), ids, scores.astype(np.int64)))
    columns = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64) for _ in range(3))
    return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def _chain(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest of the rest, so that neighbouring ranges are alike too."""
    left, order = list(range(1, len(pivots))), [0] if len(pivots) else []
    v = pivots.astype(np.float64)
    while left:
        gaps = ((v[left] - v[order[-1]]) ** 2).sum(axis=1)
        order.append(left.pop(int(gaps.argmin())))
    return pivots[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best other rows, ties to the smaller vec_id.

    Both sides have id and v (array<long>, without nulls); a best score that does not fit in 64 bits is an error, shorter vectors count as padded
    with 0. Rows of the query's own id are no candidates; other repeated ids are each; of repeated queries the one of
    the smallest vector counts. Empty sides give no rows. A query with fewer than k candidates gets all. A task holds
    one pack of queries and one range of blocks, and returns at most k rows a query.
    """
    chosen = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(PIVOTS).select("v").toArrow()  # at most PIVOTS rows
    pivots = _chain(_matrix(chosen.column("v").combine_chunks())) if chosen.num_rows else np.zeros((0, 0), np.int64)
    asked = queries.groupBy("id").agg(F.min("v").alias("v"))
    rows = with_pivot(vectors, pivots).withColumn("query", F.lit(False)).union(with_pivot(asked, pivots).withColumn("query", F.lit(True)))
    stored = forward_blocks(rows, k, -(-vectors.count() // (BLOCK * RANGE)))
    blocks = stored.filter("block is not null")
    packed = packs(stored.filter("block is null").select("near", "id", F.col("q").alias("v"), "first"))
    reached = reached_blocks(blocks, packed)
    left = packed.join(reached.select("pack", "range").distinct(), "pack").select("pack", "range", "ids", "v", "wide", "width", "first")
    right = reached.join(blocks.select("block", "ids", "v", "wide", "width"), "block").select(F.col("pack").alias("p"), F.col("range").alias("r"), "block", "ids", "v", "wide", "width")

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return best_of_range(a, b, k)

    found = left.groupBy("pack", "range").cogroup(right.groupBy("p", "r")).applyInArrow(cell, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = save(found, "scored")
    discard(stored, packed, reached)
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
