"""N-gram Jaccard join with count-vector R-trees, and the components of its links.

Each document is a set of hashed word n-grams. The n-grams are hashed into groups and the group counts are the
document's point. Spark deals documents with a common rare n-gram (from the prefix that similar sets must share) into
blocks; in each block an R-tree over the points bounds overlaps by the sum of coordinate minima, first of boxes
and then of points. Pairs that survive are verified on their whole sets, and links are joined to components.
Prefixes follow one global order of n-grams, those of many documents last. Documents with equal sets are one representative from the start. Within a block only as many pairs are verified as
its components need: spanning forests of the surviving pairs, first by coarse counts in each document's largest
block, then by fine counts in all blocks that still have surviving pairs, and at last every such pair left.

An n-gram of more than BLOCK documents is dealt over many tasks: a range sort by n-gram and size cuts its documents
into chunks, which are blocks of their own. One document of each component found there then meets those of the other
chunks, and at last the documents outside the n-gram's largest component meet those chunks that can hold a partner: two
documents have to meet at the first n-gram that they share, so none of those before it are shared, and the more there are
the smaller a partner has to be. A family of m near copies thus takes a multiple of m rows and not all pairs of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ItemHashes, discard, expand, groups, maybe_broadcast, mix, save, small

#: Largest number of members of a block; of larger groups chunks of half as many are paired.
BLOCK = 512
LEAF, FANOUT = 16, 8
#: Prefix n-grams of so many documents are frequent: they come last in the order by which prefixes are taken. Any
#: set of them gives the same links; this one keeps passages that many documents share from making blocks.
FREQUENT = 24
SKETCH = "doc_id long, n int, h1 long, h2 long, prefix array<long>, point binary"
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


class Similarity:
    """Links pairs with share * union <= 100 * intersection."""

    def __init__(self, share: int = 80, width: int = 5):
        if not 0 < share <= 100 or not 0 < width <= len(_STEPS):
            raise ValueError("share must be in 1..100 and width in 1..8")
        self.share, self.width = share, width

    def prefix(self, n: int) -> int:
        """How many of a set's n smallest members have to be looked at: similar sets share one of them."""
        return n - -(-self.share * n // 100) + 1

    def stored(self, n: int) -> int:
        """How many are kept in the sketch, so that frequent ones can be replaced."""
        return min(n, self.prefix(n) + max(4, self.prefix(n) // 2))

    def sizes(self, small: int, large: int) -> bool:
        return 100 * small >= self.share * large

    def most(self) -> Column:
        """The largest set that one of n members is similar to, if at members come before the first that both have."""
        return F.expr(f"{100 + self.share} * (CAST(n AS LONG) - at) DIV {self.share} - n")

    def reached(self, overlap, total):
        """Whether an overlap suffices for two sets of total size; also for arrays."""
        return (100 + self.share) * overlap >= self.share * total

    def shingles(self, column: pa.Array, hashes: ItemHashes) -> list[np.ndarray]:
        """For each text, its distinct hashed n-grams in order of hash; a text of fewer words is one n-gram, one without words has none."""
        words, out = hashes.words(column), []
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            h = words.hashes[a:b]
            k = min(self.width, b - a)
            if not k:
                out.append(np.zeros(0, np.uint64))
                continue
            total = np.full(b - a - k + 1, k, np.uint64)
            for i in range(k):
                total += h[i : b - a - k + 1 + i] * np.uint64(_STEPS[i])
            out.append(np.unique(mix(total)))
        return out


def point(members: np.ndarray) -> bytes:
    """Counts of the members by group; the number of groups is a power of two, about one or two for each member."""
    size = 64 if len(members) < 64 else 1 << min(14, len(members).bit_length())
    while True:
        counts = np.bincount((members >> np.uint64(7)).astype(np.int64) & (size - 1), minlength=size)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8).tobytes()
        size *= 2


def sketches(docs: DataFrame, like: Similarity) -> DataFrame:
    """Size, 128-bit digest, prefix and point of each document's set; documents without words have n = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = ItemHashes(3, lower=True)
        for batch in small(batches):
            rows = []
            for doc_id, s in zip(batch.column(0).to_pylist(), like.shingles(batch.column(1), hashes), strict=True):
                n = len(s)
                h1, h2 = int(mix(s + np.uint64(1)).sum(dtype=np.uint64)), int(mix(s ^ np.uint64(_STEPS[5])).sum(dtype=np.uint64))
                rows.append((doc_id, n, h1 - (1 << 63), h2 - (1 << 63), s[: like.stored(n)].view(np.int64).copy(), point(s)))  # a copy, so that the whole set is freed
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            columns = zip(*rows, strict=True) if rows else ([] for _ in kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SKETCH.split(", ")])

    narrow = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, SKETCH)


def _reorder(members: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Members in the global order: by hash, frequent ones last."""
    at = np.searchsorted(frequent, members)
    often = frequent[np.minimum(at, len(frequent) - 1)] == members if len(frequent) else np.zeros(len(members), bool)
    return np.r_[members[~often], members[often]]


def prefix_keys(docs: DataFrame, copies: DataFrame, sketch: DataFrame, like: Similarity) -> tuple[DataFrame, list[DataFrame]]:
    """key, rep, n, at: the prefix, in the global order, of each document that is not one of the copies, and how many
    of its n-grams come before each, which is 0 for documents with rare ones only: theirs make no large blocks.

    Most prefixes follow from the sketch; documents of which more n-grams are frequent than the sketch has to
    spare are read again. Also returns the stored tables that the keys are read from.
    """
    first = sketch.filter("n > 0").join(maybe_broadcast(copies), "doc_id", "left_anti")
    counted = first.select(F.explode(F.slice("prefix", F.lit(1), F.expr(f"n - int(ceil({like.share} * n / 100)) + 1"))).alias("key")).groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") >= FREQUENT)
    counted = save(counted, "frequent")
    most = counted if counted.count() <= BROADCAST_ROWS else counted.orderBy(F.desc("c"), "key").limit(BROADCAST_ROWS)
    often = np.sort(most.select("key").toArrow().column("key").to_numpy().view(np.uint64))  # at most BROADCAST_ROWS hashes
    sent = docs.sparkSession.sparkContext.broadcast(often)
    schema = "key long, rep long, n int, at int"

    def rows(parts: list[tuple[np.ndarray, int, int]], placed: bool) -> pa.RecordBatch:
        sizes = np.array([len(x) for x, _, _ in parts])
        at = (expand(np.zeros(len(sizes), np.int64), sizes) if placed else np.zeros(int(sizes.sum()))).astype(np.int32)
        columns = [np.concatenate([x for x, _, _ in parts]).view(np.int64), np.repeat(np.array([r for _, r, _ in parts], np.int64), sizes), np.repeat(np.array([n for _, _, n in parts], np.int32), sizes), at]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "rep", "n", "at"])

    def from_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in batches:
            parts = []
            ids, sizes, stored = batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), batch.column("prefix")
            values, offsets = stored.flatten().to_numpy().view(np.uint64), np.r_[0, np.cumsum(stored.value_lengths().to_numpy(zero_copy_only=False))]
            for i, (rep, n) in enumerate(zip(ids, sizes, strict=True)):
                own = values[offsets[i] : offsets[i + 1]]
                at = np.searchsorted(frequent, own)
                rare = own[frequent[np.minimum(at, len(frequent) - 1)] != own] if len(frequent) else own
                if len(rare) >= like.prefix(n):
                    parts.append((rare[: like.prefix(n)], rep, n))
                else:  # no key: to be read again
                    parts.append((np.zeros(1, np.uint64), rep, -n))
            if parts:
                yield rows(parts, False)

    def from_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, frequent = ItemHashes(3, lower=True), sent.value
        for batch in small(batches):
            parts = []
            for rep, members in zip(batch.column(0).to_pylist(), like.shingles(batch.column(1), hashes), strict=True):
                own = _reorder(members, frequent)
                parts.append((own[: like.prefix(len(own))], rep, len(own)))
            if parts:
                yield rows(parts, True)

    ready = save(first.select("doc_id", "n", "prefix").mapInArrow(from_sketch, schema), "prefixes")
    again = save(ready.filter("n < 0").select(F.col("rep").alias("doc_id")), "again")
    more = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(maybe_broadcast(again), "doc_id", "left_semi").mapInArrow(from_text, schema)
    more = save(more, "prefixes")
    return ready.filter("n > 0").union(more), [ready, again, more, counted]


def _block_rows(parts: list[tuple[int, int | None, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows of blocks given as name, key (null: the block is whole), members, their sizes and the places of the key."""
    names, keys, reps, sizes, places = zip(*parts, strict=True)
    lengths = [len(rep) for rep in reps]
    key = np.repeat(np.array([k or 0 for k in keys], np.int64), lengths)
    whole = np.repeat(np.array([k is None for k in keys]), lengths)
    columns = [pa.array(np.repeat(np.array(names, np.int64), lengths)), pa.array(np.concatenate(reps)), pa.array(key, mask=whole), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))]
    return pa.RecordBatch.from_arrays(columns, names=["block", "rep", "key", "n", "at"])


def blocks(keys: DataFrame, like: Similarity) -> DataFrame:
    """block, rep, key, n, at: documents that share an n-gram of their prefixes.

    keys has key, rep, n and at (0, if it has none); a range sort deals them to tasks, so that a frequent n-gram is spread over many. Where a
    task sees all documents of an n-gram and they are at most BLOCK, they are a whole block (key is null), cut where
    sizes differ too much; equal ones have one name and are returned once a task. Otherwise they are chunks of at
    most BLOCK documents, with their key.
    """

    def name(members: np.ndarray) -> int:
        return int(mix(mix(members.view(np.uint64)) + np.uint64(len(members))).sum(dtype=np.uint64)) - (1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, chunks, rows = TaskContext.get().partitionId(), 0, 0
        seen: set[int] = set()
        parts: list = []
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)]
        open_key = None  # its documents may stand in other tasks or chunks too

        def chunk(key: int, rep: np.ndarray, n: np.ndarray, at: np.ndarray) -> None:
            nonlocal chunks, rows
            for i in range(0, len(rep), BLOCK):
                parts.append(((task << 32) + chunks, key, rep[i : i + BLOCK], n[i : i + BLOCK], at[i : i + BLOCK]))
                chunks += 1
            rows += len(rep)

        def whole(rep: np.ndarray, n: np.ndarray, at: np.ndarray) -> None:
            nonlocal rows
            cuts = [0, *(np.flatnonzero(100 * n[:-1].astype(np.int64) < like.share * n[1:].astype(np.int64)) + 1).tolist(), len(n)]  # no pair crosses such a step
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = rep[a:b]
                if len(own) > 1 and (x := name(own)) not in seen:
                    seen.add(x)
                    parts.append((x, None, own, n[a:b], at[a:b]))
                    rows += len(own)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, rep, n, at = (np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate(held))
            if open_key is None:
                open_key = int(key[0])
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            for a, size in zip(starts[:-1][(sizes[:-1] > 1) | (key[starts[:-1]] == open_key)].tolist(), sizes[:-1][(sizes[:-1] > 1) | (key[starts[:-1]] == open_key)].tolist(), strict=True):
                if size > BLOCK or key[a] == open_key:
                    chunk(int(key[a]), rep[a : a + size], n[a : a + size], at[a : a + size])
                else:
                    whole(rep[a : a + size], n[a : a + size], at[a : a + size])
            last = int(starts[-1])
            if sizes[-1] > BLOCK:  # go on with less than a block of it
                cut = last + int(sizes[-1]) // BLOCK * BLOCK
                open_key = int(key[last])
                chunk(open_key, rep[last:cut], n[last:cut], at[last:cut])
                last = cut
            held = [key[last:], rep[last:], n[last:], at[last:]]
            if rows > 200_000:
                yield _block_rows(parts)
                parts, rows = [], 0
        if len(held[0]):
            chunk(int(held[0][0]), *held[1:])
        if parts:
            yield _block_rows(parts)

    if "at" not in keys.columns:
        keys = keys.withColumn("at", F.lit(0))
    return keys.repartitionByRange("key", "n", "rep").sortWithinPartitions("key", "n", "rep").mapInArrow(run, "block long, rep long, key long, n int, at int")


def chunked(rows: DataFrame) -> DataFrame:
    """rows (key, side, rep, n, most) with chunk: at most BLOCK // 2 rows of one key and side that are neighbours in most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, chunk, held = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, side = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (side[1:] != side[:-1])])
            out = np.empty(len(key), np.int64)
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
                now = (int(key[a]), bool(side[a]))
                if now != last:
                    last, chunk, held = now, chunk + 1, 0
                place = held + np.arange(b - a)
                out[a:b] = (task << 32) + chunk + place // (BLOCK // 2)
                chunk, held = chunk + (held + b - a) // (BLOCK // 2), (held + b - a) % (BLOCK // 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["key", "side", "rep", "n", "most", "chunk"])

    order = ("key", "side", "most", "n", "rep")
    ordered = rows.select("key", "side", "rep", "n", "most").repartitionByRange(*order).sortWithinPartitions(*order)
    return save(ordered.mapInArrow(run, "key long, side boolean, rep long, n int, most long, chunk long"), "chunks")


class RTree:
    """A packed R-tree over count vectors: upper corners and size ranges of boxes, level by level."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes  # in order of size: neighbours go to one leaf
        self.levels = []
        high, low_n, high_n, step = points, sizes, sizes, LEAF
        while len(high) > 1:
            at = np.arange(0, len(high), step)
            high, low_n, high_n = np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(low_n, at), np.maximum.reduceat(high_n, at)
            self.levels.append((high, low_n, high_n))
            step = FANOUT

    def candidates(self, i: int, like: Similarity, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members before i among the open ones whose bound reaches the threshold, and their bounds."""
        q, n = self.points[i], self.sizes[i]
        at = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            high, low_n, high_n = self.levels[level]
            if level < len(self.levels) - 1:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(high)]
            at = at[(100 * high_n[at] >= like.share * n) & (100 * n >= like.share * low_n[at])]
            if len(at) > 1 or level == 0:
                at = at[like.reached(np.minimum(high[at], q).sum(axis=1, dtype=np.int64), n + low_n[at])]
        at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < i]
        at = at[open_[at] & (100 * np.minimum(self.sizes[at], n) >= like.share * np.maximum(self.sizes[at], n))]
        bound = np.minimum(self.points[at], q).sum(axis=1, dtype=np.int64)
        good = like.reached(bound, n + self.sizes[at])
        return at[good], bound[good]


def _sorted_members(members: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
    rep, n = members.column("rep").to_numpy(), members.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((rep, n))
    return rep[order], n[order], members.column("label").to_numpy()[order], members.take(pa.array(order))


def _block_tree(members: pa.Table, n: np.ndarray) -> RTree:
    raw = [np.frombuffer(x, np.uint8) for x in members.column("point").to_pylist()]
    size = min(map(len, raw))  # folding a larger vector adds its groups up, so that bounds stay bounds
    points = np.stack([x.reshape(-1, size).sum(axis=0, dtype=np.uint16) for x in raw])
    return RTree(points.astype(np.uint8) if points.max() < 256 else points, n)


def coarse_forest(members: pa.Table, like: Similarity) -> list[tuple[int, int]]:
    """A spanning forest, by best bounds, of the pairs of a block (rep, n, point, label) that survive the R-tree."""
    rep, n, label, members = _sorted_members(members)
    if (label == label[0]).all():
        return []
    tree, found = _block_tree(members, n), []
    points, local = tree.points, np.unique(label, return_inverse=True)[1].astype(np.int64)
    for i in range(1, len(rep)):
        while True:  # join i to one component after another, each by its best pair
            open_ = local[:i] != local[i]
            if not open_.any():
                break
            near = np.flatnonzero(open_)[-8:]  # the nearest in size are mostly of one large component
            bound = np.minimum(points[near], points[i]).sum(axis=1, dtype=np.int64)
            good = like.reached(bound, n[near] + n[i]) & (100 * n[near] >= like.share * n[i])
            if good.any():
                j = int(near[good][np.argmax(bound[good] / (n[near][good] + n[i]))])
            else:
                at, bound = tree.candidates(i, like, np.r_[open_, np.zeros(len(rep) - i, bool)])
                if not len(at):
                    break
                j = int(at[np.argmax(bound / (n[at] + n[i]))])
            found.append((int(rep[j]), int(rep[i])))
            local[local == local[j]] = local[i]
    return found


def coarse_members(members: pa.Table, like: Similarity) -> list[int]:
    """Members of a block that the R-tree leaves in some pair of different labels."""
    rep, n, label, members = _sorted_members(members)
    tree, keep = _block_tree(members, n), np.zeros(len(rep), bool)
    for i in range(1, len(rep)):
        at, _ = tree.candidates(i, like, label != label[i])
        if len(at):
            keep[at] = keep[i] = True
    return rep[keep].tolist()


def fine_overlaps(raw: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Overlaps of all pairs of sorted multisets of 16-bit numbers, by a product for each range of numbers."""
    total = np.zeros((len(raw), len(raw)), np.float64)
    for low in range(0, 65_536, step):
        parts = [x[slice(*np.searchsorted(x, (low, low + step)))].astype(np.int64) for x in raw]
        for i, x in enumerate(parts):  # the k-th count of a number is a column of its own, so that products are minima
            new = np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)
            parts[i] = x + 65_536 * (np.arange(len(x)) - np.maximum.accumulate(np.where(new, np.arange(len(x)), 0)))
        columns, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        use = counts[inverse] > 1  # what a single member has adds nothing
        row = np.repeat(np.arange(len(raw)), [len(x) for x in parts])[use]
        column = (np.cumsum(counts > 1) - 1)[inverse[use]]
        for first in range(0, int((counts > 1).sum()), 2 * step):
            own = (column >= first) & (column < first + 2 * step)
            matrix = np.zeros((len(raw), 2 * step), np.float32)
            matrix[row[own], column[own] - first] = 1
            total += matrix @ matrix.T
    return np.rint(total).astype(np.int64)


def fine_pairs(members: pa.Table, like: Similarity, every: bool) -> list[tuple[int, int]]:
    """Pairs of different labels whose fine counts (rep, n, fine, label) still allow them: a spanning forest, or every one."""
    rep, n, label, members = _sorted_members(members)
    overlap = fine_overlaps([np.frombuffer(x, np.uint16) for x in members.column("fine").to_pylist()])
    good = like.reached(overlap, n[:, None] + n[None, :]) & (label[:, None] != label[None, :])
    found, local = [], np.unique(label, return_inverse=True)[1].astype(np.int64)
    for i in range(1, len(rep)):
        at = np.flatnonzero(good[i, :i])
        if every:
            found += [(int(rep[j]), int(rep[i])) for j in at]
            continue
        at = at[np.argsort(-overlap[i, at] / (n[at] + n[i]), kind="stable")]
        while len(at := at[local[at] != local[i]]):
            found.append((int(rep[at[0]]), int(rep[i])))
            local[local == local[at[0]]] = local[i]
    return found


def by_block(rows: DataFrame, vector: str, schema: str, of_block) -> DataFrame:
    """Distinct rows that of_block (members -> list of numbers or pairs) makes of each block of rows (block, rep, n, label, vector)."""
    names = [x.split()[0] for x in schema.split(", ")]

    def to_batch(found: list) -> pa.RecordBatch:
        table = np.unique(np.sort(np.array(found, np.int64).reshape(len(found), -1)[:, -2:], axis=1), axis=0) if "a" in names else np.array(found, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(names))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list = []
        for own in groups(batches, "block"):
            block = own.column("block")[0].as_py()
            found += [(block, x) if isinstance(x, int) else x for x in of_block(own)]
            if len(found) > 100_000:
                yield to_batch(found)
                found = []
        if found:
            yield to_batch(found)

    ordered = rows.select("block", "rep", "n", "label", vector).repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(run, schema).distinct()


def member_sets(docs: DataFrame, like: Similarity) -> DataFrame:
    """doc_id, its whole set as sorted 64-bit hashes, and their sorted groups of 65,536."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = ItemHashes(3, lower=True)
        for batch in small(batches):
            sets = like.shingles(batch.column(1), hashes)
            fine = [np.sort(((s >> np.uint64(5)) & np.uint64(0xFFFF)).astype(np.uint16)).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(fine, pa.binary())], names=["doc_id", "members", "fine"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, members binary, fine binary")


def verify(found: DataFrame, sets: DataFrame, like: Similarity, keep=save) -> DataFrame:
    """The pairs whose whole sets are similar enough, stored by keep.

    Before whole sets are sent, pairs are bounded once more by counts in 65,536 groups, sent as sorted group numbers.
    """

    def overlap(x: np.ndarray, y: np.ndarray) -> int:
        """Size of the intersection of two sorted multisets."""
        if len(x) > len(y):
            x, y = y, x
        if not len(x):
            return 0
        values, starts = np.unique(x, return_index=True)
        counts = np.diff(np.r_[starts, len(x)])
        low = np.searchsorted(y, values, "left")
        return int(np.minimum(counts, np.searchsorted(y, values, "right") - low).sum())

    def keep_similar(kind: np.dtype):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("ma"), batch.column("mb"), strict=True):
                    x, y = (np.frombuffer(z.as_buffer(), kind) for z in (x, y))
                    keep.append(len(x) > 0 and bool(like.reached(overlap(x, y), len(x) + len(y))))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return run

    def join(edges: DataFrame, what: str, kind: np.dtype) -> DataFrame:
        left = sets.select(F.col("doc_id").alias("a"), F.col(what).alias("ma"))
        right = sets.select(F.col("doc_id").alias("b"), F.col(what).alias("mb"))
        return edges.join(left, "a").join(right, "b").mapInArrow(keep_similar(kind), "a long, b long")

    near = keep(join(found, "fine", np.dtype(np.uint16)), "near")
    return keep(join(near, "members", np.dtype(np.uint64)), "links")


def components(links: DataFrame) -> DataFrame:
    """id, label: every node of the links (a, b) with the smallest node it reaches, stored.

    Rounds of large-star and small-star steps, each stored in the shared folder, until one changes nothing; their
    number grows with the logarithm of the components' size.
    """

    def stored(df: DataFrame) -> tuple[DataFrame, dict]:
        """The edges, stored, and their number and hash, which are observed on the way."""
        seen = Observation()
        edges = save(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "edges")
        return edges, seen.get

    edges, before = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        new, after = stored(small.union(small_low.select("u", F.col("m").alias("v"))).distinct())
        discard(edges)
        edges = new
        if before == after:
            break
        before = after
    labels = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("id"), "label").union(edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
    out = save(labels, "labels")
    discard(edges)
    return out


def open_chunks(hot: DataFrame, labels: DataFrame, like: Similarity) -> tuple[DataFrame, list[DataFrame]]:
    """block, rep: pairs of chunks of each frequent n-gram that may still have links between different labels.

    hot has key, rep, n and at. The documents outside the largest component of an n-gram meet each other and those
    in it, in chunks that can hold a partner if that n-gram is the first they share; where an earlier one is, they meet
    there. Also returns the stored tables that the rows are read from.
    """
    labelled = hot.select("key", "rep", "n", like.most().alias("most")).join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    main = labelled.groupBy("key", "label").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("labels")).filter("labels > 1")
    main = save(main.select("key", "main"), "main")
    chunks = chunked(labelled.join(maybe_broadcast(main), "key").withColumn("side", F.col("label") == F.col("main")))
    ends = save(chunks.groupBy("key", "side", "chunk").agg(F.min("n").alias("low"), F.max("most").alias("most")), "ends")
    a = ends.filter("not side").select("key", *[F.col(x).alias(f"a_{x}") for x in ("chunk", "low", "most")])
    near = (F.col("a_most") >= F.col("low")) & (F.col("most") >= F.col("a_low"))
    pairs = a.join(ends, "key").filter((F.col("side") | (F.col("chunk") >= F.col("a_chunk"))) & near)
    pairs = save(pairs.select(F.xxhash64("a_chunk", "chunk").alias("block"), "a_chunk", "chunk"), "chunk_pairs")
    sides = pairs.select("block", F.col("a_chunk").alias("chunk")).union(pairs.filter("a_chunk <> chunk").select("block", "chunk"))
    return sides.join(chunks.select("chunk", "rep"), "chunk").select("block", "rep"), [main, chunks, ends, pairs]


def near_duplicates(docs: DataFrame, share: int = 80, width: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links reach, itself included).

    doc_id must be unique; rows with a null doc_id are left out. Null and empty texts have no n-grams, link with
    nothing and are components of their own; other columns are ignored. An empty table gives no rows.
    """
    like, temporary = Similarity(share, width), []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        """Store a table that is deleted before the result is returned."""
        temporary.append(save(df, tag))
        return temporary[-1]

    sketch = save(sketches(docs, like), "sketches")
    reps = save(sketch.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep")), "reps")
    copies = save(sketch.filter("n > 0").join(maybe_broadcast(reps.select(F.col("rep").alias("doc_id"))), "doc_id", "left_anti").select("doc_id"), "copies")
    keys, used = prefix_keys(docs, copies, sketch, like)
    raw = save(blocks(keys, like), "blocks")
    discard(*used, copies)
    sizes = save(sketch.select("doc_id", "n", "h1", "h2"), "sizes")

    # n-grams of many documents; those that were only cut between two tasks are blocks like the others
    cut = raw.filter("key is not null")
    counted = keep(cut.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("h"), F.sum("at").alias("at")).filter("c > 1"), "counted")
    together = cut.join(maybe_broadcast(counted.filter(F.col("c") <= BLOCK).select("key")), "key").select(F.xxhash64(F.lit(1), "key").alias("block"), "rep")
    cold = keep(raw.filter("key is null").select("block", "rep").distinct().union(together), "cold")
    often = counted.filter(F.col("c") > BLOCK).groupBy("c", "h").agg(F.min_by("key", F.struct("at", "key")).alias("key")).select("key")  # of n-grams with the same documents the first is enough
    hot = keep(cut.join(maybe_broadcast(often), "key", "left_semi"), "hot")
    discard(raw)
    block = cold.union(hot.select("block", "rep"))
    active = keep(block.select(F.col("rep").alias("doc_id")).distinct(), "active")
    points = keep(sketch.select("doc_id", "n", "point").join(maybe_broadcast(active), "doc_id", "left_semi"), "points")
    discard(sketch)
    reps_of = lambda df: df.withColumnRenamed("doc_id", "rep")

    tried = labels = sets = None

    def link(found: DataFrame) -> None:
        """Verify pairs that were not tried yet, and join the components that they link."""
        nonlocal tried, labels
        if tried is not None:
            found = found.join(tried, ["a", "b"], "left_anti")
        found = keep(found, "pairs")
        if labels is not None and found.isEmpty():
            return
        near = verify(found, sets_for(found), like, keep)
        tried = found if tried is None else tried.union(found)
        if labels is None:
            labels = components(near)
            return
        old = labels
        ends = near.join(old.select(F.col("id").alias("a"), F.col("label").alias("la")), "a", "left").join(old.select(F.col("id").alias("b"), F.col("label").alias("lb")), "b", "left")
        ends = keep(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b").distinct(), "ends")
        if ends.isEmpty():
            return
        up = components(ends)  # of components, which have the names of their smallest members
        moved = old.join(up.select(F.col("id").alias("label"), F.col("label").alias("up")), "label", "left").select("id", F.coalesce("up", "label").alias("label"))
        labels = save(moved.union(up.join(old, "id", "left_anti").select("id", "label")), "labels")
        temporary.extend((old, up))

    def sets_for(found: DataFrame) -> DataFrame:
        if sets is not None:
            return sets
        wanted = keep(found.select(F.col("a").alias("doc_id")).union(found.select(F.col("b").alias("doc_id"))).distinct(), "wanted")
        return keep(member_sets(docs.join(maybe_broadcast(wanted), "doc_id", "left_semi"), like), "sets")

    def labelled(rows: DataFrame) -> DataFrame:
        """Rows (block, rep) of the blocks that have different labels by now, with these."""
        own = rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        open_ = own.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("block")
        return own.join(keep(open_, "open"), "block")

    by_sizes = block.join(block.groupBy("block").agg(F.count("*").alias("size")), "block")
    largest = keep(by_sizes.groupBy("rep").agg(F.max_by("block", F.struct("size", "block")).alias("block")).select("block").distinct(), "largest")
    rows = block.join(largest, "block").withColumn("label", F.col("rep")).join(reps_of(points), "rep")
    forest = lambda rows: by_block(rows, "point", "a long, b long", lambda own: coarse_forest(own, like))
    link(forest(rows))
    left = cold
    if not hot.isEmpty():
        own = hot.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        one = own.groupBy("key", "label").agg(F.min(F.struct("rep", "n")).alias("x")).select("key", F.lit(True).alias("side"), "x.rep", "x.n", F.col("x.n").cast("long").alias("most"))
        one = chunked(one)
        temporary.append(one)
        link(forest(labelled(one.select(F.col("chunk").alias("block"), "rep")).join(reps_of(points), "rep")))
        more, stored = open_chunks(hot, labels, like)
        temporary.extend(stored)
        left = left.union(more)
    rows = labelled(left).join(reps_of(points), "rep")
    left = keep(by_block(rows, "point", "block long, rep long", lambda own: coarse_members(own, like)), "left")
    if not left.isEmpty():
        wanted = keep(left.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
        sets = keep(member_sets(docs.join(maybe_broadcast(wanted), "doc_id", "left_semi"), like), "sets")
        numbers = reps_of(sets.select("doc_id", "fine").join(points.select("doc_id", "n"), "doc_id"))
        for every in (False, True):
            link(by_block(labelled(left).join(numbers, "rep"), "fine", "a long, b long", lambda own, every=every: fine_pairs(own, like, every)))
    # a representative's smallest doc_id is itself, so that the smallest label of a component is its smallest doc_id
    discard(*temporary)
    whole = reps.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("n", "h1", "h2", F.coalesce("label", "rep").alias("label"))
    out = sizes.join(whole, ["n", "h1", "h2"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))
