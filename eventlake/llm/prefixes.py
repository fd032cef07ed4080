"""The prefix tree of conversations, built as z-fast tries.

A conversation is the list of the hashes of its prefixes. Each task has a range of the distinct conversations, in the order
of the tree, and puts them into a compacted trie in batches: a node stands in a hash table under the prefix at its
handle, the depth between its parent and itself that the highest power of two divides, and a fat binary search over such
depths finds where a conversation leaves the trie. Edges are then expanded to a row for each depth. Only nodes on the paths
that neighbouring ranges share get rows from several tasks, which are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, maybe_broadcast, save, small

#: Prefixes that a task's trie takes in at once, those that a task should have in all, and bytes of joined ids in a row.
BATCH, PER_TASK, JOINED = 10_000, 200_000, 1 << 20
#: Conversations that have common first turns, and the modulus of how many turns they take over.
FAMILY, TAKEN = 5, 9

NODES = "node binary, depth long, above binary, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, spent long, own long, ends_sha256 string, shared boolean, under_shared boolean"
ROOT = b""
NO_ENDS = hashlib.sha256(b"").hexdigest()


def handle_depth(low: int, high: int) -> int:
    """The number above low and up to high that the highest power of two divides."""
    return high & -1 << (low ^ high).bit_length() - 1


class Node:
    """A node of a compacted trie: the end of the edge from depth low to depth high on the path of a conversation."""

    __slots__ = ("low", "high", "of", "path", "parent", "children", "end", "sums")

    def __init__(self, low: int, high: int, of: int, path: list[bytes], parent: Node | None):
        self.low, self.high, self.of, self.path, self.parent = low, high, of, path, parent
        self.children: dict[bytes, Node] = {}
        self.end: int | None = None  # the number of the conversation that ends here

    def handle(self) -> bytes:
        return self.path[handle_depth(self.low, self.high) - 1]


class ZFastTrie:
    """A compacted trie over lists of prefix hashes; equal hashes are of equal prefixes, whose depths are equal."""

    def __init__(self) -> None:
        self.root = Node(0, 0, 0, [], None)
        self.table: dict[bytes, Node] = {}

    @staticmethod
    def _common(a: list[bytes], b: list[bytes], low: int, high: int) -> int:
        """The last depth, low or deeper up to high, at which the prefixes are equal; they are at low."""
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if a[middle - 1] == b[middle - 1] else (low, middle - 1)
        return low

    def locate(self, path: list[bytes]) -> tuple[Node, int]:
        """The exit node, on whose edge or at whose end a path leaves the trie, and the depth at which it does."""
        node, low, high = self.root, 0, len(path)
        while low < high:  # fat binary search for the deepest node on the path
            depth = handle_depth(low, high)
            found = self.table.get(path[depth - 1])
            if found is None:
                high = depth - 1
            elif found.high <= len(path) and found.path[found.high - 1] == path[found.high - 1]:
                node, low = found, found.high
            else:
                return found, self._common(path, found.path, depth, min(found.high, len(path)))
        child = node.children.get(path[node.high]) if node.high < len(path) else None
        return (node, node.high) if child is None else (child, self._common(path, child.path, node.high + 1, min(child.high, len(path))))

    def insert(self, paths: Iterable[tuple[int, list[bytes]]]) -> None:
        """Add a batch of numbered, distinct paths."""
        for number, path in paths:
            node, depth = self.locate(path)
            if depth < node.high:  # cut the edge
                above = Node(node.low, depth, node.of, node.path, node.parent)
                del self.table[node.handle()]
                node.parent.children[node.path[node.low]] = above
                node.low, node.parent = depth, above
                above.children[node.path[depth]] = node
                self.table[node.handle()] = node
                self.table[above.handle()] = above
                node = above
            if depth < len(path):
                leaf = Node(depth, len(path), number, path, node)
                node.children[path[depth]] = leaf
                self.table[leaf.handle()] = leaf
                node = leaf
            node.end = number

    def downwards(self) -> list[Node]:
        """All nodes, parents before children."""
        out, stack = [], [self.root]
        while stack:
            out.append(node := stack.pop())
            stack += node.children.values()
        return out


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and turns, the array of (turn, hash, bytes) in order: by turn, null first, those of one turn by hash."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), F.unhex(F.substring(F.sha2(whole, 256), 1, 32)).alias("hash"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and turns of every conversation, rebuilt: the first turns of its family's first one, then its own later ones."""
    own = save(turns_of(conversations), "turns")
    n = (F.crc32(F.col("conv_id").cast("string")) % TAKEN).cast("int")
    first = lambda col, n: F.slice(col, F.lit(1), n)
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_from"), first("turns", F.lit(TAKEN - 1)).alias("_head"))
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_from"), "left")
    later = F.slice("turns", n + 1, F.greatest(F.size("turns") - n, F.lit(0)))
    return both.select("conv_id", F.concat(F.coalesce(first("_head", n), F.slice("turns", 1, 0)), later).alias("turns"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all prefixes of each conversation, and the last of them."""
    for batch in small(batches):
        paths, ends = [], []
        for hashes in batch.column("hashes").to_pylist():
            path, last = [], ROOT
            for h in hashes:
                last = hashlib.blake2b(last + h, digest_size=16).digest()
                path.append(last)
            paths.append(path)
            ends.append(last)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, pa.list_(pa.binary())), batch.column("bytes"), pa.array(ends, pa.binary())], names=["conv_id", "path", "bytes", "last"])


def _batch(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    """Rows as a batch with the columns of a schema in SQL."""
    types = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.split() for x in kinds.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(x, types[t]) for x, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


JOINS, ENDS = "last binary, conv_id long, n long, ids string", "conv_id long, copies long, ends_sha256 string"


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by last and conv_id: the ids of one last joined, long runs in several rows."""
    last, ids, room = None, [], JOINED // 20
    row = lambda: (last, ids[0], len(ids), ",".join(map(str, ids)))
    for batch in batches:
        out: list[tuple] = []
        for key, conv_id in zip(batch.column("last").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (key != last or len(ids) >= room):
                out.append(row())
                ids = []
            last = key
            ids.append(conv_id)
        yield _batch(out, JOINS)
    if ids:
        yield _batch([row()], JOINS)


def _digest_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by last and conv_id: smallest conv_id, number and digest of the ids of each last, read as a stream."""
    last = digest = None
    first = n = 0
    for batch in batches:
        out = []
        for key, conv_id, more, ids in zip(*(batch.column(c).to_pylist() for c in ("last", "conv_id", "n", "ids")), strict=True):
            if digest is None or key != last:
                if digest is not None:
                    out.append((first, n, digest.hexdigest()))
                last, digest, first, n = key, hashlib.sha256(ids.encode()), conv_id, more
            else:
                digest.update(b"," + ids.encode())
                n += more
        yield _batch(out, ENDS)
    if digest is not None:
        yield _batch([(first, n, digest.hexdigest())], ENDS)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row for each distinct conversation: the smallest conv_id, copies, ends_sha256, path and bytes.

    Ids are joined where ranges of a sort put them, so that those of many copies come from many tasks; only their digest,
    which has to see all ids in order, is a stream through one task.
    """
    sort = ["last", "conv_id"]
    joined = save(paths.select("last", "conv_id").repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(_join_ids, JOINS), "ids")
    ends = joined.repartition("last").sortWithinPartitions(*sort).mapInArrow(_digest_ids, ENDS)
    return ends.join(paths.select("conv_id", "path", "bytes"), "conv_id")


class Part:
    """One range of the distinct conversations: (path, conv_id, copies, ends_sha256, bytes), in order.

    before: how deep its first path is one with the last path of the range before (-1: there is none); after: how deep its
    last path is one with the first of the next.
    """

    def __init__(self, before: int, after: int):
        self.before, self.after = before, after
        self.trie, self.rows, self.taken = ZFastTrie(), [], 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        if len(self.rows) - self.taken >= BATCH:
            self.take_in()

    def take_in(self) -> None:
        self.trie.insert((i, self.rows[i][0]) for i in range(self.taken, len(self.rows)))
        self.taken = len(self.rows)

    def with_earlier(self, path: list[bytes], depth: int) -> bool:
        """Whether the range before has the node too, and so counts it."""
        first = self.rows[0][0]
        return depth <= self.before and (not depth or first[depth - 1] == path[depth - 1])

    def with_later(self, path: list[bytes], depth: int) -> bool:
        last = self.rows[-1][0]
        return depth <= self.after and (not depth or last[depth - 1] == path[depth - 1])

    def sum_up(self, nodes: list[Node]) -> None:
        """sums of each node, at its end: members, smallest conv_id, leaves, and bytes of the subtree below, once for each member and once in all."""
        for node in reversed(nodes):
            n, smallest, leaves, spent, own = 0, [], 0, 0, 0
            for child in node.children.values():
                m, s, l, x, y = child.sums
                sizes = self.rows[child.of][4][child.low : child.high]
                n, leaves, spent = n + m, leaves + l, spent + x + m * sum(sizes)
                own += y + sum(b for d, b in enumerate(sizes, child.low + 1) if not self.with_earlier(child.path, d))
                smallest.append(s)
            if node.end is not None:
                path, conv_id, copies, *_ = self.rows[node.end]
                n += copies
                smallest.append(conv_id)
                goes_on = node.children or node.end == len(self.rows) - 1 and self.after >= len(path)  # maybe in the next range
                leaves += not goes_on
            node.sums = n, min(smallest), leaves, spent, own

    def expand(self) -> Iterator[tuple]:
        """A row for every depth of every edge, from its end upwards."""
        self.take_in()
        nodes = self.trie.downwards()
        self.sum_up(nodes)
        for node in nodes:
            path, (n, smallest, leaves, spent, own) = node.path, node.sums
            sizes = self.rows[node.of][4]
            for depth in range(node.high, node.low if node.high else -1, -1):
                at_end, counted = depth == node.high, not self.with_earlier(path, depth)
                children = sum(not self.with_earlier(c.path, depth + 1) for c in node.children.values()) if at_end else int(not self.with_earlier(path, depth + 1))
                shared = not counted or self.with_later(path, depth)
                above = depth > 0 and (self.with_earlier(path, depth - 1) or self.with_later(path, depth - 1))
                parent = None if not depth else smallest if depth - 1 > node.low else node.parent.sums[1]
                ends = self.rows[node.end][3] if at_end and node.end is not None else NO_ENDS
                name = lambda d: path[d - 1] if d else ROOT
                spent, own = spent + n * (sizes[depth - 1] if depth else 0), own + (sizes[depth - 1] if depth and counted else 0)
                yield name(depth), depth, name(depth - 1) if depth else None, smallest, parent, n, children, leaves, spent, own, ends, shared, above


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the nodes of each part, from rows sorted by part and path."""
    part, number = None, None

    def out() -> Iterator[pa.RecordBatch]:
        rows = part.expand()
        while some := list(islice(rows, 10_000)):
            yield _batch(some, NODES)

    for batch in small(batches):
        for key, before, after, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "before", "after", "path", "conv_id", "copies", "ends_sha256", "bytes")), strict=True):
            if key != number:
                if part:
                    yield from out()
                part, number = Part(before, after), key
            part.add(tuple(row))
    if part:
        yield from out()


def prefix_tree(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, from the empty one on.

    conv_id: smallest of the conversations that begin so; depth; parent_conv_id: that of the sequence without the last
    turn (null at depth 0); n_convs; n_children and n_leaves: sequences one turn longer, and ends in the subtree;
    saved_tokens: over the subtree, bytes of the last text times all conversations but one; ends_sha256: of the ids of the
    conversations that are no longer, ascending, joined by commas.

    A null role or text is empty. Turns of one conversation that have the same number are in the order of their hashes, and
    repeated rows are repeated turns. Rows of a null conv_id are left out; a table without others gives no rows. Further
    columns are not read. A conversation's hashes, 24 bytes a turn, are one row, however long its texts are.
    """
    spark = conversations.sparkSession
    hashed = rebuilt(conversations).select("conv_id", F.col("turns.hash").alias("hashes"), F.col("turns.bytes").alias("bytes"))
    paths = save(hashed.mapInArrow(_paths, "conv_id long, path array<binary>, bytes array<long>, last binary"), "paths")
    total = paths.agg(F.sum(F.size("path"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PER_TASK))
    parts = save(distinct_paths(paths).repartitionByRange(n, "path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id()), "parts")
    ends = parts.groupBy("part").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("part")  # a row for each part
    common = lambda a, b: F.coalesce(F.when(a.isNotNull() & b.isNotNull(), F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: z))), F.lit(-1))
    ends = save(ends.select("part", common(F.lag("last").over(order), F.col("first")).alias("before"), common(F.col("last"), F.lead("first").over(order)).alias("after")), "ends")
    nodes = save(parts.join(maybe_broadcast(ends), "part").repartition("part").sortWithinPartitions("part", "path").mapInArrow(_tries, NODES), "nodes")
    discard(paths, parts, ends)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "own")]
    shared = nodes.filter("shared").groupBy("node", "depth").agg(F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), *sums, F.coalesce(F.min(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"))
    shared = save(shared, "shared")
    above = maybe_broadcast(shared).select(F.col("node").alias("above"), F.col("conv_id").alias("_parent"))
    every = nodes.filter("NOT shared").drop("node", "shared").unionByName(shared.drop("node").withColumns({"parent_conv_id": F.lit(None).cast("long"), "under_shared": F.lit(True)}))
    looked_up = every.filter("under_shared").join(above, "above", "left").withColumn("parent_conv_id", F.col("_parent")).drop("_parent")
    out = every.filter("NOT under_shared").unionByName(looked_up)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("spent") - F.col("own")).alias("saved_tokens"), "ends_sha256")
