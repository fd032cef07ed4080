"""Collocations: phrases of two to four words whose parts stand together more often than apart.

Words get ids by falling frequency. The pairs of adjacent ids fall into square tiles of the plane of pairs: a tile with
many pairs is a dense array that bincount adds to, the others are sorted coordinates with counts. Frequent pairs get ids by
falling frequency in their turn, so that two overlapping pairs are a phrase of three, and two of those one of four.
Tasks count on their own what they read; only distinct pairs with their counts are shuffled.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, discard, join_first, maybe_broadcast, save, small

#: Least occurrences of a phrase, words of the longest, phrases returned of each language, and the share (in hundredths) of its occurrences inside a longer one from which a phrase goes.
LEAST, LONGEST, BEST, INSIDE = 30, 4, 2_000, 80
#: Words, and frequent pairs, up to which a lookup is sent to every task; more are joined. Bytes of the words.
SENT_WORDS, SENT_PAIRS, SENT_BYTES = 400_000, 2_000_000, 16 << 20
#: Bits of a tile's side, pairs of a batch from which a tile becomes dense, dense tiles and sparse pairs that a task holds, and pairs that it deals over tiles at once.
SIDE, DENSE, DENSE_TILES, SPARSE, AT_ONCE = 10, 1 << 13, 6, 1_500_000, 1 << 19
#: Distinct words whose counts a task holds.
HELD_WORDS = 150_000
#: Rows that a task gets at once.
ROWS = 1_000
#: Parts of a language whose best phrases are picked on their own first.
PARTS = 64

_SIGNS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
SEQUENCE = "row long, at array<int>, id array<long>"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case, and \\xff, which is in no text, where a piece ends."""
    return text.lower().translate(_SIGNS).replace(b"\n", b" \xff ").split(b" ")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), strict=True):
        yield lang, tokens(text or b"")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n of what a task reads; a null word has the number of all words."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, held in counts.items():
            for mark in (b"", b"\xff"):
                held.pop(mark, None)
            words, n = [None, *held], [held.total(), *held.values()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in small(batches):
        for lang, words in _texts(batch):
            counts[lang].update(words)
        if sum(map(len, counts.values())) > HELD_WORDS:
            yield from flush()
    yield from flush()


class Tiles:
    """Counts of pairs of ids in tiles; what it holds is bounded, and what it gives may hold a pair more than once."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        tile, code = (a >> SIDE) << 32 | b >> SIDE, a << 32 | b
        order = np.argsort(tile, kind="stable")
        tile, code = tile[order], code[order]
        starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]]) if len(tile) else np.zeros(0, np.int64)
        sparse = np.ones(len(tile), bool)
        ends = np.r_[starts[1:], len(tile)]
        for low, high, key in zip(starts.tolist(), ends.tolist(), tile[starts].tolist()):
            if key not in self.dense:
                if high - low < DENSE or len(self.dense) >= DENSE_TILES:
                    continue
                self.dense[key] = np.zeros(1 << 2 * SIDE, np.int64)
            mask = (1 << SIDE) - 1
            self.dense[key] += np.bincount((code[low:high] >> 32 & mask) << SIDE | code[low:high] & mask, minlength=1 << 2 * SIDE)
            sparse[low:high] = False
        self.waiting.append(code[sparse])
        self._merge()

    def _merge(self) -> None:
        """Sorted coordinates and counts of what is held and what waits: only the latter is sorted, known ones are added up in place."""
        new, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        self.waiting = []
        at = np.searchsorted(self.codes, new)
        known = np.zeros(len(new), bool)
        inner = at < len(self.codes)
        known[inner] = self.codes[at[inner]] == new[inner]
        self.counts[at[known]] += n[known]
        at, new, n = at[~known], new[~known], n[~known]
        self.codes = np.insert(self.codes, at, new)
        self.counts = np.insert(self.counts, at, n)

    def take(self, everything: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Codes and counts: the sparse ones if there are too many, or all."""
        if everything or len(self.codes) > SPARSE:
            yield self.codes, self.counts
            self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for key, held in self.dense.items() if everything else ():
            at = np.flatnonzero(held)
            yield (key >> 32 << SIDE | at >> SIDE) << 32 | (key & 0xFFFFFFFF) << SIDE | at & (1 << SIDE) - 1, held[at]


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and ids of a batch of sequences, and the row of each."""
    at, ids = batch.column("at"), batch.column("id")
    return at.flatten().to_numpy(), ids.flatten().to_numpy(), np.repeat(np.arange(len(at)), np.diff(at.offsets.to_numpy()))


def _adjacent(at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where an id and the next one stand side by side in one row."""
    return np.flatnonzero((at[1:] == at[:-1] + 1) & (row[1:] == row[:-1]))


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tiles, held, n = Tiles(), [], 0

    def out(everything: bool) -> Iterator[pa.RecordBatch]:
        for codes, counts in tiles.take(everything):
            for i in range(0, len(codes), 100_000):
                part = codes[i : i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part >> 32), pa.array(part & 0xFFFFFFFF), pa.array(counts[i : i + 100_000])], names=["first", "last", "n"])

    for batch in small(batches):
        at, ids, row = _flat(batch)
        pair = _adjacent(at, row)
        held.append((ids[pair], ids[pair + 1]))
        n += len(pair)
        if n > AT_ONCE:
            tiles.add(*map(np.concatenate, zip(*held)))
            held, n = [], 0
            yield from out(False)
    if held:
        tiles.add(*map(np.concatenate, zip(*held)))
    yield from out(True)


def _sequences(rows: pa.Array, at: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    bounds = pa.array(np.r_[0, np.cumsum([len(x) for x in at])], pa.int32())
    flat = lambda xs, t: pa.array(np.concatenate([np.zeros(0, np.int64), *xs]), t)
    return pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(bounds, flat(at, pa.int32())), pa.ListArray.from_arrays(bounds, flat(ids, pa.int64()))], names=["row", "at", "id"])


def _ranked(df: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """df, stored, with id: 0, 1, .. by falling n, then keys. No task but a sort's sees more than its part."""
    order = [F.desc("n"), *keys]
    parts = save(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), tag)
    part = F.shiftright("_at", 33)
    sizes = parts.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # a row for each part
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    out = parts.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("id", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before")
    out._stored_at = parts._stored_at
    return out


def _check_ids(n: int) -> None:
    if n >= 1 << 31:
        raise ValueError("pairs of ids from 2**31 on don't fit in 64 bits")


def _gathered(found: DataFrame) -> DataFrame:
    """Sequences of the rows row, at, id."""
    listed = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("_ids"))
    return listed.select("row", F.col("_ids.at").alias("at"), F.col("_ids.id").alias("id"))


def _word_sequences(docs: DataFrame, words: DataFrame) -> DataFrame:
    """The places and ids of the frequent words of each document."""
    n, size = words.agg(F.count("*"), F.sum(F.length("word"))).first()
    _check_ids(n)
    if n <= SENT_WORDS and (size or 0) <= SENT_BYTES:
        known = words.select("lang", "word", "id").toArrow().combine_chunks().to_batches()
        sent = docs.sparkSession.sparkContext.broadcast(known)  # stays packed; a task only has the dictionaries besides

        class Ids(dict):
            def __missing__(self, word: bytes) -> int:
                return -1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids: dict[str, Ids] = defaultdict(Ids)
            for part in small(sent.value, 10_000):
                for lang, word, i in zip(*(part.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
                    ids[lang][word] = i
            for batch in small(batches):
                at, found = [], []
                for lang, text in _texts(batch):
                    text = [x for x in text if x]
                    every = np.fromiter(map(ids[lang].__getitem__, text), np.int64, len(text))
                    at.append(np.flatnonzero(every >= 0))
                    found.append(every[at[-1]])
                yield _sequences(batch.column("row"), at, found)

        return docs.mapInArrow(run, SEQUENCE)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for row, (lang, text) in zip(batch.column("row").to_pylist(), _texts(batch), strict=True):
                text = [x for x in text if x]
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(text), pa.int64()), pa.array(range(len(text)), pa.int32()), pa.array([lang] * len(text), pa.string()), pa.array(text, pa.binary())], names=["row", "at", "lang", "word"])

    return _gathered(join_first(docs.mapInArrow(spread, "row long, at int, lang string, word binary"), words.select("lang", "word", "n", "id"), ["lang", "word"], "n"))


def _pair_sequences(sequences: DataFrame, pairs: DataFrame) -> DataFrame:
    """The places and ids of the frequent pairs of each sequence."""
    n = pairs.count()
    _check_ids(n)
    if n <= SENT_PAIRS:
        known = pairs.select((F.shiftleft("first", 32) + F.col("last")).alias("code"), "id").orderBy("code").toArrow()
        sent = sequences.sparkSession.sparkContext.broadcast(tuple(known.column(c).to_numpy() for c in ("code", "id")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, new = sent.value
            for batch in small(batches):
                at, ids, row = _flat(batch)
                pair = _adjacent(at, row)
                code = ids[pair] << 32 | ids[pair + 1]
                place = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                good = codes[place] == code if len(codes) else np.zeros(len(code), bool)
                pair, place = pair[good], place[good]
                cuts = np.searchsorted(row[pair], np.arange(1, batch.num_rows))
                yield _sequences(batch.column("row"), np.split(at[pair], cuts), np.split(new[place], cuts))

        return sequences.mapInArrow(run, SEQUENCE)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            at, ids, row = _flat(batch)
            pair = _adjacent(at, row)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(row[pair])), pa.array(at[pair], pa.int32()), pa.array(ids[pair]), pa.array(ids[pair + 1])], names=["row", "at", "first", "last"])

    return _gathered(join_first(sequences.mapInArrow(spread, "row long, at int, first long, last long"), pairs.select("first", "last", "n", "id"), ["first", "last"], "n"))


def _joined(pairs: DataFrame, parts: DataFrame, tag: str) -> DataFrame:
    """Phrases from pairs of shorter ones that overlap (words: that follow each other): with their words and the counts of
    all their beginnings and ends, shortest first."""
    side = lambda x: maybe_broadcast(parts).select(F.col("id").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("lang", "phrase", "n", "heads", "tails")])
    both = pairs.join(side("first"), "first").join(side("last"), "last")
    last_word = F.substring_index("last_phrase", " ", -1)
    return save(both.select(
        "id", "first", "last", "n", F.col("first_lang").alias("lang"), F.concat_ws(" ", "first_phrase", last_word).alias("phrase"),
        F.array_append("first_heads", F.col("first_n")).alias("heads"), F.array_append("last_tails", F.col("last_n")).alias("tails"),
    ), tag)


def _scored(phrases: DataFrame, k: int) -> DataFrame:
    """lang, phrase, a, l, r and score of the worst cut of phrases of k words, in exact arithmetic."""

    def cut(j: int) -> Column:
        score = F.expr(f"CAST(n AS DECIMAL(20,0)) * 2000000 DIV (CAST(heads[{j - 1}] AS DECIMAL(20,0)) + CAST(tails[{k - j - 1}] AS DECIMAL(20,0)))")
        return F.struct(score.alias("score"), F.lit(j).alias("k"), F.get("heads", F.lit(j - 1)).alias("l"), F.get("tails", F.lit(k - j - 1)).alias("r"))

    worst = F.array_min(F.array(*[cut(j) for j in range(1, k)]))
    return phrases.withColumn("_cut", worst).select("lang", "phrase", F.col("n").alias("a"), F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), F.col("_cut.score").alias("score"))


def _outside(phrases: DataFrame, longer: DataFrame, inside: int) -> DataFrame:
    """Phrases without those that mostly occur inside one longer phrase. The next longer ones decide, since what
    holds of one that is longer still holds of the part of it that is one word longer."""
    most = longer.select("n", F.explode(F.array("first", "last")).alias("id")).groupBy("id").agg(F.max("n").alias("_most"))
    both = phrases.join(most, "id", "left")
    return both.filter(F.expr(f"_most IS NULL OR CAST(_most AS DECIMAL(20,0)) * 100 < CAST(n AS DECIMAL(20,0)) * {int(inside)}")).drop("_most")


def _best(rows: DataFrame, best: int) -> DataFrame:
    """The first rows of each language with their rank: first of parts of it, which are many even in one language, then of those."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    first = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("_nth", first).filter(F.col("_nth") <= best)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= best).drop("_part", "_nth")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, inside: int = INSIDE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to longest words of each language.

    Words are runs of characters other than blanks and tabs in the pieces that .,;:!? and line ends leave; A-Z are
    lower-cased. a counts a phrase's occurrences within pieces, overlapping ones too, l and r those of its parts at
    the cut of the lowest score, 2,000,000 a / (l + r), and n all words of the language. Phrases of fewer than least
    occurrences, and those of which inside hundredths or more lie in one longer phrase, are left out.

    A null text is empty, a null language is und; an empty table, or one without frequent phrases, gives no rows. Repeated
    rows count each, and further columns are not read. Ids have to stay below 2**31: more frequent phrases raise.
    """
    with batches_of(docs.sparkSession, ROWS):
        levels, counted = _levels(docs, least, longest)
    rows = None
    for k, phrases in enumerate(levels[1:], 2):
        scored = _scored(_outside(phrases, levels[k], inside) if k < longest else phrases, k)
        rows = scored if rows is None else rows.unionByName(scored)
    totals = maybe_broadcast(counted.filter("word IS NULL")).select("lang", F.col("n").alias("n"))
    return _best(rows, best).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _levels(docs: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1, 2, .. longest words, and the counts of words, all stored."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    counted = own.select("lang", "text").mapInArrow(_count_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = save(counted.filter((F.col("n") >= least) | F.col("word").isNull()), "words")
    words = _ranked(counted.filter("word IS NOT NULL"), ["lang", "word"], "ranked")
    none = F.array().cast("array<long>")
    levels = [save(words.select("id", "lang", F.col("word").cast("string").alias("phrase"), "n", none.alias("heads"), none.alias("tails")), "phrases")]
    sequences = save(_word_sequences(own, words), "sequences")
    for k in range(2, longest + 1):
        pairs = sequences.select("at", "id").mapInArrow(_count_pairs, "first long, last long, n long").groupBy("first", "last").agg(F.sum("n").alias("n"))
        pairs = _ranked(pairs.filter(F.col("n") >= least), ["first", "last"], "ranked")
        levels.append(_joined(pairs, levels[-1], "phrases"))
        if k < longest:
            sequences, done = save(_pair_sequences(sequences, pairs), "sequences"), sequences
            discard(done)
        discard(pairs)
    discard(words, sequences)
    return levels, counted
