"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

A lexicon is learnt from one part of the labelled rows, the trees from a second and the calibration from a
third, so that no part judges what it was chosen on. Labelled rows are bounded by MAX_LABELLED; scoring reads
every text whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, save, small

#: Labelled documents that a model is fitted on at most, the first in order of a hash of doc_id.
MAX_LABELLED = 20_000
#: Words that a learnt lexicon has at most.
MAX_LEXICON = 300
#: Words that a task remembers at once, beyond those of one text.
CACHE = 100_000

#: Second-person words.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure tu te toi ton ta tes vous votre vos ti tus tuyo vosotros usted ustedes".split())
#: What obfuscating characters stand for.
LEET = str.maketrans("013457@$!|", "oieastasil")
_EDGES = re.compile(r"^\W+|\W+$")
_INNER = re.compile(r"[\W_]+")
_RUNS = re.compile(r"(.)\1{2,}")

FEATURES = ("log_words", "lexicon", "lexicon_weight", "lexicon_max", "log_hits", "hidden_hits", "second_person", "proximity", "upper", "shouted", "marks", "repeated_marks", "obfuscated", "digits", "symbols", "word_length", "letters", "distinct")


def normalise(word: str) -> tuple[str, str, bool]:
    """A word in lower case without marks at its ends, the same with disguises undone, and whether they differ."""
    plain = word.lower() if word.isalpha() else _EDGES.sub("", word).lower()
    if plain.isalpha():
        open_form = _RUNS.sub(r"\1", plain)
        return plain, open_form, open_form != plain
    mixed = any(c.isalpha() for c in plain)
    open_form = _RUNS.sub(r"\1", _INNER.sub("", plain.translate(LEET))) if mixed else plain
    return plain, open_form, mixed


class WordFeatures(dict):
    """word -> row of a table of per-word features; words of equal features share a row. Starts anew when full."""

    COLUMNS = 12

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon, self.rows = lexicon, np.zeros((1024, self.COLUMNS), np.float32)
        self.known: dict[tuple, int] = {}

    def room(self, n: int) -> None:
        """Start anew unless the next n words fit; only called between texts."""
        if len(self) + n > CACHE:
            self.clear()
            self.known.clear()

    def row(self, values: tuple) -> int:
        at = self.known.get(values)
        if at is None:
            at = self.known[values] = len(self.known)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[at] = values
        return at

    def __missing__(self, word: str) -> int:
        plain, open_form, hidden = normalise(word)
        weight = self.lexicon.get(plain, 0.0)
        disguised = 0.0 if weight else self.lexicon.get(open_form, 0.0) if hidden else 0.0
        letters, digits, marks = len(word), 0, 0
        if not word.isalpha():
            letters, digits, marks = sum(map(str.isalpha, word)), sum(map(str.isdigit, word)), word.count("!") + word.count("?")
        upper = 0 if word.islower() else sum(map(str.isupper, word))
        self[word] = at = self.row((
            float(weight > 0 or disguised > 0), max(weight, disguised), float(disguised > 0), float(plain in SECOND_PERSON),
            upper, float(letters > 2 and upper == letters), marks, float(marks > 1), float(hidden), digits, len(word) - letters - digits, len(word),
        ))
        return at


def features(text: str | None, table: WordFeatures) -> np.ndarray:
    """The dense features of a whole text; an empty one has zeros."""
    words = (text or "").split()
    out = np.zeros(len(FEATURES), np.float64)
    if not words:
        return out
    n = len(words)
    table.room(n)
    at = np.fromiter(map(table.__getitem__, words), np.int64, n)
    rows = table.rows[at]
    total = rows.sum(axis=0, dtype=np.float64)
    chars = total[11]
    hits, second = np.flatnonzero(rows[:, 0]), np.flatnonzero(rows[:, 3])
    near = 0
    if len(hits) and len(second):
        next_one = np.searchsorted(second, hits)
        gaps = np.minimum(np.abs(second[np.minimum(next_one, len(second) - 1)] - hits), np.abs(hits - second[np.maximum(next_one - 1, 0)]))
        near = int((gaps <= 5).sum())
    letters = max(chars - total[9] - total[10], 0)
    out[:] = (
        np.log1p(n), total[0] / n, total[1] / n, rows[:, 1].max(), np.log1p(total[0]), total[2] / n, total[3] / n, near / n,
        total[4] / max(letters, 1), total[5] / n, total[6] / n, total[7] / n, total[8] / n, total[9] / chars, total[10] / chars,
        chars / n, letters / chars, len(set(words)) / n,
    )
    return out


@dataclass
class Trees:
    """Boosted complete binary trees: split features and thresholds by node, values by leaf."""

    base: float
    depth: int
    split: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        every = np.arange(len(x))
        for split, threshold, leaf in zip(self.split, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[every, split[node]] > threshold[node])
            total += leaf[node - (2**self.depth - 1)]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 2.0) -> Trees:
    """Gradient boosting on logistic loss over quantile bins, with second-order gains."""
    p = min(max(float(y.mean()), 1e-4), 1 - 1e-4) if len(y) else 0.01
    base = float(np.log(p / (1 - p)))
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if len(y) < 20 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)  # bin b: at most cuts[b]
    raw, found = np.full(len(y), base), []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        g, h = y - q, np.maximum(q * (1 - q), 1e-6)
        node = np.zeros(len(y), np.int64)
        split, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(width)
            chosen = np.full(width, bins, np.int64)
            gs, hs = np.bincount(local, g, width), np.bincount(local, h, width)
            whole = gs**2 / (hs + 1)
            for j, c in enumerate(cuts):
                key = local * bins + binned[:, j]
                gl = np.bincount(key, g, width * bins).reshape(width, bins).cumsum(axis=1)[:, : len(c)]
                hl = np.bincount(key, h, width * bins).reshape(width, bins).cumsum(axis=1)[:, : len(c)]
                if not len(c):
                    continue
                gain = gl**2 / (hl + 1) + (gs[:, None] - gl) ** 2 / (hs[:, None] - hl + 1) - whole[:, None]
                gain[(hl < least) | (hs[:, None] - hl < least)] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best + 1e-9
                best[better], chosen[better] = value[better], top[better]
                split[first : first + width][better] = j
                threshold[first : first + width][better] = c[top[better]]
            right = x[np.arange(len(y)), split[node]] > threshold[node]
            node = 2 * node + 1 + right
        local = node - inner
        leaf = rate * np.bincount(local, g, leaves) / (np.bincount(local, h, leaves) + 1)
        raw += leaf[local]
        found.append((split, threshold, leaf))
    return Trees(base, depth, *(np.stack(z) for z in zip(*found, strict=True)))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing scores and the calibrated probabilities at them."""
    if not len(y) or y.min() == y.max():
        return np.zeros(0), np.zeros(0)
    order = np.argsort(raw, kind="stable")
    values, starts = np.unique(raw[order], return_index=True)
    weights = np.diff(np.r_[starts, len(y)]).astype(float)
    means = np.add.reduceat(y[order].astype(float), starts) / weights
    blocks: list[list[float]] = []
    for v, m, w in zip(values, means, weights, strict=True):
        blocks.append([m, w, v, v])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, _, high = blocks.pop()
            m1, w1, low, _ = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, low, high])
    xs, ps = [], []
    for m, _, low, high in blocks:
        xs += [low, high]
        ps += [m, m]
    return np.array(xs), np.array(ps)


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees
    at: np.ndarray
    probability: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.trees.raw(x)
        plain = 1 / (1 + np.exp(-raw))
        if not len(self.at):
            return plain
        return np.clip(0.98 * np.interp(raw, self.at, self.probability) + 0.02 * plain, 0, 1)  # the rest keeps the order within a step


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words whose document counts speak for label 1: at most MAX_LEXICON, with their log odds; words come in their open forms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, toxic = [], []
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = {x for w in set((text.as_py() or "").split()) for x in normalise(w)[:2] if len(x) > 1}
                words += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], names=["word", "toxic"])

    totals = labelled.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    t, n = totals["t"] or 0, totals["n"]
    counted = labelled.select("text", "toxic").mapInArrow(run, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (t + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (n - t + 1))
    counted = counted.filter(F.col("t") >= F.lit(max(3, 0.01 * t))).withColumn("odds", odds).filter("odds > 2")
    rows = counted.orderBy(F.desc(F.col("odds") * F.sqrt("t")), "word").limit(MAX_LEXICON).collect()
    return {r["word"]: float(r["odds"]) for r in rows}


def table_of(batch: pa.RecordBatch, table: WordFeatures) -> np.ndarray:
    """Features of the texts of a batch, one row each."""
    out = np.zeros((batch.num_rows, len(FEATURES)))
    for i, text in enumerate(batch.column("text")):
        out[i] = features(text.as_py(), table)
    return out


def extract(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """fold, toxic and x, the features of every row's text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordFeatures(sent.value)
        for batch in small(batches):
            x = pa.FixedSizeListArray.from_arrays(pa.array(table_of(batch, table).ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("toxic"), x], names=["fold", "toxic", "x"])

    return docs.select("fold", "toxic", F.col("text").cast("string").alias("text")).mapInArrow(run, "fold int, toxic int, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model of labels.toxic, from the documents that labels has: at most max_labelled, in order of a hash of doc_id.

    Null labels and labels without a document are ignored, a label above 0 counts as 1, and of several labels of a
    document the largest counts; a doc_id that documents repeat gives each of its texts the label. Without both labels
    every score is the labels' base rate. Null texts count as empty; clashing column names don't matter.
    """
    chosen = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    fold = F.pmod(F.xxhash64(F.lit(7), F.col("doc_id")), F.lit(10)).cast("int")
    labelled = save(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", fold.alias("fold")), "labelled")
    lexicon = learn_lexicon(labelled.filter("fold < 4"))
    rows = extract(labelled.filter("fold >= 4"), lexicon).toArrow()
    discard(labelled)
    x = np.array(rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, len(FEATURES))
    y, part = rows.column("toxic").to_numpy().astype(np.float64), rows.column("fold").to_numpy()
    trees = fit_trees(x[part < 8], y[part < 8])
    return Model(lexicon, trees, *isotonic(trees.raw(x[part >= 8]), y[part >= 8]))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """One row per row of docs: doc_id, score, predicted, in one pass. Only text is read for the score.

    Null and empty texts have all features 0 and are scored too; rows with a null or repeated doc_id are scored each.
    Other columns are ignored, whatever their names; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordFeatures(sent.value.lexicon)
        for batch in small(batches):
            p = sent.value.score(table_of(batch, table))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int")
