"""Personal data: exact base patterns, and a skip-chain conditional random field that adds consistent mentions.

The nodes of the field are a document's tokens that hold a digit or an at sign. Neighbouring nodes share a chain
potential; distant nodes that repeat or resemble each other share a skip potential: numbers of equal last seven digits,
also where they are written in groups, addresses of one local part and first domain label, and equal dotted quads.
Base matches are observed; loopy belief propagation spreads their labels to what resembles them. All potentials are
fitted piecewise, as label counts by hashed token shape and context, by neighbouring pairs and by distant pairs that
are both observed; nodes that resemble a base match are left out of the first two, since their labels are unknown.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents that potentials are fitted on at most, the first in order of a hash of doc_id among those with nodes.
MAX_FITTED = 5_000
BUCKETS = 2_048
ROUNDS = 8
#: Added to the log potential of "none": without links a token has to be far likelier personal than not.
CAUTION = 4.0
#: Pairs of distant alike nodes with the same and with different labels that are assumed beside those counted: half
#: the log ratio of both is the log potential of equal labels, and its negative that of different ones.
ASSUMED_SAME, ASSUMED_DIFFERENT = 160_000, 1
#: Posterior from which a token that no pattern matched becomes a span.
SURE = 0.9

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")
_NODE = re.compile(r"[0-9@]")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_MARKS = "\"'()[]{}<>,;:!?."
_GROUP = re.compile(r"[0-9().+/-]*[0-9][0-9().+/-]*")
_NUMBERS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign has the longest run of local characters before it and the longest domain after it, if any."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and _LOCAL.match(text[low - 1]):
            low -= 1
        domain = _DOMAIN.match(text, at + 1) if low < at else None
        if domain:
            yield low, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of digits joined by single dots, taken four at a time from the left."""
    for run in _DOTTED.finditer(text):
        parts: list[tuple[int, int]] = []
        at = run.start()
        for part in run.group().split("."):
            if not part:
                parts = []
            else:
                parts.append((at, at + len(part)))
                if len(parts) == 4:
                    if all(len(x) <= 3 and int(x or 0) <= 255 for x in (text[a:b].lstrip("0") for a, b in parts)):
                        yield parts[0][0], parts[3][1]
                    parts = []
            at += len(part) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind (its place in KINDS), end of every base match, in order."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        found += [(a, 1, b) for a, b in ips(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := _NOT_DIGITS.sub("", m.group())) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def join_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


@dataclass
class Nodes:
    """A document's candidate tokens: places, observed labels (-1: none), feature buckets, linked pairs, and runs of number groups (-1: none)."""

    spans: list[tuple[int, int]]
    observed: np.ndarray
    buckets: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    run: np.ndarray


def _bucket(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}:{value}".encode("utf-8", "surrogatepass")) % BUCKETS


def alike(core: str, digits: str) -> str:
    """Key that a token shares with those that resemble it; empty for short numbers, which repeat by chance."""
    if "@" in core:
        local, _, domain = core.lower().rpartition("@")
        return f"{local}@{domain.split('.')[0]}"
    parts = _NUMBERS.findall(core)
    if len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts):
        return ".".join(str(int(x)) for x in parts)
    return digits[-7:] if len(digits) >= 7 else ""


def nodes(text: str, base: list[tuple[int, int, int]]) -> Nodes:
    spans, places, buckets, keys, numbers, run = [], [], [], [], [], []
    before, last_end = ["", ""], -2
    for place, m in enumerate(_TOKEN.finditer(text)):
        token = m.group()
        if _NODE.search(token):
            core = token.strip(_MARKS)
            start = m.start() + token.find(core) if core else m.start()
            digits = _NOT_DIGITS.sub("", core)
            group = bool(_GROUP.fullmatch(token))
            joins = group and run and run[-1] >= 0 and places[-1] == place - 1 and m.start() - last_end <= 1
            run.append(run[-1] if joins else len(spans) if group else -1)
            spans.append((start, start + len(core)))
            places.append(place)
            numbers.append(digits)
            shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", core))
            buckets.append([_bucket("shape", shape), _bucket("digits", f"{min(len(digits), 20)}{'@' in core}"), _bucket("before", before[1]), _bucket("second", before[0])])
            keys.append(alike(core, digits))
            last_end = m.end()
        before = [before[1], token.strip(_MARKS).lower()]
    observed = np.full(len(spans), -1, np.int64)
    at = 0
    for a, k, b in base:  # both are in order of start; a base span may cover several tokens
        while at and at < len(spans) and spans[at - 1][1] > a:
            at -= 1
        while at < len(spans) and spans[at][1] <= a:
            at += 1
        i, whole = at, _NOT_DIGITS.sub("", text[a:b])
        while i < len(spans) and spans[i][0] < b:
            if observed[i] < 0:
                observed[i] = k + 1
                if k >= 2:  # groups of one number have the key of the whole number
                    keys[i] = whole[-7:]
            i += 1
    i = 0
    while i < len(spans):  # groups of a number that no pattern matched, too
        j = i + 1
        while j < len(spans) and run[j] == run[i] >= 0:
            j += 1
        whole = "".join(numbers[i:j])
        if j - i > 1 and len(whole) >= 7:
            for x in range(i, j):
                if observed[x] < 0 and not keys[x]:
                    keys[x] = whole[-7:]
        i = j
    chain = [(i, i + 1) for i in range(len(spans) - 1) if places[i + 1] - places[i] <= 3]
    last: dict[str, int] = {}
    first: dict[str, int] = {}
    skip = set()
    for i, key in enumerate(keys):  # each repeat is linked to the one before it and to the first: linear in the repeats
        if not key:
            continue
        if key in last:  # groups of one number are no distant mentions of it
            skip.update((x, i) for x in {last[key], first[key]} if run[x] != run[i] or run[i] < 0)
        first.setdefault(key, i)
        last[key] = i
    pairs = lambda x: np.array(sorted(x), np.int64).reshape(-1, 2)
    return Nodes(spans, observed, np.array(buckets, np.int64).reshape(-1, 4), pairs(chain), pairs(skip), np.array(run, np.int64))


@dataclass
class Field:
    """Log potentials: unary by feature and bucket, and one table for each kind of link."""

    prior: np.ndarray
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(docs: DataFrame, max_fitted: int = MAX_FITTED) -> Field:
    """Piecewise potentials from at most max_fitted documents, whose base matches are the labels.

    Null texts, null doc_ids and documents without digits and at signs are left out; a repeated doc_id counts each time.
    """
    chosen = docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id").alias("h"), "doc_id").orderBy("h", "doc_id").limit(max_fitted)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                own = nodes(text, base_spans(text))
                label = np.maximum(own.observed, 0)
                unknown = np.zeros(len(label), bool)  # alike a base match but none itself
                for a, b in (own.skip.T, own.skip.T[::-1]):
                    unknown[b[(own.observed[a] >= 0) & (own.observed[b] < 0)]] = True
                for y, row, left_out in zip(label.tolist(), own.buckets.tolist(), unknown.tolist(), strict=True):
                    if left_out:
                        continue
                    counts[0, 0, y] += 1
                    for f, b in enumerate(row):
                        counts[1 + f, b, y] += 1
                links = own.chain[~unknown[own.chain].any(axis=1)]
                for a, b in zip(label[links[:, 0]].tolist(), label[links[:, 1]].tolist(), strict=True):
                    counts[5, a, b] += 1
                    counts[5, b, a] += 1
                for a, b in own.observed[own.skip].tolist():
                    if a >= 0 and b >= 0:
                        counts[6, 0, int(a == b)] += 1
        rows = [(*k, n) for k, n in counts.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["f", "b", "y", "n"])

    table = sample.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "f long, b long, y long, n long").groupBy("f", "b", "y").agg(F.sum("n").alias("n")).collect()  # at most 4 * BUCKETS * 5 rows
    size = len(LABELS)
    prior, unary, links, alike_pairs = np.ones(size), np.zeros((4, BUCKETS, size)), np.zeros((size, size)), [ASSUMED_DIFFERENT, ASSUMED_SAME]
    for f, b, y, n in table:
        if f == 0:
            prior[y] += n
        elif f < 5:
            unary[f - 1, b, y] += n
        elif f == 5:
            links[b, y] += n
        else:
            alike_pairs[y] += n
    p = prior / prior.sum()
    weight = np.array([1.0, 1.0, 0.5, 0.25]).reshape(4, 1, 1)  # shape and size speak louder than context
    unary = weight * (np.log(unary + 2 * p) - np.log(unary.sum(axis=2, keepdims=True) + 2) - np.log(p))
    joint = links + 20 * np.outer(p, p) + 4 * np.diag(p)
    own = joint / joint.sum()
    edge = np.log(own) - np.log(own.sum(axis=1, keepdims=True)) - np.log(own.sum(axis=0, keepdims=True))
    agree = 0.5 * float(np.log(alike_pairs[1] / alike_pairs[0]))
    return Field(np.log(p), unary, np.clip(0.5 * edge, -2, 2), np.where(np.eye(size, dtype=bool), agree, -agree))


def posterior(own: Nodes, field: Field) -> np.ndarray:
    """Label marginals by loopy belief propagation; observed nodes are held to their labels."""
    size = len(LABELS)
    local = field.prior + sum(field.unary[f, own.buckets[:, f]] for f in range(4))
    local[:, 0] += CAUTION
    known = own.observed >= 0
    local[known] = -50.0
    local[known, own.observed[known]] = 0.0
    ends = np.concatenate([own.chain, own.skip])
    if len(ends):
        tables = np.concatenate([np.repeat(field.chain[None], len(own.chain), 0), np.repeat(field.skip[None], len(own.skip), 0)])
        source, target = np.r_[ends[:, 0], ends[:, 1]], np.r_[ends[:, 1], ends[:, 0]]
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.r_[np.arange(len(ends)) + len(ends), np.arange(len(ends))]
        message = np.zeros((len(source), size))
        for _ in range(ROUNDS):
            into = np.zeros_like(local)
            np.add.at(into, target, message)
            sent = (local + into)[source] - message[back]
            joint = sent[:, :, None] + tables
            top = joint.max(axis=1)
            new = top + np.log(np.exp(joint - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            if np.abs(new - message).max() < 1e-3:
                break
            message = 0.5 * message + 0.5 * new
        into = np.zeros_like(local)
        np.add.at(into, target, message)
        local = local + into
    local = np.exp(local - local.max(axis=1, keepdims=True))
    return local / local.sum(axis=1, keepdims=True)


def added_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """Spans of tokens that no base pattern matched and that the field labels with posterior SURE or more."""
    own = nodes(text, base)
    if not len(own.spans) or (own.observed >= 0).all():
        return []
    p = posterior(own, field)
    best = p.argmax(axis=1)
    chosen = np.flatnonzero((own.observed < 0) & (best > 0) & (p.max(axis=1) >= SURE))
    found: list[tuple[int, int, int]] = []
    last = -2
    for i in chosen.tolist():
        a, b = own.spans[i]
        if b > a:
            if found and last == i - 1 and own.run[i] == own.run[last] >= 0 and found[-1][1] == best[i] - 1:
                a = found.pop()[0]  # groups of one number are one span
            found.append((a, int(best[i]) - 1, b))
            last = i
    return found


def find(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of docs: doc_id, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans, n_spans (of all spans).

    Null and empty texts have no spans; rows of a null or repeated doc_id are scanned each, other columns are ignored,
    whatever their names, and an empty table gives no rows. Places are code points, ends are exclusive.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = defaultdict(list)
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                n = Counter(k for _, k, _ in base)
                for k, kind in enumerate(KINDS):
                    out[f"n_{kind}"].append(n[k])
                out["base_sha256"].append(hashlib.sha256(join_spans(base).encode()).hexdigest() if base else empty)
                more = added_spans(text, base, sent.value) if _NODE.search(text) else []
                out["spans"].append(join_spans(base + more))
                out["n_spans"].append(len(base) + len(more))
            numbers = [pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS]
            columns = [*numbers, *(pa.array(out[x], pa.string()) for x in ("base_sha256", "spans")), pa.array(out["n_spans"], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_spans"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
