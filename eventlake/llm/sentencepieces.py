"""Encoding and decoding by a SentencePiece model of merged pairs, with a table of merge types over prefixes.

Every prefix of a text that ends where a piece ends has one last piece in its own encoding. The table stores it: of the
pieces that an automaton finds to end at a place, it is the one that merging would leave apart from the last piece of
what stands before it. The ids are then read off backwards. Pieces never hold a blank after another character, so
that a text falls into units at its blanks, whose ids a task keeps.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import expand, mix, small

#: The character that stands for a blank in pieces.
BLANK = "▁"
#: Characters of a unit up to which a task keeps its ids, units that it keeps at most, and slots for tests of pairs (a power of two).
KEPT_UNIT, KEPT_UNITS, APART = 40, 500_000, 1 << 21
NEVER = float("-inf")
#: Letters and digits that may count as other characters when texts are cut into units.
ODD = 50
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """The vocabulary of a model: pieces with scores, bytes of characters without a piece, and what ids stand for."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model, kind = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto.SentencePiece
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        own, plain = model.normalizer_spec, model.trainer_spec
        if plain.model_type != plain.BPE or own.precompiled_charsmap or own.remove_extra_whitespaces or not (own.add_dummy_prefix and own.escape_whitespaces and plain.byte_fallback):
            raise ValueError("only pair-merging models with byte fallback, a leading blank and texts left as they are can be used")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces) or plain.treat_whitespace_as_suffix:
            raise ValueError("models with pieces of users, unused pieces or blanks at the end of words can't be used")
        self.end = SentencePieceProcessor(model_file=path).eos_id()
        self.ids, self.score, self.bytes, self.surface = {}, {}, {}, {}
        for i, p in enumerate(model.pieces):
            if p.type == kind.NORMAL:
                self.ids[p.piece], self.score[p.piece], self.surface[i] = i, p.score, p.piece.replace(BLANK, " ").encode()
            elif p.type == kind.BYTE:
                value = int(p.piece[3:-1], 16)
                self.bytes[value], self.surface[i] = i, bytes([value])
            else:  # an end or start; an unknown piece can't come up, as bytes are known
                self.surface[i] = b""
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece has a blank after another character")

    def merges(self, text: str) -> list[tuple[float, int, int]] | None:
        """Score, left and right start of the merges that make one piece of a text, in order; None if they don't."""
        parts, starts, out = list(text), list(range(len(text))), []
        while len(parts) > 1:
            found = [(-s, i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (s := self.score.get(a + b)) is not None]
            if not found:
                return None
            worst, i = min(found)
            out.append((-worst, starts[i], starts[i + 1]))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del starts[i + 1]
        return out


def units(pieces: Iterable[str]) -> re.Pattern:
    """What cuts texts where no piece goes on: before blanks, and where letters or digits meet other characters.

    Letters and digits of which a piece goes on with other characters count as such; if there are many, only blanks cut.
    """
    pairs, odd = {x + y for p in pieces for x, y in zip(p, p[1:]) if x != BLANK}, set()
    while new := {c for pair in pairs for c in pair if len({x.isalnum() and x not in odd for x in pair}) == 2 and c.isalnum() and c not in odd}:
        odd |= new
    if len(odd) > ODD:
        return re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
    other = "".join(map(re.escape, sorted(odd)))
    return re.compile(rf"{BLANK}*[^\W_{other}]+|{BLANK}*(?:[^\w{BLANK}]|[_{other}])+|{BLANK}+")


class Encoder(dict):
    """unit -> (number of ids, ids in decimal, decoded bytes); ids of a text by its units.

    A piece is named by its place among the pieces, a single character by their number plus its code.
    """

    def __init__(self, path: str):
        import ahocorasick

        super().__init__()
        self.pieces = known = Pieces(path)
        self.found = ahocorasick.Automaton()
        #: Of each usable piece the scores of its merges, with its first and its last part after each: the edges that a pair test meets.
        self.edges: dict[int, list[tuple[float, str, str]]] = {}
        self.names: list[str] = []
        for piece in known.ids:
            merged = known.merges(piece) if len(piece) > 1 else None
            if merged is None:  # a character, or a piece that merging never leaves
                continue
            starts, steps = set(range(len(piece))), []
            for score, _, right in merged:
                starts.discard(right)
                steps.append((score, piece[: min(starts - {0}, default=len(piece))], piece[max(starts) :]))
            self.edges[len(self.names)] = steps
            self.found.add_word(piece, len(self.names))
            self.names.append(piece)
        self.found.make_automaton()
        self.sizes = np.array([len(x) for x in self.names] or [0])
        self.units = units(known.ids)
        self.said: dict[int, tuple[int, bytes, bytes]] = {}
        self.apart_keys, self.apart = np.full(APART, -1), np.zeros(APART, bool)

    def name(self, part: int) -> str:
        return self.names[part] if part < len(self.names) else chr(part - len(self.names))

    def say(self, part: int) -> tuple[int, bytes, bytes]:
        """Number of ids of a piece or character, the ids in decimal and what they decode to."""
        got = self.said.get(part)
        if got is None:
            known, text = self.pieces, self.name(part)
            ids = [known.ids[text]] if text in known.ids else [known.bytes[x] for x in text.encode()]
            got = self.said[part] = len(ids), b" ".join(b"%d" % i for i in ids), b"".join(known.surface[i] for i in ids)
        return got

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether merging the text of a and b ends in a and b. Plays the merges of both in the order that they would have
        in one text, equal scores from the left, and looks for a better merge across the place where they meet."""
        score, left, right = self.pieces.score, self.edges.get(a, ()), self.edges.get(b, ())
        i = j = 0
        x, y = self.name(a)[-1], self.name(b)[0]
        while True:
            across = score.get(x + y, NEVER)
            first, second = left[i][0] if i < len(left) else NEVER, right[j][0] if j < len(right) else NEVER
            if across > first and across >= second:
                return False
            if first == second == NEVER:
                return True
            if first >= second:
                x, i = left[i][2], i + 1
            else:
                y, j = right[j][1], j + 1

    def stay_apart_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """stay_apart of many pairs; what was found before is looked up in a table of bounded size."""
        keys = a << 21 | b
        slots = (mix(keys.astype(np.uint64)) & np.uint64(APART - 1)).astype(np.int64)
        new = np.flatnonzero(self.apart_keys[slots] != keys)
        out = self.apart[slots]
        if len(new):
            pairs, place = np.unique(keys[new], return_inverse=True)
            found = np.array([self.stay_apart(k >> 21, k & 0x1FFFFF) for k in pairs.tolist()])
            out[new] = found[place]
            self.apart_keys[slots[new]], self.apart[slots[new]] = keys[new], found[place]
        return out

    def split(self, unit: str) -> list[int]:
        """The parts of one unit: the last part of every prefix, then backwards from the end."""
        ending = [[len(self.names) + ord(c)] for c in unit]
        for at, piece in self.found.iter(unit) if len(unit) > 1 else ():
            ending[at].append(piece)
        last: list[int] = []
        size = lambda part: len(self.names[part]) if part < len(self.names) else 1
        for at, candidates in enumerate(ending):
            for part in candidates:  # only one of them stays apart from what stands before it
                before = at - size(part)
                if before < 0 or self.stay_apart(last[before], part):
                    last.append(part)
                    break
        out, at = [], len(unit) - 1
        while at >= 0:
            out.append(last[at])
            at -= size(last[at])
        return out[::-1]

    def split_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """split of many short units, place by place for all of them at once: all parts, and where each unit's begin."""
        joined = "\0".join(units)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = np.array([len(x) for x in units])
        ends = np.cumsum(lengths + 1) - 2
        starts = ends - lengths + 1
        pieces = np.fromiter((at << 20 | piece for at, piece in self.found.iter(joined)), np.int64)
        at, part = np.r_[expand(starts, lengths), pieces >> 20], np.r_[codes[expand(starts, lengths)] + len(self.names), pieces & 0xFFFFF]
        size = np.ones(len(at), np.int64)
        size[len(at) - len(pieces) :] = self.sizes[pieces & 0xFFFFF]
        place = at - starts[np.searchsorted(starts, at, "right") - 1]
        by_place = np.argsort(place, kind="stable")
        cuts = np.r_[np.searchsorted(place[by_place], np.arange(lengths.max())), len(at)]
        last, sizes = np.zeros(len(codes), np.int64), np.ones(len(codes), np.int64)
        for low, high in zip(cuts, cuts[1:]):
            own = by_place[low:high]
            inner = size[own] <= place[own]
            good = np.ones(len(own), bool)
            good[inner] = self.stay_apart_all(last[at[own[inner]] - size[own[inner]]], part[own[inner]])
            own = own[good]
            last[at[own]], sizes[at[own]] = part[own], size[own]
        parts, owners, unit, now = [], [], np.arange(len(units)), ends
        while len(unit):
            parts.append(last[now])
            owners.append(unit)
            now = now - sizes[now]
            more = now >= starts[unit]
            unit, now = unit[more], now[more]
        owner = np.concatenate(owners[::-1])
        order = np.argsort(owner, kind="stable")
        return np.concatenate(parts[::-1])[order], np.searchsorted(owner[order], np.arange(len(units) + 1))

    def learn(self, units: Iterable[str]) -> None:
        """Keep what the units that are short enough give, so that texts can look them up."""
        new = [x for x in units if x not in self and len(x) <= KEPT_UNIT and "\0" not in x]
        if len(self) + len(new) > KEPT_UNITS:
            self.clear()
        for i in range(0, len(new), 20_000):
            parts, bounds = self.split_all(new[i : i + 20_000])
            kinds, place = np.unique(parts, return_inverse=True)
            counts, ids, decoded = zip(*map(self.say, kinds.tolist()))
            total, place, bounds = np.add.reduceat(np.array(counts)[place], bounds[:-1]).tolist(), place.tolist(), bounds.tolist()
            ids, decoded = [ids[x] for x in place], [decoded[x] for x in place]
            self.update(zip(new[i : i + 20_000], [(n, b" ".join(ids[low:high]), b"".join(decoded[low:high])) for n, low, high in zip(total, bounds, bounds[1:])]))

    def __missing__(self, unit: str) -> tuple[int, bytes, bytes]:
        own = [self.say(x) for x in self.split(unit)]
        return sum(x[0] for x in own), b" ".join([x[1] for x in own]), b"".join([x[2] for x in own])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """Of each text the number of ids with the end id, the ids in decimal, and what they decode to, in UTF-8.

        What a unit gives is looked up once in all the texts; texts are put together from that by columns.
        """
        cut = [self.units.findall(BLANK + x.replace(" ", BLANK)) if x else () for x in texts]
        bounds = np.r_[0, np.cumsum([len(x) for x in cut])]
        units = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        distinct, place = units.dictionary.to_pylist(), units.indices
        self.learn(distinct)
        counts, ids, decoded = zip(*map(self.__getitem__, distinct)) if distinct else ((), (), ())
        total = np.r_[0, np.cumsum(np.array(counts, np.int64)[place.to_numpy()])][bounds]

        def whole(parts: Iterable[bytes]) -> Iterator[bytes]:
            """The parts of each text, which lie behind each other in the column of all units' parts."""
            taken = pa.array(parts, pa.large_binary()).take(place)
            _, offsets, data = taken.buffers()
            data = memoryview(data) if data else b""
            at = np.frombuffer(offsets, np.int64, len(taken) + 1)[bounds].tolist() if len(taken) else [0] * len(bounds)
            return (bytes(data[low:high]) for low, high in zip(at, at[1:]))

        end = b"%d" % self.pieces.end
        ids, decoded = [x + end for x in whole([x + b" " for x in ids])], [x[1:] for x in whole(decoded)]  # without the blank that encoding put first
        return np.diff(total) + 1, ids, decoded


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the digest of each whole text's ids: n_tokens (with the end id), ids_sha256 (of decimal ids joined by
    one blank) and decoded_sha256 (of the text that the ids decode to).

    Null and empty texts have the end id alone and decode to an empty text. Rows are handled one by one, so repeated ids
    and texts give repeated rows, an empty table gives none, and further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(model_path)
        for batch in small(batches):
            counts, *found = known.encode(batch.column(1).to_pylist())
            digests = [pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()) for texts in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), *digests], names=[x.split()[0] for x in ENCODED.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ENCODED)
