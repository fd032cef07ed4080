"""Collocations against brute force, on every way of counting and looking up."""

import collections
import random
import re
import tracemalloc

import numpy as np
import pytest

from eventlake.llm import phrases

DOCS = "doc_id long, text string, lang string, phrase string, n long, id long, row string"


def brute(rows, least, longest, best, inside):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    gone = {(lang, w[i : i + k]) for (lang, w), a in found.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= inside * found[lang, w[i : i + k]]}
    out = []
    for lang in total:
        own = []
        for (x, w), a in found.items():
            if x == lang and (x, w) not in gone:
                score, _, l, r = min((2_000_000 * a // (counts[x, w[:k]] + counts[x, w[k:]]), k, counts[x, w[:k]], counts[x, w[k:]]) for k in range(1, len(w)))
                own.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:best], 1)]
    return sorted(out)


def corpus(n=400):
    r = random.Random(8)
    words = ["the", "of", "New", "york", "city", "hall", "é", "x-y", "Ünter", "a\x00b", "\x1c", "in", "spite"]
    rows = [(None, "in spite of " * 7), ("", "in spite of. " * 40), ("en", None), ("en", ""), ("fr", " \t\n"), ("en", "of the " * 900), ("en", "of the " * 900)]
    for i in range(n):
        text = [r.choice(["new york city hall", "in spite of", "in\tspite", *words]) for _ in range(r.choice((1, 3, 40)))]
        rows.append((r.choice(["en", "en", "de", None]), "".join(w + r.choice([" ", " ", " ", "  ", ", ", ".\n", "? "]) for w in text)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"SENT_WORDS": 0}, {"SENT_PAIRS": 0}, {"SENT_BYTES": 0, "SENT_PAIRS": 3, "HELD_WORDS": 5}, {"DENSE": 2, "SIDE": 1, "DENSE_TILES": 3, "SPARSE": 4, "AT_ONCE": 50}, {"PARTS": 1}])
def test_collocations(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    rows = corpus()
    docs = spark.createDataFrame([(1, text, lang, "p", 2, 3, "r") for lang, text in rows], DOCS).repartition(3)
    for least, longest, best, inside in ((30, 4, 2000, 80), (5, 3, 4, 50), (2, 2, 3, 100)):
        got = phrases.collocations(docs, least, longest, best, inside)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        want = brute(rows, least, longest, best, inside)
        assert sorted(map(tuple, got.collect())) == want and want
        if limits:
            break


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "p", 2, 3, "r"), (2, None, None, None, None, None, None)], DOCS)
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_scores_past_64_bits(spark):
    big = 9_000_000_000_000_000_000
    rows = spark.createDataFrame([(0, "en", "a b", big, [big], [big]), (1, "en", "a c", big - 1, [big], [big])], "id long, lang string, phrase string, n long, heads array<long>, tails array<long>")
    got = {r["phrase"]: r["score"] for r in phrases._scored(rows, 2).collect()}
    assert got == {"a b": 1_000_000, "a c": 2_000_000 * (big - 1) // (2 * big)}
    longer = spark.createDataFrame([(0, 1, big // 10 * 8)], "first long, last long, n long")
    assert [r["id"] for r in phrases._outside(rows, longer, 80).collect()] == []
    longer = spark.createDataFrame([(0, 1, big // 10 * 8 - 1)], "first long, last long, n long")
    assert sorted(r["id"] for r in phrases._outside(rows, longer, 80).collect()) == [0, 1]


def test_tiles_count_like_a_dictionary(monkeypatch):
    monkeypatch.setattr(phrases, "DENSE", 40)
    monkeypatch.setattr(phrases, "DENSE_TILES", 2)
    r, want, got, tiles = np.random.default_rng(2), collections.Counter(), collections.Counter(), phrases.Tiles()
    for _ in range(5):
        a, b = (r.zipf(1.3, 3000) % 5000 for _ in range(2))
        want.update(zip(a.tolist(), b.tolist()))
        tiles.add(a, b)
    for codes, counts in tiles.take(True):
        for code, n in zip(codes.tolist(), counts.tolist()):
            got[code >> 32, code & 0xFFFFFFFF] += n
    assert got == want and len(tiles.dense) == 2


def test_what_tasks_hold_stays_small(spark, monkeypatch):
    r = np.random.default_rng(5)
    parts = [r.integers(0, 1 << 20, (2, phrases.AT_ONCE)) for _ in range(4)]
    tiles = phrases.Tiles()
    tracemalloc.start()
    for a, b in parts:
        tiles.add(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(tiles.codes) > phrases.SPARSE and most < 100e6

    sizes = spark.sparkContext.accumulator(0)
    small = phrases.small
    monkeypatch.setattr(phrases, "small", lambda batches, rows=1_000: small((sizes.add(b.num_rows > 50) or b for b in batches), rows))
    monkeypatch.setattr(phrases, "ROWS", 50)
    monkeypatch.setattr(phrases, "SENT_WORDS", 0)  # what is broadcast comes through small() too
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = spark.createDataFrame([("en", "a b c d " * 3)] * 1000, "lang string, text string").coalesce(1)
    assert phrases.collocations(docs).count() and not sizes.value
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
