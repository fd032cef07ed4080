"""The corpus operators against brute force on small fixtures with nulls, blanks, ties, repeats and clashing columns."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import common, decontaminate, jaccard, langid, license, packing, pii, queries, repeats, topk, toxicity

from eventlake.llm.common import ItemHashes

from ..compare import DATA, same

DOCS = "doc_id long, text string, lang string, source string, n_chars long, w string, key string, label int"


def frame(spark, texts):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "w", "k", 1) for i, t in enumerate(texts)], DOCS)


def corpus(seed=1, n=60):
    r = random.Random(seed)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "tu", "Re") for b in ("n", "s", "ra", "é", "x,")]
    base = [" ".join(r.choices(vocabulary, k=r.choice((1, 3, 7, 60, 130, 300)))) for _ in range(n)]
    passage = " ".join(r.choices(vocabulary, k=55))
    out = [None, "", "  \n ", "word", "word", "Word", "two words", "a\tb\x0bc\x0cd e", "x " * 70, "x " * 140]
    for t in base:
        out.append(t)
        k = r.random()
        if k < 0.15:
            out.append(t)
        elif k < 0.5 and len(t.split()) > 50:
            words = t.split()
            words[len(words) // 2] = "changed"
            out.append(" ".join(words))
        elif k < 0.65:
            out.append(f"{t} {passage} {t[::-1]}")
    out.append("lang " * 30_000)
    r.shuffle(out)
    return out


# 1 ---------------------------------------------------------------------------------------------------------------


def base_by_regex(text):
    """The base kinds, straight from their definitions."""
    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, pattern in enumerate(kinds):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and max(map(int, m.group().split("."))) > 255 or k == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)) or k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_definitions():
    r = random.Random(3)
    parts = ["a@b.c", "@", "x.y@z-1.de.", "1.2.3.4", "256.1.1.1", "1..2", ".", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (377) 555-0271", "+", "0", "12345678901234", " ", "é", "5", "-", "+49 30 1234567", "a+b@c", "..", "001.002.003.004.5"]
    for _ in range(4000):
        t = "".join(r.choices(parts, k=r.randint(1, 9)))
        assert pii.base_spans(t) == base_by_regex(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 300_000 + "@", "1" * 300_000, "1." * 100_000, "+1" * 100_000, "@" * 200_000):
        pii.base_spans(t)


def test_pii_field_adds_consistent_mentions(spark):
    filler = "some words between the two "
    texts = [f"call +1 (377) 555-0{i:03d} now {filler * 20} again 377-555-0{i:03d} please" for i in range(200, 300)] + ["room 12 and 1999", None, "", "mail me at a.b@example.org or a.b@example.org ok"]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in pii.find(docs, pii.fit(docs)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        base = base_by_regex(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(pii.join_spans(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(1 for x in base if x[1] == j) for j in range(4)]
        assert {x for x in pii.join_spans(base).split(",") if x} <= set(got[i]["spans"].split(","))
    added = [len(got[i]["spans"].split(",")) for i in range(100)]
    assert sum(n == 2 for n in added) >= 95  # the bare repeat of each number is labelled too
    assert got[100]["spans"] == ""


def test_pii_links_groups_and_altered_addresses(spark):
    filler = "some words between the two "
    texts = [f"call +49 30 {i} 45 67 now {filler * 20} again 030 {i} 45 67 or {i}4567 please" for i in range(200, 260)]
    texts += [f"mail ann.{i}@example.org {filler * 10} that is Ann.{i}@example ok" for i in range(60)]
    texts += [f"host 10.0.{i}.7 {filler * 10} host 10-0-{i}-7 ok" for i in range(60)]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r for r in pii.find(docs, pii.fit(docs)).collect()}
    for i, t in enumerate(texts):
        base = base_by_regex(t)
        spans = got[i]["spans"].split(",")
        assert {x for x in pii.join_spans(base).split(",") if x} <= set(spans) and got[i]["n_spans"] == len(spans)
    added = [sorted(set(got[i]["spans"].split(",")) - set(pii.join_spans(base_by_regex(texts[i])).split(","))) for i in range(180)]
    words = [[texts[i][int(x.split(":")[1]) : int(x.split(":")[2])] for x in added[i]] for i in range(180)]
    assert sum({f"030 {i + 200} 45 67", f"{i + 200}4567"} <= set(words[i]) for i in range(60)) >= 55
    assert sum(f"Ann.{i}@example" in words[60 + i] for i in range(60)) >= 55
    assert sum(f"10-0-{i}-7" in words[120 + i] for i in range(60)) >= 55


def exact_marginals(own, field):
    """Marginals by the sum over all labellings."""
    size, n = len(pii.LABELS), len(own.spans)
    local = field.prior + sum(field.unary[f, own.buckets[:, f]] for f in range(4))
    local[:, 0] += pii.CAUTION
    total = np.zeros((n, size))
    for labels in itertools.product(range(size), repeat=n):
        if any(o >= 0 and o != y for o, y in zip(own.observed, labels, strict=True)):
            continue
        w = sum(local[i, y] for i, y in enumerate(labels) if own.observed[i] < 0)
        w += sum(field.chain[labels[a], labels[b]] for a, b in own.chain) + sum(field.skip[labels[a], labels[b]] for a, b in own.skip)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(w)
    return total / total.sum(axis=1, keepdims=True)


def test_belief_propagation_against_exact_marginals(monkeypatch):
    r = np.random.default_rng(4)
    monkeypatch.setattr(pii, "ROUNDS", 60)
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    for links, skips, close in (([(0, 1), (1, 2), (2, 3)], [], 0.01), ([(0, 1), (2, 3)], [(0, 3)], 0.01), ([(0, 1), (1, 2), (2, 3)], [(0, 3)], 0.1)):
        for _ in range(10):
            edge, agree = r.normal(size=(5, 5)) * 0.5, np.where(np.eye(5, dtype=bool), 1.0, -1.0)
            field = pii.Field(np.log(r.dirichlet(np.ones(5))), r.normal(size=(4, pii.BUCKETS, 5)) * 0.3, (edge + edge.T) / 2, agree)
            observed = np.array([r.integers(1, 5), -1, -1, -1])
            own = pii.Nodes([(i, i + 1) for i in range(4)], observed, r.integers(0, pii.BUCKETS, (4, 4)), pairs(links), pairs(skips), np.full(4, -1))
            assert np.abs(pii.posterior(own, field) - exact_marginals(own, field)).max() < close


def test_pii_of_odd_rows(spark):
    docs = frame(spark, ["a@b.cd", None, "", "a@b.cd"]).withColumn("doc_id", F.expr("nullif(doc_id % 3, 1)")).withColumn("spans", F.lit("x"))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_email"], r["spans"]) for r in pii.find(docs, pii.fit(docs)).collect())
    assert got == [(False, 0, 1, "email:0:6"), (False, 0, 1, "email:0:6"), (False, 2, 0, ""), (True, 0, 0, "")]


def test_pii_on_an_empty_table(spark):
    docs = frame(spark, ["x"]).limit(0)
    assert pii.find(docs, pii.fit(docs)).count() == 0


# 2 ---------------------------------------------------------------------------------------------------------------


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def components_by_force(texts):
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in range(len(texts))}


def test_near_duplicates(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    family = []
    seed = r.choices(words, k=120)
    for _ in range(40):  # a chain of near copies: neighbours link, the ends don't
        seed = list(seed)
        seed[r.randrange(120)] = r.choice(words)
        family.append(" ".join(seed))
    texts = corpus(2) + family
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.near_duplicates(frame(spark, texts)).collect()}
    assert got == components_by_force(texts)


def test_near_duplicates_of_one_large_family(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    r = random.Random(15)
    words = [f"w{i}" for i in range(500)]
    seed, texts = r.choices(words, k=150), []
    for i in range(300):  # near copies of one text, and texts that share only its beginning
        own = list(seed) if i % 3 else seed[:60] + r.choices(words, k=90)
        for _ in range(r.randrange(1, 4)):
            own[r.randrange(150)] = r.choice(words)
        texts.append(" ".join(own))
    folder = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.near_duplicates(frame(spark, texts)).collect()}
    assert got == components_by_force(texts)
    assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} == {"reps", "sizes", "labels"}  # what the result reads


def test_chunks_without_possible_partners_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    like = jaccard.Similarity()
    labels = spark.createDataFrame([], "id long, label long")
    pairs = []
    for at in (15, 5):  # texts of 100 n-grams: after 15 that are not shared, no more than 85 can be
        hot = spark.range(200).selectExpr("7L AS key", "id AS rep", "100 AS n", f"IF(id < 190, {at}, 0) AS at")
        pairs.append(jaccard.open_chunks(hot, labels, like)[0].select("block").distinct().count())
    assert pairs[0] <= 3 * 8 and pairs[1] > 250  # 25 chunks
    r = random.Random(31)
    texts, words = [], [f"w{i}" for i in range(300)]
    seed = r.choices(words, k=90)
    for _ in range(250):  # few links in a large family: mostly too many changes
        own = list(seed)
        for _ in range(r.choice((1, 2, 3, 3, 4, 4, 5))):
            own[r.randrange(90)] = f"new{r.randrange(10**6)}"
        texts.append(" ".join(own[: r.randrange(70, 91)]))
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in jaccard.near_duplicates(frame(spark, texts)).collect()}
    assert got == components_by_force(texts) and 2 < len({x for _, x in got.values()}) < 250


def test_blocks_are_bounded_however_hot_a_key_is(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    keys = spark.range(4000).selectExpr("CASE WHEN id % 4 < 3 THEN -7 ELSE id END AS key", "id AS rep", "CAST(100 + id % 50 AS int) AS n")
    found = jaccard.blocks(keys, jaccard.Similarity())
    assert found.filter("key = -7").select("rep").distinct().count() == found.filter("key = -7").count() == 3000
    assert found.groupBy("block").count().agg(F.max("count")).first()[0] <= 8


def test_fine_overlaps_equal_multiset_intersections():
    r = np.random.default_rng(3)
    sets = [np.sort(r.integers(0, 300, r.integers(0, 400))).astype(np.uint16) * np.uint16(200) for _ in range(9)]
    got = jaccard.fine_overlaps(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == (collections.Counter(a.tolist()) & collections.Counter(b.tolist())).total()


def test_item_hashes_tell_items_apart():
    hashes, texts = ItemHashes(1), ["", None, "a b  a\tc\x0bé", " x ", "a\n b c \n\n\r\na", "a", "A"]
    column = pa.array(["skipped", *texts])[1:]
    for found, items in ((hashes.words(column), [repeats.words((t or "").encode()) for t in texts]), (hashes.lines(column), [repeats.lines((t or "").encode()) for t in texts])):
        assert np.diff(found.bounds).tolist() == [len(x) for x in items]
        flat = [x for y in items for x in y]
        seen = {}
        for h, x in zip(found.hashes.tolist(), flat, strict=True):
            assert seen.setdefault(h, x) == x
        assert len(seen) == len(set(flat))
    assert hashes.lines(column).sizes.tolist() == [5, 1, 1, 2, 1, 1, 1]
    low = ItemHashes(1, lower=True).words(pa.array(["Ab É", "aB É", "aB é"])).hashes
    assert low[0] == low[2] == low[4] and low[1] == low[3] != low[5]


def thue_morse(n):
    """Two texts of n letters whose sums by powers of any odd base are equal modulo 2**64 from some 1,024 letters on."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_items_that_collide_as_polynomials(spark):
    a, b = thue_morse(2048)
    found = ItemHashes(1).words(pa.array([f"{a} {b} {a[1:]}"]))
    assert len(set(found.hashes.tolist())) == len(set(found.second.tolist())) == 3
    rest = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [f"{a} {rest}", f"{b} {rest[:-4]}"])
    got = repeats.substring_dedup(docs).orderBy("doc_id").collect()
    assert [x["n_removed"] for x in got] == [0, len(rest[:-4].split())]  # the rest repeats, the first word does not
    got = repeats.substring_dedup(frame(spark, [" ".join([a, *["x"] * 10, *rest.split()[:39]]), " ".join([b, *["x"] * 10, *rest.split()[:39]])])).orderBy("doc_id").collect()
    assert [x["n_removed"] for x in got] == [0, 0]
    got = repeats.line_dedup(frame(spark, [f"{a}\n{a} x\nend", f"{b}\n{b} x\nend"])).orderBy("doc_id").collect()
    assert [x["n_removed"] for x in got] == [0, 0]
    got = jaccard.near_duplicates(frame(spark, [a, b, f"{a} {a} {a} {a} {a}", f"{b} {b} {b} {b} {b}"])).orderBy("doc_id").collect()
    assert [x["component_id"] for x in got] == [0, 1, 2, 3]


def test_near_duplicates_of_nothing(spark):
    assert jaccard.near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0
    assert [tuple(x) for x in jaccard.near_duplicates(frame(spark, [None, ""])).orderBy("doc_id").collect()] == [(0, 0, 0), (1, 0, 1)]


def test_bounds_never_fall_below_overlaps():
    like, r = jaccard.Similarity(), np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(r.integers(0, 2**63, r.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.r_[a[: len(a) // 2], r.integers(0, 2**63, r.integers(1, 400)).astype(np.uint64)])
        x, y = (np.frombuffer(jaccard.point(z), np.uint8) for z in (a, b))
        size = min(len(x), len(y))
        bound = np.minimum(*(z.reshape(-1, size).sum(axis=0, dtype=np.int64) for z in (x, y))).sum()
        assert bound >= len(np.intersect1d(a, b))
    assert like.prefix(10) == 3 and like.prefix(1) == 1


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {x["label"] for x in jaccard.components(links).collect()} == {0}


# 3 ---------------------------------------------------------------------------------------------------------------


def canonical_by_force(text):
    """The canonical form, word by word and line by line, without the operator's patterns."""
    marks = {"copyright", "(c)", "©"}
    kept = []
    for line in (text or "").split("\n"):
        low = line.lower().replace("©", "(c)")
        rest = low.lstrip(" \t\r*#/-;|.,!\"'")
        words = [w.strip(" \t\r.,;:<>[]*") for w in rest.split()]
        words = [w for w in words if w]
        if words and words[0] == "portions":
            words = words[1:]
        statement = bool(words) and words[0] in marks and len(words) > 1 and (words[1] in marks or words[1][:4].isdigit() and words[1][0] in "12" and len(words[1]) >= 4 or words[1].startswith(("year", "yyyy")))
        reserved = rest.rstrip(" \t\r.").endswith("all rights reserved") and (rest.rstrip(" \t\r.") == "all rights reserved" or bool(words) and words[0] in marks)
        kept.append("" if statement or reserved else low)
    words = "".join(c if c.isascii() and c.isalnum() or not c.isascii() and c not in "\u00a0«»·“”‘’–—•…" else " " for c in " ".join(kept).replace("https:", "http:")).split()
    out = " ".join(words)
    for old, new in (("licence(d|s|)", r"license\1"), ("sublicence", "sublicense"), ("copyright holders", "copyright owners"), ("copyright holder", "copyright owner"), ("acknowledgement", "acknowledgment")):
        out = re.sub(rf"\b{old}\b", new, out)
    return out


def test_license_digests(spark):
    known = {k: license.KNOWN[k] for k in license.KNOWN}
    wrapped = {k: "\n".join(textwrap.wrap(v, 38, break_long_words=False, break_on_hyphens=False)) for k, v in known.items()}
    texts, want = [], []

    def add(text, expected):
        texts.append(text)
        want.append(expected)

    for k, v in known.items():
        add(v, k)
        add(v.upper().replace("LICENSE", "LICENCE").replace("UNLICENCE", "UNLICENSE"), k)
        add("  * " + "\n  * ".join(wrapped[k].split("\n")), k)
        add(v.replace('"', "“"), k)
        add(v + " more", None)
        add(" ".join(v.split()[:-1]), None)
        for header in ("Copyright (c) 2020 A. Person", "Copyright © 2020-2024 A. Person\nAll rights reserved.", "© 2020 A. Person", "COPYRIGHT (C) A. Person", "// Portions Copyright 1999 B", "Copyright <year> <owner>", "  * © A. Person, all rights reserved"):
            add(f"{header}\n\n{v}", k)
        for title in license.TITLES.get(k, ()):
            add(f"{title}\n\nCopyright (c) 2020 A. Person\n\n{wrapped[k]}", k)
        add(f"Some other title\n\n{v}", None)
    mit = known["MIT"]
    at = mit.index("copyright notice")
    add(f"{mit[:at]}\n{mit[at:]}", "MIT")  # a wrapped line that begins with "copyright notice" is text
    at = mit.index("COPYRIGHT HOLDERS")
    add(f"{mit[:at]}\n{mit[at:]}", "MIT")
    add(mit.replace("The above copyright notice", "(c) The above copyright notice"), None)  # an item "(c)" is text
    add("(a) one\n(b) two\n(c) three", None)
    for x in (None, "", "  \n"):
        add(x, None)
    add("MIT licence licence", None)
    add("released under the MIT licence", "MIT-notice")
    rows = {r["doc_id"]: r for r in license.scan(frame(spark, texts), license.known_licenses(spark)).collect()}
    for i, t in enumerate(texts):
        assert rows[i]["license_id"] == want[i], (want[i], t)
        assert rows[i]["digest"] == hashlib.sha256(canonical_by_force(t).encode()).hexdigest(), t
    assert license.scan(frame(spark, ["x"]).limit(0), license.known_licenses(spark)).count() == 0


def test_different_texts_keep_different_digests(spark):
    texts = ["a\n(c) the first rule\nb", "a\n(c) the second rule\nb", "a\ncopyright notices stay\nb", "a\nb"]
    assert license.scan(frame(spark, texts), license.known_licenses(spark)).select("digest").distinct().count() == 4


def test_license_lines(spark):
    texts = ["x\nReleased under the MIT License.\ny", None, "", "no", "Licensed under CC BY-NC 4.0.\n" + " ".join(license.KNOWN["MIT"].split()) + "\ny\n" + license.KNOWN["MIT-notice"]]
    known = license.known_licenses(spark)
    docs = frame(spark, texts).withColumn("digest", F.lit("x")).withColumn("line", F.lit(1))
    assert sorted(tuple(x) for x in license.license_lines(docs, known).collect()) == [(0, 1, "MIT-notice"), (4, 0, "CC-BY-NC-4.0-notice"), (4, 1, "MIT"), (4, 3, "MIT-notice")]
    got = {r["doc_id"]: (r["n_lines"], r["line_licenses"]) for r in license.scan_with_lines(docs, known).collect()}
    assert got == {0: (1, "MIT-notice"), 1: (0, ""), 2: (0, ""), 3: (0, ""), 4: (3, "CC-BY-NC-4.0-notice,MIT,MIT-notice")}
    twice = docs.union(docs).withColumn("doc_id", F.expr("nullif(doc_id, 3)"))
    assert license.scan(twice, known).count() == 10 and license.license_lines(twice, known).count() == 8


# 4 ---------------------------------------------------------------------------------------------------------------


def contamination_by_force(texts, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = collections.defaultdict(set)
    for item, t in items:
        w = cut(t)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(item)
    out = {}
    for i, t in enumerate(texts):
        w, hit, found = cut(t), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (g := tuple(w[j : j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[g]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_contamination(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    texts = [t for t in corpus(4) if not t or len(t) < 50_000]
    long = [t for t in texts if t and len(t.split()) > 100]
    items = [(1, " ".join(long[0].split()[20:50])), (10, long[1].upper()), (2, "two, words!"), (3, "word"), (4, None), (5, "..."), (6, "not in any of them at all, really"), (7, " ".join(long[0].split()[20:50])), (8, "three more Words")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contamination(frame(spark, texts), table).collect()}
    assert got == contamination_by_force(texts, items)
    clean = decontaminate.decontaminate(frame(spark, texts), table)
    assert clean.columns == frame(spark, texts).columns and {r["doc_id"] for r in clean.collect()} == {i for i, x in got.items() if not x[4]}
    left = {r["doc_id"]: len(r["clean_words"]) for r in decontaminate.remove_spans(frame(spark, texts), table).collect()}
    assert left == {i: x[0] - x[1] for i, x in got.items()}


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_contamination_of_odd_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    r = random.Random(21)
    passage = " ".join(f"p{i}" for i in range(30))
    long = " ".join(r.choices([f"w{i}" for i in range(900)], k=20_000))
    texts = [long, f"{long} {passage} {long}", passage, None, passage, "the the the the", ""]
    items = [(1, passage), (2, "the"), (3, "the the"), (3, "the the")]
    docs = frame(spark, texts).withColumn("row", F.lit(1)).withColumn("at", F.lit(1))
    table = spark.createDataFrame(items, "item_id long, text string")
    want = contamination_by_force(texts, items)
    assert {x["doc_id"]: tuple(x)[1:] for x in decontaminate.contamination(docs, table).collect()} == want
    odd = docs.withColumn("doc_id", F.expr("CASE WHEN doc_id = 4 THEN NULL WHEN doc_id = 6 THEN 2 ELSE doc_id END"))  # judged each
    got = sorted((x["doc_id"] is None, x["doc_id"] or 0, *tuple(x)[1:]) for x in decontaminate.contamination(odd, table).collect())
    assert got == sorted([*[(False, i, *want[i]) for i in (0, 1, 2, 3, 5)], (True, 0, *want[4]), (False, 2, *want[6])])
    clean = {x["doc_id"]: x["clean_words"] for x in decontaminate.remove_spans(docs, table).collect()}
    assert clean == {0: long.split(), 1: [*long.split(), *long.split()], 2: [], 3: [], 4: [], 5: [], 6: []}


def test_contamination_by_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["contaminated"] for r in decontaminate.contamination(frame(spark, ["a b", None]), none).collect()} == {False}
    assert decontaminate.contamination(frame(spark, ["x"]).limit(0), none).count() == 0


# 5, 6 ------------------------------------------------------------------------------------------------------------


def removal_by_force(items, size, within):
    seen, out = {}, {}
    for i, x in enumerate(items):
        for j in range(len(x) - size + 1):
            seen.setdefault(tuple(x[j : j + size]), (i, j))
    for i, x in enumerate(items):
        gone = [False] * len(x)
        for j in range(len(x) - size + 1):
            first = seen[tuple(x[j : j + size])]
            if first < (i, j) if within else first[0] < i:
                gone[j : j + size] = [True] * size
        out[i] = (len(x), sum(gone), [y for y, g in zip(x, gone, strict=True) if not g])
    return out


@pytest.mark.parametrize("batches", [1, 4])
def test_substring_dedup(spark, batches):
    texts = corpus(6)
    want = removal_by_force([(t or "").encode().split() for t in texts], 50, False)
    index = repeats.FingerprintIndex(spark, fanout=2)
    got = {r["doc_id"]: r for r in repeats.substring_dedup(frame(spark, texts), batches=batches, index=index).collect()}
    assert {i: (r["n_words"], r["n_removed"], r["kept"].encode()) for i, r in got.items()} == {i: (a, b, b" ".join(c)) for i, (a, b, c) in want.items()}
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest() for r in got.values())
    assert len(index.runs) <= 2 and sum(x[1] for x in want.values()) > 500
    index.drop()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("fingerprints_")]


def test_substring_dedup_in_successive_calls(spark):
    texts = corpus(8)
    r = random.Random(9)
    new = lambda n: " ".join(f"{r.choice('abc')}{r.randint(0, 10**6)}" for _ in range(n))
    passage = new(60)
    texts = [f"{new(30)} {passage} {new(30)}", *texts, f"{new(20)} {passage} {new(40)}", *corpus(8)[:20], passage]
    want = removal_by_force([(t or "").encode().split() for t in texts], 50, False)
    docs, got = frame(spark, texts), {}
    cuts = [0, 40, 41, len(texts) - 22, len(texts) - 1, len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        index = repeats.FingerprintIndex(spark, "Successive", fanout=2)  # reopened by name
        part = repeats.substring_dedup(docs.filter(f"doc_id >= {a} and doc_id < {b}"), index=index)
        got |= {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"].encode()) for x in part.collect()}
    assert got == {i: (a, b, b" ".join(c)) for i, (a, b, c) in want.items()}
    assert want[len(texts) - 1][1] == 60 and len(index.runs) <= 2 and len(index.stretches) <= 2
    with pytest.raises(ValueError):
        repeats.substring_dedup(docs, index=index)
    index.drop()
    assert not repeats.FingerprintIndex(spark, "Successive").stretches


def test_substring_dedup_of_hot_passages(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 3)
    r = random.Random(17)
    new = lambda n: " ".join(f"{r.choice('abc')}{r.randint(0, 10**6)}" for _ in range(n))
    short, passage = new(30), new(70)  # a phrase in many contexts, and a passage in many documents
    texts = [f"{new(r.randrange(40))} {short} {new(r.randrange(40))} {passage if i % 2 else short} {new(20)}" for i in range(60)] + ["z " * 200, "z " * 60]
    want = removal_by_force([t.encode().split() for t in texts], 50, False)
    ids = [i * 10**15 if i < 61 else 2**63 - 1 for i in range(62)]  # an outlier doesn't make the batches uneven
    docs = frame(spark, texts).withColumn("doc_id", F.element_at(F.array(*map(F.lit, ids)), F.col("doc_id").cast("int") + 1))
    got = {x["doc_id"]: (x["n_words"], x["n_removed"]) for x in repeats.substring_dedup(docs, batches=4).collect()}
    assert got == {ids[i]: x[:2] for i, x in want.items()}
    odd = frame(spark, [passage, passage, None]).withColumn("doc_id", F.expr("nullif(doc_id, 1)")).withColumn("w1", F.lit(1))
    assert sorted(x["n_removed"] for x in repeats.substring_dedup(odd).collect()) == [0, 0, 0]
    assert sorted(x["n_removed"] for x in repeats.line_dedup(odd, 1).collect()) == [0, 0, 0]


def test_line_matches_extend_both_ways(spark):
    texts = ["a\nb\nc\nd\ne", "x\nb\nc\nd\ny\na\nb", "c\nd\ne"]
    found = repeats.line_matches(frame(spark, texts), repeats._line_winnow(2), 50)
    assert sorted(tuple(r) for r in found.collect()) == [(1, 1, 2, 0, 1), (1, 5, 1, 0, 0), (2, 0, 2, 0, 2)]


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_line_dedup(spark, min_lines):
    r = random.Random(7)
    lines = [f"line {i}" for i in range(12)] + ["", "  ", "end\r"]
    texts = [None, "", "\n\n", "only", "only", "a\nb\na\nb\na\nb"] + ["\n".join(r.choices(lines, k=r.randint(1, 14))) for _ in range(50)]
    texts += texts[10:14]
    want = removal_by_force([[y.strip() for y in (t or "").split("\n") if y.strip()] for t in texts], min_lines, True)
    got = {x["doc_id"]: x for x in repeats.line_dedup(frame(spark, texts), min_lines).collect()}
    for i, t in enumerate(texts):
        n, removed, kept = want[i]
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (n, removed)
        assert (got[i]["text"] is None) == (t is None)
        assert [y.strip() for y in (got[i]["text"] or "").split("\n") if y.strip()] == kept
        if not removed:
            assert got[i]["text"] == t


def test_line_dedup_of_single_long_lines(spark):
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    texts = [f"a\n{long}\n{short}\nb", f"c\n  {long}\nd", long, f"e\n{short}\nf", f"g\n{long}x\n{long}\nh", f"{long}x"]
    want = [texts[0], "c\nd", "", texts[3], f"g\n{long}x\nh", ""]
    assert [x["text"] for x in repeats.line_dedup(frame(spark, texts)).orderBy("doc_id").collect()] == want
    got = repeats.drop_repeated_lines(frame(spark, texts)).orderBy("doc_id").collect()
    assert [x["text"] for x in got] == want and [x["lines_removed"] for x in got] == [0, 1, 1, 0, 1, 1]


def test_tables_of_one_machine_are_refused():
    class Context:
        master = "spark://host:7077"

        def __init__(self, settings):
            self.settings = settings

        def getConf(self):
            return type("Conf", (), {"contains": lambda _, x: x in self.settings})()

    session = lambda settings: type("Session", (), {"sparkContext": Context(settings)})()
    common.check_warehouse(session({"spark.sql.warehouse.dir"}))
    with pytest.raises(ValueError, match="share"):
        common.check_warehouse(session(set()))


def test_dropped_lines_by_broadcast_and_by_shuffle(spark, monkeypatch):
    docs = frame(spark, [None, "", *[f"a {i}\nsame line\nother line\nb" for i in range(30)], "same line\nother line"])
    got = repeats.drop_repeated_lines(docs).orderBy("doc_id").collect()
    assert sum(x["lines_removed"] for x in got) == 89 and [x["text"] for x in got[:4]] == [None, "", "a 0\nsame line\nother line\nb", "a 1"]
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    assert repeats.drop_repeated_lines(docs).orderBy("doc_id").collect() == got


@pytest.mark.parametrize("slots", [common.SLOTS, 1 << 16, 8])
def test_texts_without_repeats_stay_where_they_are(spark, monkeypatch, slots):
    monkeypatch.setattr(common, "SLOTS", slots)
    docs = frame(spark, [f"a {i}\nb {i if i % 10 else 0}\nc {i if i % 10 else 0}\n" for i in range(2000)] + [None]).select("doc_id", "text").union(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    ids = common.save(spark.range(0, 2000, 10).withColumnRenamed("id", "doc_id"), "ids")
    may, rest = common.parted(docs.select("doc_id", "text"), ids)
    assert may.count() + rest.count() == 2002 and not rest.join(ids, "doc_id", "left_semi").count()
    assert slots < 1 << 16 or may.count() < 230
    out = repeats.line_dedup(docs)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "bitmap_construct_agg" in plan
    got = {x["doc_id"]: x["n_removed"] for x in out.collect()}
    assert len(got) == 2002 and sum(got.values()) == 2 * 199 and got[0] == 0 and got[1990] == 2


def test_repeats_in_an_empty_table(spark):
    none = frame(spark, ["x"]).limit(0)
    assert repeats.substring_dedup(none).count() == 0 and repeats.line_dedup(none).count() == 0


# 7, 8 ------------------------------------------------------------------------------------------------------------


def test_trees_and_calibration():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = toxicity.fit_trees(x[:2000], y[:2000])
    raw = model.raw(x[2000:])
    assert ((raw > 0) == y[2000:]).mean() > 0.97
    at, p = toxicity.isotonic(raw, y[2000:])
    assert (np.diff(at) >= 0).all() and (np.diff(p) >= 0).all()
    assert len(toxicity.fit_trees(x[:5], y[:5]).leaf) == 0


def test_toxicity(spark):
    r = random.Random(8)
    words, bad = [f"w{i}" for i in range(300)], ["grob", "fies", "mies"]
    texts, labels = [], []
    for i in range(900):
        w = r.choices(words, k=r.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(bad) if r.random() < 0.7 else "gr0b!!")
        texts.append(" ".join(w))
        labels.append((i, int(toxic)))
    texts += [None, "", "x" * 100_000]
    table = spark.createDataFrame([*labels, labels[0], (5, None), (10_000, 1)], "doc_id long, toxic int")
    docs = frame(spark, texts)
    got = {x["doc_id"]: x for x in toxicity.score(docs, toxicity.fit(docs, table.filter("doc_id % 3 <> 1"))).collect()}
    assert len(got) == len(texts) and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.7) for x in got.values())
    held = [i for i in range(900) if i % 3 == 1]
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.97
    assert got[900]["predicted"] == got[901]["predicted"] == 0


def test_toxicity_equals_the_model_row_by_row(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(queries.crc_mod(3) != 1))
    got = {r["doc_id"]: r for r in queries.op7_toxicity(spark, DATA).collect()}
    assert set(got) == {r["doc_id"] for r in docs.select("doc_id").collect()}
    for r in docs.collect():  # a table of its own for each text, so that no cache carries over
        p = float(model.score(toxicity.features(r["text"], toxicity.WordFeatures(model.lexicon))[None])[0])
        assert got[r["doc_id"]]["score"] == pytest.approx(p, abs=1e-9) and got[r["doc_id"]]["predicted"] == int(p >= 0.7)
        assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_trees_equal_a_walk():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 4))
    model = toxicity.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), trees=9)
    for row, got in zip(x, model.raw(x), strict=True):
        total = model.base
        for split, threshold, leaf in zip(model.split, model.threshold, model.leaf, strict=True):
            node = 0
            while node < len(split):
                node = 2 * node + (2 if row[split[node]] > threshold[node] else 1)
            total += leaf[node - len(split)]
        assert got == pytest.approx(total)


def test_toxicity_of_odd_rows(spark):
    texts = ["grob " * (i % 2) + f"word{i % 7} more text here" for i in range(200)]
    docs = frame(spark, texts).withColumn("x", F.lit(1)).withColumn("fold", F.lit("f")).withColumn("toxic", F.lit(5))
    docs = docs.withColumn("doc_id", F.expr("CASE WHEN doc_id = 9 THEN NULL WHEN doc_id % 2 = 0 THEN doc_id * 40000000000000000 ELSE -doc_id * 40000000000000000 END"))
    labels = docs.filter("doc_id is not null").selectExpr("doc_id", "CASE WHEN text LIKE 'grob%' THEN 2 ELSE 0 END AS toxic")  # above 0 counts as 1
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.union(docs.limit(1)), model).collect()
    assert len(got) == 201 and sum(r["doc_id"] is None for r in got) == 1
    assert np.mean([r["predicted"] == (r["doc_id"] is None or r["doc_id"] < 0) for r in got]) > 0.95


def test_toxicity_without_labels(spark):
    docs = frame(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, none)).filter("score between 0 and 1").count() == 2
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_language_id(spark):
    langs = {"aa": ["taka", "raka", "naka"], "bb": ["zolo", "tolo", "molo"], "cc": ["übel", "öde", "ähre"]}
    r = random.Random(9)
    rows = [(i, " ".join(r.choices(langs[k], k=20)), k) for i, k in enumerate(list(langs) * 30)]
    docs = spark.createDataFrame([*rows, (1000, "taka", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    probe = spark.createDataFrame([(1, "zolo zolo"), (2, "TAKA 12"), (3, None), (4, "12 .."), (5, ""), (6, "öde ähre " * 100_000)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in langid.predict(probe, model).collect()}
    assert {i: x["lang_pred"] for i, x in got.items()} == {1: "bb", 2: "aa", 3: "und", 4: "und", 5: "und", 6: "cc"}
    assert all(0 <= x["score"] <= 1 for x in got.values())
    empty = langid.fit(docs.limit(0))
    assert {x["lang_pred"] for x in langid.predict(probe, empty).collect()} == {"und"}


def ngram_counts_by_force(text, cut):
    """Counts of hashed 1- to 3-grams, one n-gram at a time."""
    out = collections.Counter()
    points = [32 if c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in map(ord, text.lower())]
    for n in (1, 2, 3):
        for i in range(len(points) - n + 1):
            h = 0
            for m, p in enumerate(points[i : i + n], 1):
                h = (h * 0x100000001B3 + p + m) % 2**64
            out[(h * 0x9E3779B97F4A7C15) % 2**64 >> 48] += 1
    return out


@pytest.mark.parametrize("cut", [500_000, 7, 1])
def test_ngrams_across_slices(monkeypatch, cut):
    monkeypatch.setattr(langid, "SLICE", cut)
    for text in ("", "a", "ab", "Abc d,ef", "Ünïcödé İ words 123 and more", "x" * 40):
        got = collections.Counter()
        for x in langid.slices(text):
            got.update(x.tolist())
        assert got == ngram_counts_by_force(text, cut)


@pytest.mark.parametrize("parts", [200, 2])
def test_language_id_equals_naive_bayes(spark, monkeypatch, parts):
    monkeypatch.setattr(langid, "LANGUAGES", parts)
    monkeypatch.setattr(langid, "SLICE", 50)
    r = random.Random(19)
    rows = [(i if i else None, " ".join(r.choices([f"{k}{x}" for x in "abcde"], k=r.randint(1, 30))), k) for i, k in enumerate(["de", "en", "fr", "it", "nl"] * 8)]
    rows += [(1, None, "en"), (2, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit("r")).withColumn("top", F.lit(1))
    model = langid.fit(docs)
    assert len(model) == (1 if parts == 200 else 3)
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        if lang:
            n[lang] += 1
            counts[lang].update(ngram_counts_by_force(text or "", 0))
    probe = [(i, t) for i, (_, t, _) in enumerate(rows)] + [(None, "de en dea"), (0, "ena")]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["lang_pred"], round(r["score"], 4)) for r in langid.predict(spark.createDataFrame(probe, "doc_id long, text string").withColumn("lang", F.lit("xx")), model).collect())
    want = []
    for i, t in probe:
        if not t or not re.search("[a-z]", t):
            want.append((i is None, i or 0, "und", 0.0))
            continue
        own = ngram_counts_by_force(t, 0)
        score = {k: math.log(n[k] / sum(n.values())) + sum(c * math.log((counts[k][g] + 0.5) / (sum(counts[k].values()) + 0.5 * langid.BUCKETS)) for g, c in own.items()) for k in n}
        best = min(score, key=lambda k: (-score[k], k))
        want.append((i is None, i or 0, best, round(1 / sum(math.exp(x - score[best]) for x in score.values()), 4)))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 2e-3


def test_more_than_two_hundred_languages(spark):
    docs = spark.createDataFrame([(i, chr(0x4E00 + i) * 5, f"l{i:03d}") for i in range(201)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert got == {i: f"l{i:03d}" for i in range(201)}


def test_language_id_held_out(spark):
    got = queries.op8_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() / got.count() > 0.95


# 9 ---------------------------------------------------------------------------------------------------------------


def test_plan_is_best_fit_decreasing():
    r = random.Random(10)
    for _ in range(60):
        capacity = r.choice((7, 16, 50))
        histogram = collections.Counter(r.randint(1, capacity) for _ in range(r.randint(0, 120)))
        open_bins: list[int] = []
        for length in sorted(histogram.elements(), reverse=True):
            fit = [i for i, x in enumerate(open_bins) if x >= length]
            if fit:
                open_bins[min(fit, key=lambda i: open_bins[i])] -= length
            else:
                open_bins.append(capacity - length)
        placed, used = collections.Counter(), collections.defaultdict(list)
        for length, first, count, bin_, place in packing.best_fit_plan(histogram, capacity):
            assert first == placed[length]
            placed[length] += count
            for i in range(count):
                used[bin_ + i].append((place, length))
        assert placed == histogram and len(used) == len(open_bins)
        for parts in used.values():
            at = 0
            for place, length in sorted(parts):
                assert place == at
                at += length
            assert at <= capacity


def test_packing_round_trip(spark):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path, ranks = public.path("byte_bpe_50k.json"), (public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    odd = ["", " ", "a  b", "a   b\n\n c", "x\n", "\n", "  lead", "tab\there\t\tx", "<|endoftext|> hi", "é à 日本語 text", "it's we'll I'M 123abc", "a b", "a \n b", "end ", "Ж ж   x", "🎉 party🎉", "\x1c x\x1c\x1d", None]
    texts = corpus(11, 30) + odd
    tokenizer = Tokenizer.from_file(path)
    for r in (None, ranks):
        rows = packing.pack(frame(spark, texts), path, ranks=r).collect()
        by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
        for x in rows:
            by_doc[x["doc_id"]].append(x)
            by_bin[x["sequence_id"]].append(x)
        for i, t in enumerate(texts):
            ids, at = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
            for k, x in enumerate(sorted(by_doc[i], key=lambda x: x["piece"])):
                assert (x["piece"], x["start"]) == (k, at) and x["ids_crc32"] == zlib.crc32(ids[at : at + x["length"]].tobytes())
                assert k == 0 or x["length"] == 2048
                at += x["length"]
            assert at == len(ids)
        for parts in by_bin.values():
            at = 0
            for x in sorted(parts, key=lambda x: x["offset"]):
                assert x["offset"] == at
                at += x["length"]
            assert at <= 2048
    assert packing.pack(frame(spark, ["x"]).limit(0), path).count() == 0


# 10 --------------------------------------------------------------------------------------------------------------


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def best_by_force(rows, k):
    whole = [(i, [int(np.floor(np.float64(np.float32(c)) * 64)) for c in e]) for i, e in rows if i is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)]
    out = {}
    for q, v in sorted(whole, reverse=True):  # of repeated queries the smallest vector counts
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, e, strict=True)), i) for i, e in whole if i != q)[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return {q: x for q, x in out.items() if x}


def best_by_operator(table, k):
    v, got = topk.to_integers(table), collections.defaultdict(list)
    for x in topk.top_k(v, v.filter("id % 20 = 0"), k).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["rank"], x["vec_id"], x["score"]))
    return dict(got)


@pytest.mark.parametrize("sizes", [(128, 32, 4096, 2048), (4, 2, 3, 5)])
def test_top_k(spark, monkeypatch, sizes):
    for name, x in zip(("BLOCK", "RANGE", "PACK", "GROUP"), sizes, strict=True):
        monkeypatch.setattr(topk, name, x)
    r = np.random.default_rng(12)
    rows = [(i, [float(x) for x in r.normal(size=6).round(1)]) for i in range(150)]
    rows += [(150 + i, rows[i][1]) for i in range(20)] + [(200, None), (220, [1.0, None]), (240, [float("nan")] * 6), (260, [float("inf")] * 6), (280, [1e9] * 6), (None, [1.0] * 6)]
    rows += [(7, rows[8][1]), (7, rows[9][1]), (300, [-1e-3] * 6)]  # a repeated id, and a tie of small vectors
    table = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).withColumn("id", F.lit(0)).withColumn("v", F.lit("x"))
    assert best_by_operator(table, 5) == best_by_force(rows, 5)
    v = topk.to_integers(table)
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0
    assert topk.top_k(v.filter("id in (0, 1)"), v.filter("id = 0")).count() == 1


def test_top_k_prunes_blocks_of_clustered_vectors(spark, monkeypatch):
    for name, x in zip(("BLOCK", "RANGE", "PACK"), (16, 16, 16), strict=True):
        monkeypatch.setattr(topk, name, x)
    r = np.random.default_rng(13)
    centres = r.normal(size=(20, 32)) * 4
    rows = [(i, [float(x) for x in centres[r.integers(20)] + r.normal(size=32) * 0.2]) for i in range(2000)]
    visited, bounds = [], topk.reached_blocks

    def counted(blocks, packed):
        out = bounds(blocks, packed)
        visited.append(out.count() / (blocks.count() * packed.count()))
        return out

    monkeypatch.setattr(topk, "reached_blocks", counted)
    assert best_by_operator(spark.createDataFrame(rows, VECTORS), 10) == best_by_force(rows, 10)
    assert visited[0] < 0.35


def test_scores_beyond_64_bits_are_errors(spark):
    large = [(i, [1e9 * (i + 1), 2e9]) for i in range(3)]  # products of 2**62 and more
    with pytest.raises(Exception, match="64 bits"):
        best_by_operator(spark.createDataFrame([(i, [1e30 if i == 1 else 1.0]) for i in range(3)], VECTORS), 2)
    with pytest.raises(Exception, match="64 bits"):
        best_by_operator(spark.createDataFrame(large, VECTORS), 2)
    fits = [(i, [3e7 if j == i else 0.5 for j in range(3)]) for i in range(3)]  # products of parts would not fit, their sums do
    assert best_by_operator(spark.createDataFrame(fits, VECTORS), 2) == best_by_force(fits, 2)


# all -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.SQL[name])


def test_every_operator_is_registered():
    assert [int(re.match(r"op(\d+)_", x)[1]) for x in queries.QUERIES] == list(range(1, 14))
