"""The conversation trie against brute force, over one range and over many."""

import collections
import hashlib
import random
import zlib

import pytest

from eventlake.llm import prefixes

TURNS = "conv_id long, turn long, role string, text string, path string, depth int, n_convs string"


def rebuilt(rows):
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def brute(rows):
    members = collections.defaultdict(list)
    every = rebuilt(rows)
    for c, turns in every.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(set)
    for k in members:
        if k:
            children[k[:-1]].add(k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    ends = lambda k: ",".join(map(str, sorted(c for c in members[k] if len(every[c]) == len(k))))
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]), leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in members.items()), key=str)


def conversations(seed, n=150, say="abé"):
    r, rows = random.Random(seed), []
    for c in range(n):
        for t in range(r.choice((1, 2, 3, 9, 14))):
            rows.append((c, r.choice((t, t, t, None)), r.choice(("user", "user", "bot", None)), r.choice((*say, "", None))))
    first = [x for x in rows if x[0] == 5]
    for c in range(5000, 5200):  # many copies of one conversation, without turns of their own to take over
        rows += [(c, t, "user", "copy") for t in range(20)]
    rows += first[:3]  # repeated rows
    rows += [(None, 0, "user", "lost"), (700, 0, "user", "x"), (9_007_199_254_740_993, 3, "", ""), (605, None, None, None)]
    rows += [(800, t, "user", f"turn {t}") for t in range(90)] + [(805, t, "user", f"turn {t}") for t in range(60)]
    return rows


def run(spark, rows):
    df = spark.createDataFrame([(*x, "p", 1, "n") for x in rows], TURNS)
    return sorted((tuple(x) for x in prefixes.prefix_tree(df).collect()), key=str)


@pytest.mark.parametrize("partitions", ["1", "4", "40"])
def test_prefix_tree(spark, monkeypatch, partitions):
    monkeypatch.setattr(prefixes, "BATCH", 7)
    monkeypatch.setattr(prefixes, "JOINED", 100)
    rows = conversations(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_parts_by_prefixes(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PER_TASK", 400)
    rows = conversations(5, 60)
    assert run(spark, rows) == brute(rows)


def test_odd_tables(spark):
    for rows in ([], [(None, 1, "user", "x")], [(1, 0, "user", "x")], [(6, None, None, None), (5, 1, "a", "b")], [(c, 0, "user", "same") for c in range(30)]):
        assert run(spark, rows) == brute(rows)


def test_handles():
    for low in range(40):
        for high in range(low + 1, 70):
            best = max(range(low + 1, high + 1), key=lambda x: (x & -x).bit_length())
            assert prefixes.handle_depth(low, high) == best


def test_exit_nodes_of_a_trie():
    r = random.Random(6)
    for _ in range(200):
        words = sorted({"".join(r.choices("ab", k=r.randint(0, 12))) for _ in range(30)})
        paths = [[w[: d + 1].encode() for d in range(len(w))] for w in words]
        trie = prefixes.ZFastTrie()
        for i, path in enumerate(paths):
            node, depth = trie.locate(path)
            assert depth == max((sum(x == y for x, y in zip(p, path)) for p in paths[:i]), default=0)
            assert node.low < depth <= node.high or node is trie.root or depth == node.high
            trie.insert([(i, path)])
        nodes = trie.downwards()
        assert {n.end for n in nodes} - {None} == set(range(len(paths))) and len(trie.table) == len(nodes) - 1
        assert all(n.high and trie.table[n.handle()] is n for n in nodes[1:]) and all(len(n.children) > 1 or n.end is not None for n in nodes[1:])
