"""The corpus pipeline, stage by stage and as a whole, against brute force."""

import collections
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from eventlake.llm import stages, toxicity
from pyspark.sql import functions as F

from ..compare import DATA
from .test_operators import components_by_force, contamination_by_force, frame, removal_by_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    rows = corpus_pipeline.run(spark, DATA).collect()
    ids = {r["doc_id"] for r in rows}
    assert ids <= {r["doc_id"] for r in docs.collect()} and len(ids) > 100


def test_line_stage_changes_texts(spark):
    docs = frame(spark, ["a\nb\nc", "x\na\nb\ny", None, "a\nb"]).select(*COLUMNS)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages.dedup_lines(spark, docs, DATA).collect()}
    assert got == {0: ("a\nb\nc", 5), 1: ("x\ny", 3), 2: (None, 0), 3: ("", 0)}
    assert removal_by_force([["a", "b", "c"], ["x", "a", "b", "y"]], 2, True)[1][1] == 2


def test_near_copy_stage_keeps_one_of_each(spark):
    text = " ".join(f"w{i}" for i in range(100))
    texts = [text, text + " z", "other text", None, text, ""]
    kept = {r["doc_id"] for r in stages.drop_near_copies(spark, frame(spark, texts).select(*COLUMNS), DATA).collect()}
    assert kept == {i for i, (_, c) in components_by_force(texts).items() if c == i} == {0, 2, 3, 5}


def test_decontamination_stage(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [items[0][1], "clean text", None, "long " * 2000 + items[1][1]]
    bad = {i for i, x in contamination_by_force(texts, items).items() if x[4]}
    kept = {r["doc_id"] for r in stages.drop_contaminated(spark, frame(spark, texts).select(*COLUMNS), DATA).collect()}
    assert kept == set(range(4)) - bad and 0 in bad and 1 not in bad


def small_corpus(spark, tmp_path):
    """Tables of documents, labels and benchmark with toxic ones, repeated lines, near copies and contaminated ones."""
    r = random.Random(31)
    word = lambda: f"w{r.randrange(900)}"
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(20)) for i in range(4)]
    shared = [text(6) for _ in range(6)]
    texts = []
    for i in range(260):
        lines = [text(r.randint(5, 30)) for _ in range(r.randint(1, 5))]
        if i % 5 == 0:
            lines[0] = f"you grob fies {lines[0]} grob mies you fies"
        if i % 7 == 0:
            at = r.randrange(4)
            lines += shared[at : at + 2]
        if i % 11 == 0:
            lines.insert(0, items[i % 4][1])
        texts.append("\n".join(lines))
        if i % 9 == 0:
            texts.append(f"{texts[-1]} {word()}")
            texts.append(texts[-1])
    texts += [None, "", "   ", "one"]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    toxic = [(i, int("grob" in (t or ""))) for i, t in enumerate(texts) if i % 4]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return texts, items


def test_whole_pipeline_by_force(spark, tmp_path):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    texts, items = small_corpus(spark, tmp_path)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{x}.parquet") for x in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    left = {i: t for i, t in enumerate(texts) if model.score(toxicity.features(t, toxicity.WordFeatures(model.lexicon))[None])[0] < 0.7}
    assert 10 < len(texts) - len(left) < 100
    ids = sorted(left)
    lines = removal_by_force([[y.strip() for y in (left[i] or "").split("\n") if y.strip()] for i in ids], 2, True)
    assert sum(x[1] for x in lines.values()) > 20
    left = {i: left[i] if not lines[k][1] else "\n".join(lines[k][2]) for k, i in enumerate(ids)}
    classes = components_by_force([left[i] for i in ids])
    left = {i: left[i] for k, i in enumerate(ids) if classes[k][1] == k}
    assert len(left) < len(ids) - 5
    ids = sorted(left)
    bad = contamination_by_force([left[i] for i in ids], items)
    left = {i: left[i] for k, i in enumerate(ids) if not bad[k][4]}
    assert len(left) < len(ids) - 5
    tokenizer, got = Tokenizer.from_file(public.path("byte_bpe_50k.json")), collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(got) == set(left)
    for i, t in left.items():
        tokens = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got[i]] == [(0, 0, len(tokens), zlib.crc32(tokens.tobytes()))]
    for parts in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


@pytest.mark.parametrize("name", [x for x, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_tables(spark, tmp_path, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame([(i, 0) for i in range(5)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "x " * 20)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, ["a b c", None, "", "word " * 30, "one\ntwo"]).withColumns({x: F.lit(1) for x in ("row", "at", "n", "fold", "toxic", "rep", "block", "length", "_repeated", "lines_removed", "_LINES_removed")})
    out = stage(spark, docs.limit(0), str(tmp_path))
    assert out.count() == 0
    docs = docs.withColumn("doc_id", F.expr("nullif(doc_id, 3)"))
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == [(False, 0), (False, 1), (False, 2), (False, 4), (True, 0)]
    if name != "packing":
        assert out.columns == docs.columns
        assert {r["doc_id"]: r["text"] for r in rows} == {r["doc_id"]: r["text"] for r in docs.collect()}
