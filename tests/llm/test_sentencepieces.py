"""Encoding and decoding by merge types against the library that defines them."""

import hashlib
import random

import pytest

from eventlake.llm import queries, sentencepieces

from ..compare import DATA

public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


def agree(library, texts):
    own = sentencepieces.encoder(PATH)
    for text, n, ids, decoded in zip(texts, *own.encode(texts), strict=True):
        want = library.encode(text, add_eos=True)
        assert (n, ids.decode(), decoded.decode()) == (len(want), " ".join(map(str, want)), library.decode(want)), text


def test_random_texts_of_pieces_characters_and_blanks(library):
    r, known = random.Random(5), sentencepieces.encoder(PATH).pieces
    pieces = list(known.ids)
    odd = [p for p in pieces if len(p) == 1] + ["́", "\0", "👩‍🚀", "ﬁ", "　", "​", "\xa0", "▁", "\n", "\t", "\U0010fffd"]
    kinds = (odd, pieces, list("abcdeinorst  .'-1"), [" ", "  ", "   ", "▁", "a", "\n"])
    agree(library, ["".join(r.choices(kinds[i % 4], k=r.randint(0, 25))) for i in range(12_000)])


def test_units_of_any_length(library):
    for n in (39, 40, 41, 1000, 20_000):
        agree(library, ["x" * n, "ab" * n, " " * n, "é" * n, "\U0010fffd" * n, "in" * n + " the", "▁" * n + "a"])


def test_every_cut_of_units_is_the_same(library, monkeypatch):
    texts = ["it's a test, isn't it?  x--y 3.14 m². 5²x", "a,b;c (d) [e]"]
    agree(library, texts)
    pieces = sentencepieces.encoder(PATH).pieces.ids
    assert sentencepieces.units(pieces).findall("▁a²,▁b².▁c") == ["▁a", "²,", "▁b", "².", "▁c"]
    monkeypatch.setattr(sentencepieces, "ODD", 0)
    assert sentencepieces.units(["a.", "▁a"]).findall("▁a.b▁c") == ["▁a.b", "▁c"]
    monkeypatch.setattr(sentencepieces.encoder(PATH), "units", sentencepieces.units(pieces))
    agree(library, texts)


def test_few_kept_units_and_pairs(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KEPT_UNITS", 3)
    monkeypatch.setattr(sentencepieces, "APART", 4)
    own = sentencepieces.Encoder(PATH)
    texts = ["some words and other words", "again some words", "nothing is kept"] * 3
    assert own.encode(texts)[1] == sentencepieces.encoder(PATH).encode(texts)[1]


def test_other_kinds_of_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="left as they are"):
        sentencepieces.Encoder(str(tmp_path / "m"))


def test_rows(spark, library):
    rows = [(1, None, "x"), (1, "", "x"), (None, "a  b", "x"), (3, "word " * 50_000, "x"), (3, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, sentencepieces.encode(docs, PATH).collect()), key=str)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    ids = lambda text: library.encode(text or "", add_eos=True)
    assert got == sorted(((i, len(ids(t)), digest(" ".join(map(str, ids(t)))), digest(t or "")) for i, t, _ in rows), key=str)
    assert sentencepieces.encode(docs.limit(0), PATH).collect() == []


def test_query(spark, library):
    got = {r["doc_id"]: r for r in queries.op11_sentencepiece(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_eos=True)
        assert got[d["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d["doc_id"]]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
