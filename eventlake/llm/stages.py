"""Stages of the corpus pipeline: function(spark, docs, sf_dir) -> DataFrame with the columns of documents.

What holds for all of them: docs may have further columns of any name, which the stages that return documents keep.
An empty table stays empty. Null and empty texts are kept, except where a stage says otherwise. Rows with a null
doc_id are kept as they are; rows that share a doc_id are dropped together, and stages that compare documents by place
(line dedup, near copies) ask for unique ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, packing, repeats, toxicity
from .common import read, without


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict toxic (score below 0.7), learnt from the labels of docs.

    Without labels of both kinds nothing is toxic enough to go, unless most labels are 1.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return without(docs, toxicity.score(docs, model).filter("predicted = 1"), "toxic")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the later copies of repeated runs of lines; n_chars is counted anew where text changed.

    A text all of whose lines repeat becomes empty and stays.
    """
    out = repeats.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(out.columns[-1]) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id. Documents without words are no copies."""
    return without(docs, jaccard.near_duplicates(docs).filter("component_id <> doc_id"), "near_copies")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark windows; all, if the benchmark is empty."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer_path: str | None = None, ranks: tuple[str, str] | None = None) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 2048 tokens; by default with the public byte-level vocabulary.

    Null and empty texts are pieces of one token; rows of a null or repeated doc_id are packed each.
    """
    if tokenizer_path is None:
        import public_tokenizers as public

        tokenizer_path, ranks = public.path("byte_bpe_50k.json"), (public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return packing.pack(docs, tokenizer_path, ranks=ranks)
