"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training windows.

Only DataFrame functions run here, so every step stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, BROADCAST_ROWS, discard, save, without

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A run of ASCII digits, lower-case letters and anything outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window by whose hash positions are probed.
FIRST = 3
#: Hash of the entry that every text has after its positions.
END = 0


def word_array(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """Distinct windows of the test items: item, len, gram (all words) and h (a hash of the first FIRST words)."""
    w = items.select(F.col("item_id").alias("item"), word_array(F.col("text")).alias("w")).filter(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(n)))
    at = F.explode(F.sequence(F.lit(1), F.size("w") - F.col("len") + 1))
    w = w.select("item", "len", "w", at.alias("at")).select("item", "len", F.slice("w", F.col("at"), F.col("len")).alias("g"))
    return w.select("item", "len", F.array_join("g", " ").alias("gram"), first_hash(F.col("g"), F.lit(0), FIRST).alias("h")).distinct()


def first_hash(w: Column, at: Column, k: int) -> Column:
    """Hash of the k words of w from at (from 0) on; of those that are there, if w ends before."""
    return F.xxhash64(*[F.get(w, at + i) for i in range(k)])


def hits(docs: DataFrame, items: DataFrame, n: int = 13) -> tuple[DataFrame, list[DataFrame]]:
    """Verified occurrences of test windows, some perhaps repeated: row, doc_id, n_words, item, at (first word, from 0), len.

    Every row of docs also has one entry of at -1 without an item, so that one scan gives counts and hits; row is a
    number of the row of docs. Also returns the stored tables that the result is read from.

    Every position is probed by a hash of its first words against the set of those of the windows; the few that
    remain are verified on the whole window. Both sets are broadcast if rows and bytes of the windows, which are
    counted first, are at most BROADCAST_ROWS and BROADCAST_BYTES. Otherwise the hashes (row, at, h) are
    shuffled, and only what is left is joined with its text again.
    """
    windows = save(item_windows(items, n), "windows")
    stats = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("gram")), F.lit(0)).alias("bytes"), F.array_sort(F.collect_set("len")).alias("lens")).first()
    few = stats["n"] <= BROADCAST_ROWS and stats["bytes"] <= BROADCAST_BYTES
    lengths, stored = list(stats["lens"]), [windows]  # at most n lengths
    end = windows.select(F.lit(None).cast(windows.schema["item"].dataType).alias("item"), F.lit(0).alias("len"), F.lit("").alias("gram"))
    end = docs.sparkSession.createDataFrame([(END,)], "h long").select(F.lit(None).cast(end.schema["item"].dataType).alias("item"), F.lit(0).alias("len"), F.lit("").alias("gram"), "h")
    known = windows.union(end)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    if not few:  # numbered once and for all, since they are read twice
        rows = save(rows, "numbered")
        stored.append(rows)
    words = rows.select("row", "doc_id", word_array(F.col("text")).alias("w"))
    at = words.select("row", "doc_id", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    probe = [first_hash(F.col("w"), F.col("at"), k) for k in sorted({min(x, FIRST) for x in lengths} | {FIRST})]
    if len(probe) == 1:
        rows = at.withColumn("h", F.when(F.col("at") >= 0, probe[0]).otherwise(F.lit(END)))
    else:
        rows = at.withColumn("h", F.explode(F.when(F.col("at") >= 0, F.array_distinct(F.array(*probe))).otherwise(F.array(F.lit(END).cast("long")))))
    wanted = known.select("h").distinct()
    if few:
        rows = rows.join(F.broadcast(wanted), "h", "left_semi").select("row", "doc_id", "w", "at")
    else:  # the whole text must not travel with each of its positions
        rows = save(rows.select("row", "doc_id", "at", "h", F.when(F.col("at") < 0, F.size("w")).alias("n_words")).join(wanted, "h", "left_semi").drop("h"), "probed")
        ends = rows.filter("at < 0")
        places = rows.filter("at >= 0").groupBy("row").agg(F.array_sort(F.collect_set("at")).alias("ats"))  # at most as many as the text has words
        stored.append(rows)
        rows = words.join(places, "row").select("row", "doc_id", "w", F.explode("ats").alias("at"))
    own = F.array(*[F.struct(F.lit(x).alias("len"), F.array_join(F.slice("w", F.col("at") + 1, F.lit(x)), " ").alias("gram"), (F.size("w") - F.col("at") >= x).alias("fits")) for x in lengths]) if lengths else F.array().cast("array<struct<len: int, gram: string, fits: boolean>>")
    last = F.array(F.struct(F.lit(0).alias("len"), F.lit("").alias("gram"), F.lit(True).alias("fits")))
    rows = rows.select("row", "doc_id", "at", F.size("w").alias("n_words"), F.explode(F.when(F.col("at") >= 0, own).otherwise(last)).alias("c"))
    rows = rows.filter("c.fits").select("row", "doc_id", "n_words", "at", "c.len", "c.gram")
    grams = known.select("item", "len", "gram")
    found = rows.join(F.broadcast(grams) if few else grams, ["len", "gram"]).select("row", "doc_id", "n_words", "item", "at", "len")
    if not few:
        found = found.union(ends.select("row", "doc_id", "n_words", F.lit(None).cast(windows.schema["item"].dataType), "at", F.lit(0)))
    return found, stored


def gaps(spans: Column, end: Column) -> Column:
    """Pieces (start, n) of 0..end that sorted spans (at, len) don't cover."""
    piece = "struct<start: int, n: int>"

    def step(state: Column, x: Column) -> Column:
        new = F.when(x["at"] > state["done"], F.concat(state["free"], F.array(F.struct(state["done"].alias("start"), (x["at"] - state["done"]).alias("n"))))).otherwise(state["free"])
        return F.struct(F.greatest(state["done"], x["at"] + x["len"]).alias("done"), new.alias("free"))

    start = F.struct(F.lit(0).alias("done"), F.array().cast(f"array<{piece}>").alias("free"))
    last = F.struct(end.alias("at"), F.lit(0).alias("len"))
    return F.aggregate(F.concat(spans, F.array(last)), start, step)["free"]


def spans_of(found: DataFrame) -> DataFrame:
    """row, spans (sorted distinct (at, len)), ids (sorted texts of the items) of the rows with hits."""
    both = found.filter("at >= 0").groupBy("row").agg(F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("ids"))
    return both  # spans and ids are bounded by one text's words and the items


def contamination(docs: DataFrame, items: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    docs has doc_id and text, items has item_id and text; other columns are ignored. Rows with a null or repeated
    doc_id are judged each. Null and empty texts have no words and are never contaminated; an item without words has
    no window; repeated items count by their id. A document is contaminated if share * n_hit >= n_words and
    n_hit > 0. Empty tables give no rows, or no hits.
    """
    found, used = hits(docs, items, n)
    found = save(found, "hits")  # it is read twice
    discard(*used)
    covered = F.col("n_words") - F.aggregate(gaps(F.col("spans"), F.col("n_words")), F.lit(0), lambda total, x: total + x["n"])
    out = found.filter("at < 0").select("row", "doc_id", "n_words").join(spans_of(found), "row", "left")
    out = out.withColumn("n_hit", F.coalesce(covered, F.lit(0)).cast("long"))
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns, however they are named.

    A null doc_id is kept; rows that share a doc_id go together. An empty table stays empty.
    """
    return without(docs, contamination(docs, items, n, share).filter("contaminated"), "contaminated")


def remove_spans(docs: DataFrame, items: DataFrame, n: int = 13) -> DataFrame:
    """doc_id and clean_words: each document's words without those inside an occurrence of a test window.

    One row per row of docs; rows that share a doc_id must be equal, and those with a null doc_id or text stay
    whole (a null text has no words). Other columns are ignored; an empty table gives no rows.
    """
    found, used = hits(docs.filter("doc_id is not null"), items, n)
    found = save(found, "hits")
    discard(*used)
    spans = spans_of(found).join(found.filter("at < 0").select("row", "doc_id"), "row").groupBy("doc_id").agg(F.first("spans").alias("spans"))
    words = docs.select("doc_id", word_array(F.col("text")).alias("w")).join(spans, "doc_id", "left")
    kept = F.flatten(F.transform(gaps(F.col("spans"), F.size("w")), lambda x: F.slice("w", x["start"] + 1, x["n"])))
    return words.select("doc_id", F.when(F.col("spans").isNull(), F.col("w")).otherwise(kept).alias("clean_words"))
