"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard, langid, license, packing, phrases, pii, prefixes, repeats, sentencepieces, stages, topk, toxicity
from .common import read


def crc_mod(n: int) -> Column:
    """crc32 of the doc_id's decimal text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def op3_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_with_lines(read(spark, sf_dir, "documents"), license.known_licenses(spark))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.substring_dedup(read(spark, sf_dir, "documents"), batches=3).drop("kept")  # enough that runs are compacted


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(crc_mod(3) != 1))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (crc_mod(3) == 1).alias("held_out"), "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(crc_mod(5) != 0))
    out = langid.predict(docs, model)
    return out.select("doc_id", (crc_mod(5) == 0).alias("held_out"), "lang_pred", "score")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.pack_documents(spark, read(spark, sf_dir, "documents"), sf_dir)


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.to_integers(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("id % 20 = 0"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return sentencepieces.encode(read(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_tree(read(spark, sf_dir, "conversations"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_pii, op2_ngram_jaccard, op3_license_digest, op4_decontaminate, op5_substring_dedup, op6_line_dedup, op7_toxicity, op8_language_id, op9_best_fit_packing, op10_exact_topk, op11_sentencepiece, op12_conversation_trie, op13_phrases)}

_UPPER, _LOWER = decontaminate.UPPER, decontaminate.LOWER


def _canonical_sql(x: str) -> str:
    x = f"lower(replace(coalesce({x}, ''), '©', '(c)'))"
    x = f"regexp_replace({x}, '{license._COPYRIGHT.replace('(?md)', '(?m)')}', ' ', 'g')"
    x = f"replace({x}, 'https:', 'http:')"
    x = f"trim(regexp_replace({x}, '{license._MARKS}', ' ', 'g'), ' ')"
    x = f"(' ' || replace({x}, ' ', '  ') || ' ')"
    for old, new in sorted(license.SPELLINGS.items(), key=lambda p: ' ' in p[0] or '-' in p[0]):
        x = f"replace({x}, ' {re.sub('[ -]', '  ', old)} ', ' {re.sub('[ -]', '  ', new)} ')"
    return f"trim(replace({x}, '  ', ' '), ' ')"


def _quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_KNOWN_SQL = ", ".join(f"({_quote(k)}, {_quote(v)})" for k, v in [*license.KNOWN.items(), *((k, f"{t} {license.KNOWN[k]}") for k, ts in license.TITLES.items() for t in ts)])

SQL: dict[str, str] = {
    "op2_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY 1) USING (doc_id)""",
    "op3_license_digest": f"""
WITH known AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(license_id) AS license_id FROM (VALUES {_KNOWN_SQL}) t(license_id, text) GROUP BY 1),
d AS (SELECT doc_id, sha256({_canonical_sql("text")}) AS digest FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses FROM (
SELECT doc_id, sha256({_canonical_sql("text")}) AS digest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents)) JOIN known USING (digest) GROUP BY 1)
SELECT d.doc_id, d.digest, known.license_id, coalesce(n_lines, 0) AS n_lines, coalesce(line_licenses, '') AS line_licenses
FROM d LEFT JOIN known ON d.digest = known.digest AND d.digest <> sha256('') LEFT JOIN l USING (doc_id)""",
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
p AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM p JOIN g USING (n, gram)),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256 FROM h GROUP BY 1),
c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS q FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN i USING (doc_id) LEFT JOIN c USING (doc_id)""",
    "op5_substring_dedup": """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT g, min(doc_id) AS first FROM p GROUP BY 1),
r AS (SELECT doc_id, list(DISTINCT q) AS gone FROM (SELECT doc_id, unnest(range(i, i + 50)) AS q FROM p JOIN f USING (g) WHERE first < doc_id) GROUP BY 1),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT u.doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY i) AS kept FROM u LEFT JOIN r ON u.doc_id = r.doc_id WHERE r.gone IS NULL OR NOT list_contains(r.gone, i) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op6_line_dedup": """
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, raw, i, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x FROM l),
s AS (SELECT doc_id, i, x, row_number() OVER w AS pos, lead(x) OVER w AS y FROM t WHERE x <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT x, y, min((doc_id, pos)) AS first FROM s WHERE y IS NOT NULL GROUP BY 1, 2),
h AS (SELECT x, min((doc_id, pos)) AS first FROM s WHERE len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) >= 50 GROUP BY 1),
c AS (SELECT doc_id, unnest([pos, pos + 1]) AS pos FROM s JOIN f USING (x, y) WHERE (doc_id, pos) > first UNION SELECT doc_id, pos FROM s JOIN h USING (x) WHERE (doc_id, pos) > first),
g AS (SELECT DISTINCT s.doc_id, s.i FROM s JOIN c USING (doc_id, pos)),
k AS (SELECT t.doc_id, string_agg(raw, chr(10) ORDER BY t.i) AS kept FROM t LEFT JOIN g ON t.doc_id = g.doc_id AND t.i = g.i WHERE g.i IS NULL GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_lines, coalesce(m, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d
LEFT JOIN k USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM s GROUP BY 1) USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS m FROM g GROUP BY 1) USING (doc_id)""",
    "op10_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 64)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)) WHERE rank <= 20""",
    "op12_conversation_trie": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS INTEGER) AS i FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, CAST(xor(list_reduce([4294967295] || [CAST(ascii(z) AS BIGINT) FOR z IN string_split(CAST(conv_id AS VARCHAR), '')], lambda a, b: list_reduce([xor(a, b)] || range(8), lambda k, j: xor(k >> 1, 3988292384 * (k & 1)))), 4294967295) % 9 AS INTEGER) AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, 0 AS o, i, r, x FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND i <= h UNION ALL SELECT c.conv_id, 1, i, r, x FROM c JOIN t ON t.conv_id = c.conv_id AND i > h),
l AS (SELECT c.conv_id, coalesce(list((r, x) ORDER BY o, i) FILTER (r IS NOT NULL), []) AS s FROM c LEFT JOIN b USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d, s[:d] AS k, len(s) = d AS last FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM l)),
n AS (SELECT d AS depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256, (count(*) - 1) * CASE WHEN d > 0 THEN strlen(k[-1][2]) ELSE 0 END AS saved FROM p GROUP BY d, k),
u AS (SELECT n.depth, n.k, coalesce(count(*) FILTER (m.depth = n.depth + 1), 0) AS n_children, sum(m.saved) AS saved_tokens FROM n JOIN n m ON m.k[:n.depth] = n.k GROUP BY ALL),
v AS (SELECT n.depth, n.k, count(*) AS n_leaves FROM n JOIN u m ON m.k[:n.depth] = n.k AND m.n_children = 0 GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u USING (depth, k) JOIN v USING (depth, k) LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.k = n.k[:n.depth - 1]""",
    "op13_phrases": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS x FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(x, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30 OR k = 1),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
c AS (SELECT f.*, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
s AS (SELECT lang, k, phrase, a, w, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
t AS (SELECT s.*, l.a AS l, r.a AS r, CAST(CAST(2000000 AS HUGEINT) * s.a // (l.a + r.a) AS BIGINT) AS score FROM s JOIN f l ON l.lang = s.lang AND l.k = j AND l.phrase = x JOIN f r ON r.lang = s.lang AND r.k = s.k - j AND r.phrase = y),
b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT DISTINCT lang, part FROM (SELECT lang, a AS most, unnest(list_distinct(flatten([[array_to_string(w[o:o + m - 1], ' ') for o in range(1, k - m + 2)] for m in range(2, k)]))) AS part FROM c WHERE k > 2) JOIN c q USING (lang) WHERE q.phrase = part AND 100 * CAST(most AS HUGEINT) >= 80 * CAST(q.a AS HUGEINT))
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM b ANTI JOIN i ON b.lang = i.lang AND b.phrase = i.part) JOIN n USING (lang) WHERE rank <= 2000""",
}
