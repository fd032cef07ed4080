"""Classification and lookup against small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.matching import beginnings, constant_map, longest_found
from ..functions.nested import classify_first, classify_last
from ..functions.text import ascii_lower, first_group


def classify_records(df: DataFrame, col: str, rules: Sequence[tuple[str, str | None]], default: str | None, out: str = "type") -> DataFrame:
    """Type of the first pattern found in the lower-cased text; rows of a null type go."""
    cases = [(F.lower(col).rlike(p), t) for p, t in rules]
    return df.withColumn(out, classify_first(cases, default)).filter(F.col(out).isNotNull())


def classify_overrides(df: DataFrame, col: str, rules: Sequence[tuple[str, str, str]], default: str) -> DataFrame:
    """type and work (where the type's work is kept) of the last pattern found."""
    cases = [(F.col(col).rlike(p), t, w) for p, t, w in rules]
    return df.withColumn("type", classify_last([(c, t) for c, t, _ in cases], default)).withColumn("work", classify_last([(c, w) for c, _, w in cases], None))


def detect_language_word(col: Column, names: Mapping[str, str], default: str = "en") -> Column:
    """Code of the last listed language whose name is a word of the text, case as it stands."""
    return classify_last([(col.rlike(rf"\b{n}\b"), c) for n, c in names.items()], default)


def detect_subtitle_language(col: Column, names: Mapping[str, str]) -> Column:
    """Code of the last listed language before the word subtitles, in any case."""
    return classify_last([(col.rlike(rf"(?i)\b{n} subtitles"), c) for n, c in names.items()], None)


#: Literals, and bytes of them, up to which a gazetteer becomes constants of a plan; of more, literals are joined with what texts hold.
CONSTANT_LITERALS, CONSTANT_BYTES = 20_000, 1 << 20
#: Regular expressions that one projection tries.
TRIED_AT_ONCE = 100
#: Characters of a literal by which it is looked up in a join.
SEED = 8

_PLAIN = r"^(?:[^\\.^$*+?()\[\]{}|]|\\[^A-Za-z0-9|])+$"


def gazetteer_literals(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered places' literals (place, ignore_case, starts_word, ends_word, literal), and those that are other
    regular expressions (place, pattern).

    Literals are alternatives without signs of patterns, with \\b before or after them or (?i) before all of them.
    """
    ignore_case = F.col("pattern").startswith("(?i)")
    body = F.when(ignore_case, F.substr("pattern", F.lit(5))).otherwise(F.col("pattern"))
    parts = places.filter("pattern IS NOT NULL").select("_place", "pattern", ignore_case.alias("ignore_case"), F.transform(F.split(body, r"\|"), lambda x: F.struct(
        x.startswith(r"\b").alias("starts_word"), (x.endswith(r"\b") & (F.length(x) > 2)).alias("ends_word"), F.regexp_replace(x, r"^\\b|(?<=.)\\b$", "").alias("core"),
    )).alias("parts"))
    ascii_only = lambda p: ~(p["starts_word"] | p["ends_word"]) | ~p["core"].rlike(r"[^\x00-\x7F]")
    plain = F.forall("parts", lambda p: p["core"].rlike(_PLAIN) & ascii_only(p)) & ~F.col("pattern").contains(r"\|")
    text = F.regexp_replace("part.core", r"\\(.)", "$1")
    literals = parts.filter(plain).select("_place", "ignore_case", F.explode("parts").alias("part")).select("_place", "ignore_case", "part.starts_word", "part.ends_word", F.when(F.col("ignore_case"), ascii_lower(text)).otherwise(text).alias("literal"))
    return literals, parts.filter(~plain).select("_place", "pattern")


def _best_constant(text: Column, literals: Sequence) -> list[Column]:
    """For each way of matching, the lowest place of the literals that a text holds."""
    kinds: dict[tuple, dict[str, int]] = {}
    for p in literals:
        held = kinds.setdefault((p["ignore_case"], p["starts_word"], p["ends_word"]), {})
        held[p["literal"]] = min(p["_place"], held.get(p["literal"], p["_place"]))
    out = []
    for (ignore_case, starts_word, ends_word), held in kinds.items():
        lowest = {x: min(held[y] for y in own) for x, own in beginnings(list(held), ends_word).items()}
        found = longest_found(text, list(held), ignore_case, starts_word, ends_word)
        of = constant_map(lowest, "bigint").getItem
        out.append(F.array_min(F.transform(found, lambda x: of(x))))  # noqa: B023
    return out


def _best_joined(df: DataFrame, text: str, literals: DataFrame) -> DataFrame:
    """_text (the digest of a text) and _literal, the lowest place of the literals that it holds: the first characters of
    literals are joined with those at each place of the distinct texts, then the whole literals are compared."""
    seeded = literals.withColumns({"size": F.least(F.length("literal"), F.lit(SEED))}).withColumn("seed", ascii_lower(F.substr("literal", F.lit(1), F.col("size"))))
    sizes = [r["size"] for r in seeded.select("size").distinct().collect()]  # at most SEED
    texts = df.select(F.sha2(text, 256).alias("_text"), F.col(text).alias("_body")).filter("_body IS NOT NULL").distinct()
    at = texts.select("_text", "_body", F.explode(F.sequence(F.lit(1), F.greatest(F.length("_body"), F.lit(1)))).alias("at"))
    seeds = at.select("*", F.explode(F.array(*map(F.lit, sizes)) if sizes else F.array().cast("array<int>")).alias("size"))
    seeds = seeds.select("_text", "_body", "at", "size", ascii_lower(F.expr("substr(_body, at, size)")).alias("seed"))
    piece = F.expr("substr(_body, at, length(literal))")
    whole = F.when(F.col("ignore_case"), ascii_lower(piece)).otherwise(piece) == F.col("literal")
    word = lambda x: F.coalesce(x.rlike("^[A-Za-z0-9_]$"), F.lit(False))
    edge = lambda i: word(F.expr(f"CASE WHEN {i} > 1 THEN substr(_body, {i} - 1, 1) END")) != word(F.expr(f"substr(_body, {i}, 1)"))
    good = whole & (~F.col("starts_word") | edge("at")) & (~F.col("ends_word") | edge("(at + length(literal))"))
    return seeds.join(seeded, ["size", "seed"]).filter(good).groupBy("_text").agg(F.min("_place").alias("_literal"))


def gazetteer_match(df: DataFrame, key: str, text: str, places: DataFrame) -> DataFrame:
    """Rows with the first place (lowest priority, then pattern) whose regex pattern occurs in the text; null without any.

    places: priority, pattern and what is looked up. All literals of the table are looked for in one scan of each text (of
    more than CONSTANT_LITERALS, by a join of their first characters with those of the texts, without a pattern for
    each pair); patterns that are more than literals are tried one by one. Every row is matched by itself, whatever its key.
    """
    what = [c for c in places.columns if c not in ("priority", "pattern")]
    order = ["priority", "pattern", *what]
    numbered = places.filter("pattern IS NOT NULL").select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("_place"), "*")  # the gazetteer alone
    literals, patterns = gazetteer_literals(numbered)
    n, size = literals.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("literal")), F.lit(0))).first()
    out, lowest = df, []
    if n > CONSTANT_LITERALS or size > CONSTANT_BYTES:
        out = out.withColumn("_text", F.sha2(text, 256)).join(_best_joined(df, text, literals), "_text", "left")
        lowest.append(F.col("_literal"))
    elif n:
        lowest += _best_constant(F.col(text), literals.collect())
    tried = patterns.collect()
    for i in range(0, len(tried), TRIED_AT_ONCE):
        out = out.withColumn(f"_tried{i}", F.array_min(F.array(*[F.when(F.col(text).rlike(p["pattern"]), F.lit(p["_place"])) for p in tried[i : i + TRIED_AT_ONCE]])))
        lowest.append(F.col(f"_tried{i}"))
    best = F.array_min(F.array(*lowest)) if lowest else F.lit(None).cast("bigint")
    looked_up = numbered.select("_place", *[F.col(c).alias(f"_own_{c}") for c in what])
    return out.withColumn("_place", best).join(looked_up, "_place", "left").select(*df.columns, *[F.col(f"_own_{c}").alias(c) for c in what])


def age_band(keywords: Column, bands: Sequence[tuple[str, str]], default: str = "12+") -> Column:
    """Age range of the first tag that the keywords contain."""
    text = F.array_join(keywords, ",")
    return classify_first([(text.contains(tag), band) for tag, band in bands], default)


def member_name(df: DataFrame, key: str, known: DataFrame, out: str = "venue") -> DataFrame:
    """The key where the known set has it, else null."""
    side = known.select(F.col(key), F.col(key).alias(out)).distinct()
    return df.join(side, key, "left")


def choose_location(text: Column, pattern: str, here: Mapping[str, str], there: Mapping[str, str]) -> Column:
    """One of two fixed location structs; absent text counts as not matching."""
    make = lambda m: F.struct(*[F.lit(v).alias(k) for k, v in m.items()])
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), make(here)).otherwise(make(there))


def compose_name(theme: Column, categories: Column, neighbourhood: Column, city: Column) -> Column:
    """"theme: a/b in place"; absent parts are left out, the city stands in for the neighbourhood."""
    return F.concat(F.coalesce(F.concat(theme, F.lit(": ")), F.lit("")), F.coalesce(F.array_join(categories, "/"), F.lit("")), F.lit(" in "), F.coalesce(neighbourhood, city))


def extract_capture(col: Column, patterns: Sequence[str]) -> Column:
    """Group 1 of the first pattern that captures something."""
    return F.coalesce(*[first_group(col, p) for p in patterns])


def sport_from_slug(slug: Column, words: Mapping[str, str], segment: int = 4) -> Column:
    """The slug's fourth dash segment, else the sport of the first listed word in it."""
    return F.coalesce(F.nullif(F.try_element_at(F.split(slug, "-"), F.lit(segment)), F.lit("")), classify_first([(slug.contains(w), s) for w, s in words.items()], None))
