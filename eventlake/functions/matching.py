"""One scan for many literal texts: a set of them as one regular expression, and what it finds in a text."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ascii_lower, tree_pattern


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def beginnings(literals: Sequence[str], ends_word: bool = False) -> dict[str, list[str]]:
    """Of each literal all that are found with it at one place: itself and those that it begins with (ends_word: and that end
    at a word's edge in it)."""
    known = set(literals)
    edge = lambda x, n: not ends_word or n == len(x) or _word(x[n - 1]) != _word(x[n])
    return {x: [x[:n] for n in range(1, len(x) + 1) if x[:n] in known and edge(x, n)] for x in known}


def longest_found(text: Column, literals: Sequence[str], ignore_case: bool = False, starts_word: bool = False, ends_word: bool = False) -> Column:
    """Distinct longest literals at every place of a text, in one scan; with ignore_case they have to be in lower case and
    only A-Z are folded. Literals that have to start or end at a word's edge may hold ASCII only."""
    edge = lambda at: r"\b" if at else ""
    pattern = f"{'(?i)' if ignore_case else ''}(?=({edge(starts_word)}{tree_pattern(literals)}{edge(ends_word)}))"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, ascii_lower) if ignore_case else found)


def constant_map(values: Mapping[str, object], kind: str) -> Column:
    """A constant map from texts to values of a type."""
    return F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")


def all_found(text: Column, literals: Sequence[str]) -> Column:
    """The literals that a text contains, as an array of distinct ones, in one scan."""
    return meanings_found(text, {x: [x] for x in literals}, "string")


def meanings_found(text: Column, meanings: Mapping[str, Sequence], kind: str) -> Column:
    """What the literals that a text contains mean, as an array of distinct values of a type, in one scan."""
    inside = {x: list(dict.fromkeys(m for y in own for m in meanings[y])) for x, own in beginnings(list(meanings)).items()}
    of = constant_map(inside, f"array<{kind}>").getItem
    return F.array_distinct(F.flatten(F.transform(longest_found(text, list(meanings)), lambda x: of(x))))
