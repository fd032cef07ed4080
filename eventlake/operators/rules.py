"""Curation rules: an ordered table of tag, type, patch and delete rules, run as one projection.

Predicates are SQL over the record's base columns. They may use `m_<id>`, the outcome of an earlier rule, which has to be
listed in the rule's needs; they never read keywords or types that other rules write. Deletes are one leading filter, each
outcome is computed once, tags are appended in rule order, and the last matching type wins.

Long lists of words are data too: any_of names substrings of lower-cased columns, equals names whole lower-cased values.
All substrings that any rule looks for in a column are found in one scan of it.

A rule that reads `record` sees the whole serialized record as the rules before it left it, tags and types included, with
characters beyond ASCII escaped. The projection is staged there: what earlier rules do is done, then the record is written as text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.matching import meanings_found
from ..functions.text import ascii_json


@dataclass(frozen=True)
class Rule:
    """any_of and equals (by column) have to hold besides the predicate; of one column's list any entry does."""

    rule_id: int
    action: str  # tag, type, set or delete
    predicate: str = "TRUE"
    value: str | None = None
    fields: Mapping[str, str] = field(default_factory=dict)
    needs: tuple[int, ...] = ()
    any_of: Mapping[str, Sequence[str]] = field(default_factory=dict)
    equals: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def reads_record(self) -> bool:
        return bool(re.search(r"\brecord\b", self.predicate))


def check_rules(rules: Sequence[Rule]) -> None:
    """Refuse unknown actions, repeated ids, and reads of outcomes that are undeclared, later or deletes."""
    seen: dict[int, Rule] = {}
    for r in rules:
        if r.action not in ("tag", "type", "set", "delete") or r.rule_id in seen:
            raise ValueError(f"rule {r.rule_id}: unknown action or repeated id")
        used = {int(x) for x in re.findall(r"\bm_([0-9]+)\b", r.predicate)}
        if used != set(r.needs) or any(x not in seen or seen[x].action == "delete" for x in used):
            raise ValueError(f"rule {r.rule_id}: reads {sorted(used)}, declares {sorted(r.needs)}; both must be earlier rules that keep rows")
        if r.action == "delete" and used and not r.reads_record:
            raise ValueError(f"rule {r.rule_id}: deletes run first and can't depend on other rules")
        if not r.reads_record and re.search(r"\bkeywords\b", r.predicate) and any(x.action == "tag" and x.value and x.value.lower() in r.predicate.lower() and x.rule_id not in used for x in seen.values()):
            raise ValueError(f"rule {r.rule_id}: looks for the tag of an earlier rule without declaring it")
        seen[r.rule_id] = r


def drop_where(df: DataFrame, pred: Column) -> DataFrame:
    """Delete matching rows; a null predicate keeps the row."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def set_type(df: DataFrame, pred: Column, type_: str, col: str = "type") -> DataFrame:
    """Replace the type where it is present."""
    return df.withColumn(col, F.when(pred & F.col(col).isNotNull(), F.lit(type_)).otherwise(F.col(col)))


def set_fields(df: DataFrame, pred: Column, col: str, values: Mapping[str, Column]) -> DataFrame:
    """Replace nested fields of a struct column, each only where it is not null."""
    new = F.col(col)
    for path, value in values.items():
        new = new.withField(path, F.when(F.coalesce(pred, F.lit(False)) & F.col(f"{col}.{path}").isNotNull(), value).otherwise(F.col(f"{col}.{path}")))
    return df.withColumn(col, new)


def _found(rules: Sequence[Rule]) -> dict[str, Column]:
    """By column, the rules of which it contains a literal, found in one scan."""
    words: dict[str, dict[str, list[int]]] = {}
    for r in rules:
        for name, some in r.any_of.items():
            for x in some:
                words.setdefault(name, {}).setdefault(x, []).append(r.rule_id)
    return {f"_in_{name}": meanings_found(F.lower(name), some, "int") for name, some in words.items()}


def _holds(r: Rule) -> Column:
    """Whether a rule's conditions hold; null counts as not."""
    out = F.expr(r.predicate)
    for name in r.any_of:
        out = out & F.array_contains(f"_in_{name}", r.rule_id)
    for name, some in r.equals.items():
        out = out & F.lower(name).isin(list(some))
    return F.coalesce(out, F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule], keywords: str = "keywords", type_: str = "type") -> DataFrame:
    """Run a checked rule table; the result has the columns of df. Rows without keywords are never tagged.

    Everything is one scan without a shuffle; rules that read `record` add stages to its projection, in order.
    """
    check_rules(rules)
    columns = df.columns
    out = df.withColumns(found) if (found := _found(rules)) else df
    for r in rules:
        if r.action == "delete" and not r.reads_record:
            out = drop_where(out, _holds(r))
    kept = [r for r in rules if r.action != "delete" or r.reads_record]
    pending = [r for r in kept if not r.reads_record]
    done: set[int] = set()

    def compute(out: DataFrame) -> DataFrame:
        """Outcomes of the rules whose needs are known, in one projection for each level of dependence."""
        nonlocal pending
        while ready := [r for r in pending if set(r.needs) <= done]:
            out = out.withColumns({f"m_{r.rule_id}": _holds(r) for r in ready})
            done.update(r.rule_id for r in ready)
            pending = [r for r in pending if r.rule_id not in done]
        return out

    now: dict[str, str] = {}  # columns that hold what rules made of others

    def perform(out: DataFrame, some: Sequence[Rule]) -> DataFrame:
        """What rules do, in order, kept beside the base columns, which later predicates read."""
        new: dict[str, Column] = {}
        value = lambda c: new.get(c, F.col(now.get(c, c)))
        m = lambda r: F.col(f"m_{r.rule_id}")
        tags = [F.when(m(r), F.lit(r.value)) for r in some if r.action == "tag"]
        if tags:
            new[keywords] = F.concat(value(keywords), F.array_compact(F.array(*tags)))
        for r in some:
            if r.action == "type" and type_ in columns:
                new[type_] = F.when(m(r) & value(type_).isNotNull(), F.lit(r.value)).otherwise(value(type_))
            for name, sql in r.fields.items() if r.action == "set" else ():
                new[name] = F.when(m(r) & F.col(name).isNotNull(), F.expr(sql)).otherwise(value(name))
        now.update({c: f"_now_{c}" for c in new})
        return out.withColumns({f"_now_{c}": x for c, x in new.items()}) if new else out

    out, waiting = compute(out), []
    for r in kept:
        if r.reads_record:
            out = perform(out, waiting)
            waiting = []
            whole = F.struct(*[F.col(now.get(c, c)).alias(c) for c in columns])
            row = F.struct(*out.columns, F.to_json(whole).alias("record"))
            out = out.select(F.inline(F.array(row)))  # a generator, which the optimizer does not look through: the record is written once
            out = out.select(F.inline(F.array(F.struct(*[c for c in out.columns if c != "record"], ascii_json(F.col("record")).alias("record")))))
            out = out.withColumn(f"m_{r.rule_id}", _holds(r)).drop("record")
            if r.action == "delete":
                out = out.filter(~F.col(f"m_{r.rule_id}"))
            done.add(r.rule_id)
            out = compute(out)
        if r.action != "delete":
            waiting.append(r)
    return perform(out, waiting).select(*[F.col(now.get(c, c)).alias(c) for c in columns])


def explode_offers(df: DataFrame, offers: str, least: int) -> DataFrame:
    """One row per offer whose price, read as a whole number, is at least `least`."""
    rest = [c for c in df.columns if c != offers]
    out = df.select(*rest, F.explode(offers).alias("offer"))
    price = F.col("offer.price").try_cast("double").try_cast("int")
    return out.filter(price >= least).withColumn("price_int", price)
