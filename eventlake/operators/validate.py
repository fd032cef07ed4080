"""Validation of records and reports about them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Contexts that a record may name.
CONTEXTS = ("http://schema.org", "https://schema.org", "http://schema.org/", "https://schema.org/")


@dataclass(frozen=True)
class Shape:
    """What a JSON value may look like, at every depth: one of some types (string, number, integer, boolean, object, array,
    null), one of some values, a pattern and a least length of strings, properties that an object has to have, the shape of
    each item of an array and of each property that an object has, or one of several shapes (any_of)."""

    types: Sequence[str] = ()
    items: Shape | None = None
    properties: Mapping[str, Shape] = field(default_factory=dict)
    any_of: Sequence[Shape] = ()
    required: Sequence[str] = ()
    enum: Sequence[str | float | bool | None] = ()
    pattern: str | None = None
    min_length: int | None = None


#: What each kind of fault is called in messages; the first three are errors, the others warnings.
FAULTS = {"required": "is required", "type": "is of a wrong type", "enum": "is not allowed", "pattern": "does not match", "minLength": "is too short", "anyOf": "fits no alternative"}
ERRORS = ("required", "type", "enum")
_FAULT = "array<struct<path: string, kind: string>>"


class _Value:
    """A place in a JSON value: the root, or a member of another place. Once bound, its columns are usable.

    One cast of the root gives the members of all objects below it as nested structs, whose leaves are variants; places with
    members are variants only where that says that they are no objects.
    """

    def __init__(self, root: _Value | None = None, path: str = "$"):
        self.root, self.path = root or self, path
        self.members: dict[str, _Value] = {}
        self.whole = self.read = self.kind_read = self.list_read = None
        self.with_kind = self.with_object = self.with_list = False

    def member(self, name: str) -> _Value:
        return self.members.setdefault(name, _Value(self.root, f'{self.path}["{name}"]'))

    def by_name(self) -> dict[str, _Value]:
        """The members that a struct can tell apart by name, whatever the case."""
        first: dict[str, tuple[str, _Value]] = {}
        for name, v in self.members.items():
            first.setdefault(name.casefold(), (name, v))
        return dict(first.values())

    def every(self) -> list[_Value]:
        return [self, *[x for m in self.members.values() for x in m.every()]]

    def struct(self) -> str:
        own = ", ".join(f"`{name.replace('`', '``')}`: {v.struct()}" for name, v in self.by_name().items())
        return f"struct<{own}>" if own else "variant"

    def bind(self, read: Column | None) -> None:
        """Take what the root's cast gives, here and below."""
        self.read = read
        named = self.by_name()
        for name, v in self.members.items():
            v.bind(None if read is None or name not in named else read[name])

    @property
    def variant(self) -> Column:
        if self is self.root:
            return self.whole
        return self.read if self.read is not None and not self.members else F.try_variant_get(self.root.whole, self.path, "variant")

    def is_null(self) -> Column:
        return self.read.isNull() & self.variant.isNull() if self.read is not None and self.members else self.variant.isNull()

    def is_object(self) -> Column:
        return self.read.isNotNull() if self.read is not None and self.members else self.kind.startswith("OBJECT")

    @property
    def kind(self) -> Column:
        return self.kind_read if self.kind_read is not None else self.find_kind()

    def find_kind(self) -> Column:
        """The variant's type; what is likely to be an object or list is not looked into."""
        out = F.schema_of_variant(self.variant)
        if self.with_list:
            out = F.when(self.listed().isNotNull(), "ARRAY").otherwise(out)
        if self.with_object and not self.members:
            out = F.when(F.try_variant_get(self.variant, "$", "struct<>").isNotNull(), "OBJECT").otherwise(out)
        return F.when(self.read.isNotNull(), "OBJECT").otherwise(out) if self.read is not None and self.members else out

    def listed(self) -> Column:
        return self.list_read if self.list_read is not None else F.try_variant_get(self.variant, "$", "array<variant>")

    def is_one_of(self, *types: str) -> Column:
        """Whether it is of one of some JSON types; null if absent."""
        plain = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}

        def of(names: Sequence[str]) -> list[Column]:
            found = [self.kind.isin([plain[x] for x in names if x in plain])] if set(names) & set(plain) else []
            found += [self.is_object()] if "object" in names else []
            return found + ([self.kind.startswith("ARRAY")] if "array" in names else [])

        tests = of(types) + ([~reduce(or_, of((*plain, "object", "array")))] if "number" in types else [])
        found = reduce(or_, tests or [F.lit(False)])
        return F.when(~self.is_null(), found) if self.members else found  # without members, the kind of an absent one is null


def _places(value: _Value, shape: Shape) -> None:
    """Make the places that a shape names, and note what has to be known of them."""
    value.with_object |= "object" in shape.types
    value.with_list |= shape.items is not None
    value.with_kind |= bool(shape.types or shape.enum) or shape.pattern is not None or shape.min_length is not None or shape.items is not None
    for name in shape.required:
        value.member(name)
    for name, own in shape.properties.items():
        _places(value.member(name), own)
    for own in shape.any_of:
        _places(value, own)


def _let(columns: dict[str, Column], f: Callable[[Column], Column]) -> Column:
    """f of a struct of columns that are evaluated once, however often f names them."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])), f), F.lit(0))


def _readings(root: _Value) -> Iterator[dict[str, Column]]:
    """What to evaluate once, in turns: the members below the bound root, and then their lists and kinds. Each turn is sent
    a function that gives the evaluated columns by name."""
    if root.members:
        got = yield {"read": F.try_variant_get(root.whole, "$", root.struct())}
        root.bind(got("read"))
    some = {f"l{i}": v for i, v in enumerate(root.every()) if v.with_list}
    if some:
        got = yield {name: v.listed() for name, v in some.items()}
        for name, v in some.items():
            v.list_read = got(name)
    some = {f"k{i}": v for i, v in enumerate(root.every()) if v.with_kind and not v.members}
    if some:
        got = yield {name: v.find_kind() for name, v in some.items()}
        for name, v in some.items():
            v.kind_read = got(name)


def _bound(value: Column, root: _Value, f: Callable[[], Column]) -> Column:
    """f(), where all readings of a value are each evaluated once."""
    turns = _readings(root)

    def turn(got: Callable[[str], Column] | None) -> Column:
        try:
            columns = turns.send(got)
        except StopIteration:
            return f()
        return _let(columns, lambda x: turn(lambda name: x[name]))

    def start(x: Column) -> Column:
        root.whole = x
        return turn(None)

    return F.get(F.transform(F.array(value), start), F.lit(0))


def _own_faults(value: _Value, shape: Shape) -> list[tuple[Column, str, str]]:
    """What can be wrong with a value itself: when it is, the name of the property it is about if any, the kind of fault."""
    text, out = F.try_variant_get(value.variant, "$", "string"), []
    if shape.types:
        good = value.is_one_of(*shape.types)
        if "integer" in shape.types:
            number = F.try_variant_get(value.variant, "$", "double")
            good = (value.kind == "BIGINT") | good | (value.is_one_of("number") & (number == F.floor(number)))
        out.append((~good, "", "type"))
    if shape.enum:
        texts, flags = [x for x in shape.enum if isinstance(x, str)], [x for x in shape.enum if isinstance(x, bool)]
        numbers = [json.dumps(x) for x in shape.enum if isinstance(x, (int, float)) and not isinstance(x, bool)]
        tests = [value.is_one_of("string") & text.isin(texts)] if texts else []
        tests += [value.is_one_of("boolean") & F.try_variant_get(value.variant, "$", "boolean").isin(flags)] if flags else []
        tests += [value.is_one_of("number") & F.to_json(value.variant).isin(numbers)] if numbers else []
        tests += [value.is_one_of("null")] if None in shape.enum else []
        out.append((~reduce(or_, tests), "", "enum"))
    if shape.pattern is not None:
        out.append((value.is_one_of("string") & ~text.rlike(shape.pattern), "", "pattern"))
    if shape.min_length is not None:
        out.append((value.is_one_of("string") & (F.length(text) < shape.min_length), "", "minLength"))
    return out + [(value.is_one_of("object") & value.member(name).is_null(), name, "required") for name in shape.required]


def _wrong(value: _Value, shape: Shape) -> Column:
    """Whether a bound value has a fault; false if it is absent."""
    tests = [bad for bad, _, _ in _own_faults(value, shape)] + [_wrong(value.member(name), own) for name, own in shape.properties.items()]
    if shape.items is not None:
        tests.append(F.exists(value.listed(), lambda x: ~fits(x, shape.items)))
    if shape.any_of:
        tests.append(~value.is_null() & reduce(and_, [_wrong(value, own) for own in shape.any_of]))
    return reduce(or_, [F.coalesce(x, F.lit(False)) for x in tests], F.lit(False))


def _told(value: _Value, shape: Shape, path: Column) -> list[tuple[Column | None, Column]]:
    """Faults of a bound value in order: when there is one and the fault, or None and an array of faults."""
    at = lambda name: F.concat(path, F.lit(f".{name}")) if name else path
    fault = lambda bad, name, kind: (bad, F.struct(at(name).alias("path"), F.lit(kind).alias("kind")))
    out = [fault(*x) for x in _own_faults(value, shape)]
    for name, own in shape.properties.items():
        out += _told(value.member(name), own, at(name))
    if shape.items is not None:
        inner = F.transform(value.listed(), lambda x, i: faults(x, shape.items, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        out.append((None, F.coalesce(F.flatten(inner), F.array().cast(_FAULT))))
    if shape.any_of:
        out.append(fault(~value.is_null() & reduce(and_, [_wrong(value, own) for own in shape.any_of]), "", "anyOf"))
    return out


def faults(value: Column, shape: Shape, path: Column) -> Column:
    """What is wrong with a variant: an array of the JSON path and the kind of each fault, outer ones first.

    The shape becomes one expression, whatever its depth, which reads each place of the value once. What a shape doesn't name
    is free and an absent value has no faults; null is a value. Of alternatives only that none fits is told.
    """
    root = _Value()
    _places(root, shape)

    def every() -> Column:
        runs = groupby(_told(root, shape, path), key=lambda x: x[0] is None)
        arrays = [x for many, some in runs for x in ([x for _, x in some] if many else [F.array_compact(F.array(*[F.when(bad, x) for bad, x in some]))])]
        return F.concat(*arrays) if len(arrays) > 1 else arrays[0] if arrays else F.array().cast(_FAULT)

    return _bound(value, root, every)


def with_faults(df: DataFrame, values: Mapping[str, Column], shapes: Mapping[str, Shape], out: str) -> DataFrame:
    """Add the faults of several variants, each by the name its paths begin with, as one array.

    The readings are columns of their own, in one projection for each turn, which is compiled; in a lambda function it is not.
    """
    roots, none, before = {name: _Value() for name in shapes}, F.array().cast(_FAULT), list(df.columns)
    df = df.withColumns({f"_{out}_{i}": values[name] for i, name in enumerate(shapes)})
    turns: dict[int, tuple[Iterator, Callable | None]] = {}
    for i, (name, shape) in enumerate(shapes.items()):
        _places(roots[name], shape)
        roots[name].whole = F.col(f"_{out}_{i}")
        turns[i] = (_readings(roots[name]), None)
    while turns:
        columns = {}
        for i, (turn, got) in list(turns.items()):
            try:
                some = turn.send(got)
            except StopIteration:
                del turns[i]
                continue
            columns |= {f"_{out}_{i}_{name}": x for name, x in some.items()}
            turns[i] = (turn, lambda name, i=i: F.col(f"_{out}_{i}_{name}"))
        df = df.withColumns(columns) if columns else df
    found = [x if bad is None else F.when(bad, F.array(x)).otherwise(none) for name, shape in shapes.items() for bad, x in _told(roots[name], shape, F.lit(name))]
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in before], (F.concat(none, *found)).alias(out))


def fits(value: Column, shape: Shape) -> Column:
    """Whether a variant has a shape."""
    root = _Value()
    _places(root, shape)
    return _bound(value, root, lambda: ~_wrong(root, shape))


@dataclass
class Checks:
    """Which faults are errors (required, numbers, allowed) and which are warnings (patterns, lengths); those of shapes are
    either by their kind, at every depth. Columns of shapes hold JSON text."""

    required: Sequence[str] = ()
    numbers: Sequence[str] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    patterns: Mapping[str, str] = field(default_factory=dict)
    min_length: Mapping[str, int] = field(default_factory=dict)
    shapes: Mapping[str, Shape] = field(default_factory=dict)


def validate_records(df: DataFrame, checks: Checks) -> DataFrame:
    """Add errors and warnings, arrays of messages in the order of the checks. Absent values only fail required.

    Faults inside a column of a shape are told with their path, such as "offers[1].price is required".
    """
    errors = [F.when(F.col(c).isNull(), F.lit(f"{c} is required")) for c in checks.required]
    errors += [F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull(), F.lit(f"{c} is not a number")) for c in checks.numbers]
    errors += [F.when(~F.col(c).isin(list(v)), F.lit(f"{c} is not allowed")) for c, v in checks.allowed.items()]
    warnings = [F.when(~F.col(c).rlike(p), F.lit(f"{c} does not match")) for c, p in checks.patterns.items()]
    warnings += [F.when(F.length(c) < n, F.lit(f"{c} is too short")) for c, n in checks.min_length.items()]
    pack = lambda xs: F.array_compact(F.array(*xs)).cast("array<string>") if xs else F.array().cast("array<string>")
    if not checks.shapes:
        return df.withColumn("errors", pack(errors)).withColumn("warnings", pack(warnings))
    called = F.create_map(*[F.lit(x) for kv in FAULTS.items() for x in kv])
    told = lambda good: F.transform(F.filter("_faults", good), lambda x: F.concat_ws(" ", x["path"], F.element_at(called, x["kind"])))
    out = with_faults(df, {c: F.try_parse_json(c) for c in checks.shapes}, checks.shapes, "_faults")
    out = out.withColumn("errors", F.concat(pack(errors), told(lambda x: x["kind"].isin(*ERRORS)))).withColumn("warnings", F.concat(pack(warnings), told(lambda x: ~x["kind"].isin(*ERRORS))))
    return out.drop("_faults")


def check_required_semantic(df: DataFrame, context: str = "context", name: str = "name") -> DataFrame:
    """Add semantic_error: an unknown context or a null name; null if neither."""
    known = F.coalesce(F.col(context).isin(list(CONTEXTS)), F.lit(False))
    return df.withColumn("semantic_error", F.when(~known, F.lit("unknown context")).when(F.col(name).isNull(), F.lit("name is missing")))


def _percent(n: Column, total: Column) -> Column:
    return F.round(100 * n / F.nullif(total, F.lit(0)), 1)


def validation_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """total, valid, invalid, warned and their percentages; percentages of no rows are null."""
    bad, warned = F.size("errors") > 0, F.size("warnings") > 0
    out = df.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("invalid"), F.count_if(warned).alias("warned"))
    return out.withColumns({f"{c}_pct": _percent(F.col(c), F.col("total")) for c in ("valid", "invalid", "warned")})


def validation_report(df: DataFrame) -> DataFrame:
    """Rows with an error or a warning."""
    return df.filter((F.size("errors") > 0) | (F.size("warnings") > 0))


def split_bad_json(df: DataFrame, raw: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose JSON parses, and the others."""
    good = F.col(raw).isNotNull() & F.try_parse_json(raw).isNotNull()
    return df.filter(good), df.filter(~good)


def count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def count_modified(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """How many records of both tables differ in any of the columns."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return before.alias("a").join(after.alias("b"), key).agg(F.count_if(changed).alias("n_modified"), F.count("*").alias("n"))


def tag_counts(df: DataFrame, keywords: str = "keywords") -> DataFrame:
    return df.select(F.explode(keywords).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows in which every required column is present, and not blank if it is text."""
    for c in required:
        df = df.filter(F.col(c).isNotNull())
        if df.schema[c].dataType.typeName() == "string":
            df = df.filter(F.trim(c) != "")
    return df
