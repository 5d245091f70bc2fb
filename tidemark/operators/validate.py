"""Validation of records against a JSON Schema, compiled to Catalyst predicates."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import temporal as D
from tidemark.functions.keys import META_FIELDS, NATURAL_KEY
from tidemark.functions.paths import get_raw
from tidemark.functions.values import (
    ARRAY,
    MAP,
    canonical_text,
    is_variant,
    scalar_text,
    settle,
    to_variant,
)

# JSON Schema keywords that only describe.
_ANNOTATIONS = {
    "$schema", "$id", "id", "$comment", "title", "description", "default", "examples", "readOnly",
    "writeOnly", "deprecated",
}
_TYPES = ("null", "boolean", "number", "integer", "string", "object", "array")


@dataclass(frozen=True)
class Rule:
    """``bad`` is true where a present value breaks the rule, false or NULL elsewhere."""

    bad: Column
    message: str


@dataclass(frozen=True)
class Value:
    """A VARIANT with its kind (as schema_of_variant begins) and its text as a string.

    The parts may be columns computed beforehand, so that many rules share them."""

    v: Column
    kind: Column
    text: Column

    @classmethod
    def of(cls, v: Column) -> Value:
        return cls(v, _kind(v), v.cast("string"))

    @classmethod
    def typed(cls, col: Column, dtype: T.DataType | None) -> Value:
        """A typed column. Its kind is known but for NULL, so most rules fold to a null check."""
        if is_variant(dtype):
            v = F.coalesce(col, F.parse_json(F.lit("null")))
            return cls.of(v)
        kind = F.when(col.isNull(), "VOID").otherwise(_kind_of(dtype))
        return cls(to_variant(col, dtype), kind, scalar_text(col, dtype))


def _kind(v: Column) -> Column:
    """Kind of a VARIANT. Of an object its own members are looked at, not spelled out as schema_of_variant does."""
    return F.when(v.try_cast(MAP).isNotNull(), "OBJECT<").otherwise(F.schema_of_variant(v))


def _kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StructType, T.MapType)):
        return "OBJECT<"
    if isinstance(dtype, T.ArrayType):
        return "ARRAY<"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL("
    return "BIGINT" if isinstance(dtype, T.IntegralType) else "STRING"


def _is_type(x: Value, name: str) -> Column:
    if name == "null":
        return x.kind == "VOID"
    if name == "boolean":
        return x.kind == "BOOLEAN"
    if name == "string":
        return x.kind == "STRING"
    if name == "object":
        return x.kind.startswith("OBJECT<")
    if name == "array":
        return x.kind.startswith("ARRAY<")
    number = x.kind.isin("BIGINT", "DOUBLE", "FLOAT") | x.kind.startswith("DECIMAL(")
    if name == "number":
        return number
    d = x.v.try_cast("double")
    return number & ((x.kind == "BIGINT") | (F.rint(d) == d))


def _has_type(x: Value, types: str | list[str]) -> Column:
    names = [types] if isinstance(types, str) else list(types)
    unknown = [n for n in names if n not in _TYPES]
    if unknown or not names:
        raise ValueError(f"unknown type in schema: {types}")
    ok = _is_type(x, names[0])
    for name in names[1:]:
        ok = ok | _is_type(x, name)
    return ok


def _long_enough(x: Value, n: int) -> Column:
    return (x.kind != "STRING") | (F.char_length(x.text) >= n)


def _has_format(x: Value, fmt: str) -> Column:
    if fmt == "date-time":
        ok = D.is_date_time(x.text)
    elif fmt == "date":
        ok = D.is_date(x.text)
    else:
        raise ValueError(f"unsupported format in schema: {fmt!r}")
    return (x.kind != "STRING") | ok


def check_type(v: Column, types: str | list[str]) -> Column:
    """True where a present VARIANT has one of the types; NULL where it is absent."""
    return _has_type(Value.of(v), types)


def check_min_length(v: Column, n: int) -> Column:
    """True unless the value is a string of fewer than ``n`` characters."""
    return _long_enough(Value.of(v), n)


def check_format(v: Column, fmt: str) -> Column:
    """True unless the value is a string that is not of the format; formats are strict."""
    return _has_format(Value.of(v), fmt)


def _dumps(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _plain(value):
    """A constant with its numbers spelled as canonical_text does: 1.0 is 1."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else value


def _multiple_of(x: Value, step) -> Column:
    """True unless the number is a multiple, worked out from its digits, whatever the point's place.

    What is too long for 38 digits counts as no multiple, since nothing unchecked may pass."""
    exact = Decimal(str(step))
    if exact <= 0:
        raise ValueError(f"multipleOf must be above 0, got {step}")
    places = max(0, -exact.normalize().as_tuple().exponent)
    whole = int(exact.scaleb(places))
    parts = r"^-?([0-9]+)(?:\.([0-9]+))?$"

    def fits(text: Column) -> Column:
        digits, decimals = F.regexp_extract(text, parts, 1), F.regexp_extract(text, parts, 2)
        scaled = F.concat(digits, F.rpad(decimals, places, "0")).try_cast("decimal(38,0)")
        return (F.length(decimals) <= places) & (scaled % F.lit(str(whole)).cast("decimal(38,0)") == 0)

    # Named by a lambda, so that the text is written once and not for each of its parts.
    return ~F.coalesce(F.transform(F.array(canonical_text(x.v)), fits)[0], F.lit(False))


def _equals_any(x: Value, values: list) -> Column:
    """True where the value is one of some constants; only nested ones are compared as JSON."""
    ok = F.lit(False)
    strings = [c for c in values if isinstance(c, str)]
    booleans = [str(c).lower() for c in values if isinstance(c, bool)]
    numbers = [float(c) for c in values if isinstance(c, (int, float)) and not isinstance(c, bool)]
    nested = [_dumps(_plain(c)) for c in values if isinstance(c, (list, dict))]
    if strings:
        ok = ok | ((x.kind == "STRING") & x.text.isin(*strings))
    if booleans:
        ok = ok | ((x.kind == "BOOLEAN") & x.text.isin(*booleans))
    if numbers:
        ok = ok | (_has_type(x, "number") & x.v.try_cast("double").isin(*numbers))
    if nested:
        ok = ok | canonical_text(x.v).isin(*nested)
    if None in values:
        ok = ok | (x.kind == "VOID")
    return ok


def _number_rule(x: Value, keyword: str, bound) -> Column:
    d = x.v.try_cast("double")
    if keyword == "minimum":
        broken = d < float(bound)
    elif keyword == "maximum":
        broken = d > float(bound)
    elif keyword == "exclusiveMinimum":
        broken = d <= float(bound)
    elif keyword == "exclusiveMaximum":
        broken = d >= float(bound)
    else:
        broken = _multiple_of(x, bound)
    return _has_type(x, "number") & broken


_NUMBER_KEYWORDS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf")
_KNOWN = {
    "type", "properties", "format", "minLength", "maxLength", "pattern", "enum", "const", "required",
    "items", "minItems", "maxItems", "uniqueItems", "additionalProperties", "minProperties", "maxProperties",
    "anyOf", "oneOf", "allOf", "not", *_NUMBER_KEYWORDS,
}


def _check_keywords(schema: Mapping, label: str) -> None:
    unknown = set(schema) - _KNOWN - _ANNOTATIONS
    if unknown:
        raise ValueError(f"unsupported keyword at {label}: {sorted(unknown)}")
    if "items" in schema and not isinstance(schema["items"], Mapping):
        raise ValueError(f"unsupported items list at {label}")
    for keyword in ("anyOf", "oneOf", "allOf"):
        if keyword in schema and not schema[keyword]:
            raise ValueError(f"empty {keyword} at {label}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"unsupported additionalProperties at {label}")


def _own_rules(
    x: Value, schema: Mapping, label: str, child: Callable[[str], Column], names: Column
) -> list[Rule]:
    """Rules of one schema node without those of its properties.

    ``child`` is NULL where a property is absent, ``names`` lists the keys an object holds."""
    _check_keywords(schema, label)
    rules: list[Rule] = []
    add = lambda bad, message: rules.append(Rule(bad, f"{label}: {message}"))

    if "type" in schema:
        expected = schema["type"]
        shown = expected if isinstance(expected, str) else "|".join(expected)
        add(~_has_type(x, expected), f"type is not {shown}")
    if "minLength" in schema:
        add(~_long_enough(x, schema["minLength"]), f"shorter than {schema['minLength']}")
    if "maxLength" in schema:
        long = F.char_length(x.text) > schema["maxLength"]
        add(_has_type(x, "string") & long, f"longer than {schema['maxLength']}")
    if "pattern" in schema:
        add(_has_type(x, "string") & ~x.text.rlike(schema["pattern"]),
            f"does not match {schema['pattern']}")
    if "format" in schema:
        add(~_has_format(x, schema["format"]), f"is not a {schema['format']}")
    if "enum" in schema:
        add(x.kind.isNotNull() & ~_equals_any(x, schema["enum"]), "is not one of the allowed values")
    if "const" in schema:
        add(x.kind.isNotNull() & ~_equals_any(x, [schema["const"]]), "is not the constant")
    for keyword in _NUMBER_KEYWORDS:
        if keyword in schema:
            add(_number_rule(x, keyword, schema[keyword]), f"breaks {keyword} {schema[keyword]}")

    array = x.v.try_cast(ARRAY)
    if "minItems" in schema:
        add(F.size(array) < schema["minItems"], f"fewer than {schema['minItems']} items")
    if "maxItems" in schema:
        add(F.size(array) > schema["maxItems"], f"more than {schema['maxItems']} items")
    if "items" in schema:
        add(~F.forall(array, lambda i: ~_any_bad(i, schema["items"])), "an item is invalid")

    if schema.get("uniqueItems", False):
        spelled = F.transform(array, canonical_text)
        add(F.size(F.array_distinct(spelled)) < F.size(array), "an item is repeated")

    present = x.kind.isNotNull()
    fits = lambda sub: (~_any_bad(x.v, sub)).cast("int")
    if "allOf" in schema:
        add(present & (sum(map(fits, schema["allOf"])) < len(schema["allOf"])), "does not match all of allOf")
    if "anyOf" in schema:
        add(present & (sum(map(fits, schema["anyOf"])) == 0), "matches none of anyOf")
    if "oneOf" in schema:
        add(present & (sum(map(fits, schema["oneOf"])) != 1), "does not match exactly one of oneOf")
    if "not" in schema:
        add(present & (fits(schema["not"]) == 1), "matches not")

    if "minProperties" in schema:
        add(F.size(names) < schema["minProperties"], f"fewer than {schema['minProperties']} properties")
    if "maxProperties" in schema:
        add(F.size(names) > schema["maxProperties"], f"more than {schema['maxProperties']} properties")
    for name in schema.get("required", ()):
        add(names.isNotNull() & child(name).isNull(), f"{name} is required")
    if schema.get("additionalProperties", True) is False:
        allowed = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
        add(F.size(F.array_except(names, allowed)) > 0, "has additional properties")
    return rules


def _item_rules(v: Column, schema: Mapping, label: str) -> list[Rule]:
    """Rules of a value met inside an array, properties included."""
    opened = v.try_cast(MAP)
    child = lambda name: opened.getItem(name)
    rules = _own_rules(Value.of(v), schema, label, child, F.map_keys(opened))
    for name, node in schema.get("properties", {}).items():
        rules += _item_rules(child(name), node, f"{label}.{name}")
    return rules


def _any_bad(v: Column, schema: Mapping) -> Column:
    out = F.lit(False)
    for rule in _item_rules(v, schema, "item"):
        out = out | F.coalesce(rule.bad, F.lit(False))
    return out


@dataclass
class Checks:
    """A DataFrame with helper columns, and the rules that read them."""

    df: DataFrame
    columns: list[str]
    rules: list[Rule] = field(default_factory=list)

    def is_valid(self) -> Column:
        """One predicate, true where no rule is broken."""
        ok = F.lit(True)
        for rule in self.rules:
            ok = ok & ~F.coalesce(rule.bad, F.lit(False))
        return ok

    def with_errors(self, df: DataFrame, *columns: str | Column) -> DataFrame:
        """Select columns of the checked rows and ``errors``, the messages of the broken rules."""
        broken = F.concat_ws("\u0001", *[F.when(r.bad, r.message) for r in self.rules])
        none = F.array().cast("array<string>")
        split = F.when(F.col("_broken") != "", F.split("_broken", "\u0001")).otherwise(none)
        return df.withColumn("_broken", broken).select(*columns, split.alias("errors"))


def compile_checks(df: DataFrame, schema: Mapping) -> Checks:
    """Compile a schema over ``rec`` and, where the DataFrame has them, its metadata columns."""
    return compile_many(df, {"": schema})[""]


def compile_many(df: DataFrame, schemas: Mapping[str, Mapping]) -> dict[str, Checks]:
    """Compile schemas over the same records. All share one DataFrame of helper columns, and each has its own rules.

    The properties of all schemas form one tree. In a VARIANT each of its objects is opened once into a struct of
    the properties that any schema reads, and each property's kind is computed once, level by level, in columns
    that the rules of all share. Typed records need neither."""
    columns, shared = list(df.columns), df
    rules: dict[str, list[Rule]] = {name: [] for name in schemas}
    meta: dict[str, Value] = {}
    for name in META_FIELDS:
        if name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        if is_variant(dtype):
            # A null natural key is present in the record, as JSON null.
            shared = shared.withColumn(
                "_nk", F.coalesce(F.col(name), F.parse_json(F.lit("null")))
            ).withColumn("_nk_kind", _kind(F.col("_nk")))
            v = F.col("_nk")
            meta[name] = Value(v, F.col("_nk_kind"), v.cast("string"))
        else:
            meta[name] = Value.typed(F.col(name), dtype)

    dtype = df.schema["rec"].dataType
    if is_variant(dtype):
        level = [_Node(dict(schemas), "(root)", Value.of(F.col("rec")), "_p", None)]
    else:
        level = [_Node(dict(schemas), "(root)", Value.typed(F.col("rec"), dtype), "_p", F.col("rec"), dtype)]
    while level:
        opened, below, kinds = {}, [], {}
        for node in level:
            root = node.label == "(root)"
            properties: dict[str, dict[str, Mapping]] = {}
            for name, schema in node.schemas.items():
                for n, sub in schema.get("properties", {}).items():
                    properties.setdefault(n, {})[name] = sub
            # A required name is read as well, even if it is no property.
            required = dict.fromkeys(n for s in node.schemas.values() for n in s.get("required", ()))
            read = [n for n in {**properties, **required} if not (root and n in meta)]
            values: dict[str, Value] = {}
            types: dict[str, T.DataType | None] = {}
            if isinstance(node.dtype, T.StructType):
                for n in read:
                    if n in node.dtype.names:
                        types[n] = node.dtype[n].dataType
                        values[n] = Value.typed(node.col.getField(n), types[n])
                        # Absent, not null, where the object around it is null.
                        if not root:
                            held = F.when(node.col.isNotNull(), values[n].kind)
                            values[n] = Value(values[n].v, held, values[n].text)
                    else:
                        values[n] = _absent()
                keys = F.when(
                    node.col.isNotNull(), F.array(*[F.lit(n) for n in node.dtype.names])
                )
            else:
                # Names that differ by case alone would be one field of a struct.
                apart = len({n.lower() for n in read}) == len(read)
                if read and apart:
                    fields = T.StructType([T.StructField(n, T.VariantType()) for n in read])
                    opened[node.prefix] = node.value.v.try_cast(fields)
                for i, n in enumerate(read):
                    v = F.col(node.prefix).getField(n) if apart else get_raw(node.value.v, [n])
                    kind = f"{node.prefix}_{i}_kind"
                    kinds[kind] = _kind(v)
                    values[n] = Value(v, F.col(kind), v.cast("string"))
                keys = F.map_keys(node.value.v.try_cast(MAP))
            if root:
                values |= meta
                if meta:
                    keys = F.array_union(keys, F.array(*[F.lit(m) for m in meta]))
            present = lambda n, vs=values: vs[n].kind
            for name, schema in node.schemas.items():
                rules[name] += _own_rules(node.value, schema, node.label, present, keys)
            for n, subs in properties.items():
                at = n if root else f"{node.label}.{n}"
                prefix = f"{node.prefix}_{len(below)}"
                if isinstance(types.get(n), T.StructType):
                    below.append(_Node(subs, at, values[n], prefix, node.col.getField(n), types[n]))
                else:
                    below.append(_Node(subs, at, values[n], prefix))
        if opened:
            shared = shared.withColumns(opened)
        if kinds:
            shared = shared.withColumns(kinds)
        level = below
    return {name: Checks(shared, columns, own) for name, own in rules.items()}


@dataclass(frozen=True)
class _Node:
    """A place in records, the schemas that have a node there, the value, the prefix of its helper columns, and the
    column and type of the value where it is a struct."""

    schemas: dict[str, Mapping]
    label: str
    value: Value
    prefix: str
    col: Column | None = None
    dtype: T.DataType | None = None


def _absent() -> Value:
    none = F.lit(None).cast("string")
    return Value(none.cast("variant"), none, none)


def count_invalid(df: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """(name, n_valid, n_invalid) of every schema, from one pass over the records."""
    checks = compile_many(df, schemas)
    shared = next(iter(checks.values())).df
    ok = [check.is_valid() for check in checks.values()]
    counts = [F.struct(F.count_if(v).alias("n_valid"), F.count_if(~v).alias("n_invalid")).alias(f"c{i}") for i, v in enumerate(ok)]
    rows = [
        F.struct(F.lit(name).alias("name"), F.col(f"c{i}.n_valid").alias("n_valid"), F.col(f"c{i}.n_invalid").alias("n_invalid"))
        for i, name in enumerate(checks)
    ]
    return shared.agg(*counts).select(F.inline(F.array(*rows)))


def all_errors(df: DataFrame, schema: Mapping) -> DataFrame:
    """Every record with an ``errors`` array, empty for valid ones, from one pass over the records."""
    checks = compile_checks(df, schema)
    return checks.with_errors(checks.df, *checks.columns)


def validate(df: DataFrame, schema: Mapping) -> tuple[DataFrame, DataFrame]:
    """Valid records, and invalid ones with an ``errors`` array."""
    checks = compile_checks(df, schema)
    checked = settle(checks.df, checks.is_valid(), "_valid")
    return (
        checked.filter("_valid").select(*checks.columns),
        checks.with_errors(checked.filter("NOT _valid"), *checks.columns),
    )
