"""Texts, kinds and emptiness of single values.

A value is either a VARIANT or a typed column; ``dtype`` tells which (None means VARIANT)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAP = "map<string,variant>"
ARRAY = "array<variant>"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)
_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)

# Marks a struct field that holds a hash, whose text needs no escapes.
HEX = "hex"

# Integers below this are doubles without loss; longer ones are hashed from their digits.
EXACT_BELOW = 2**53


def is_variant(dtype: T.DataType | None) -> bool:
    return dtype is None or isinstance(dtype, T.VariantType)


def is_object(v: Column) -> Column:
    return v.try_cast(MAP).isNotNull()


def variant_kind(v: Column) -> Column:
    """JSON type name of a VARIANT; NULL for SQL NULL."""
    schema = F.schema_of_variant(v)
    return (
        F.when(schema == "STRING", "string")
        .when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("OBJECT<"), "object")
        .when(schema.startswith("ARRAY<"), "array")
        .when(schema.isNotNull(), "number")
    )


def settle(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column as the output of a generator, below which no filter is pushed.

    A filter on an expensive column would otherwise be copied down to the source with all it is made
    of, parsing included, and every row would be worked out twice."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def timestamp_text(ts: Column) -> Column:
    """RFC 3339 text in the session's zone, which is UTC."""
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def to_variant(col: Column, dtype: T.DataType) -> Column:
    """A typed value as VARIANT, written as JSON text would hold it."""
    return _jsonable(col, dtype).cast("variant") if not isinstance(
        dtype, (T.StructType, T.MapType)
    ) else F.to_variant_object(_jsonable(col, dtype))


def scalar_text(col: Column, dtype: T.DataType) -> Column:
    """A typed scalar as the string its VARIANT casts to; NULL for nested types."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(None).cast("string")
    if isinstance(dtype, (*_TIMESTAMPS, T.DateType, T.BinaryType)):
        return _jsonable(col, dtype)
    return decimal_text(col) if isinstance(dtype, T.DecimalType) else col.cast("string")


def _jsonable(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        if not dtype.fields:
            return col
        built = F.struct(
            *[_jsonable(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        )
        return F.when(col.isNotNull(), built)
    if isinstance(dtype, T.ArrayType):
        plain = isinstance(dtype.elementType, (T.StringType, T.BooleanType, *_INTEGRAL))
        return col if plain else F.transform(col, lambda x: _jsonable(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        plain = isinstance(dtype.valueType, (T.StringType, T.BooleanType, *_INTEGRAL))
        return col if plain else F.transform_values(col, lambda _, x: _jsonable(x, dtype.valueType))
    if isinstance(dtype, _FLOATING):
        d = col.cast("double")
        return F.when(_is_small_integer(d), d.cast("bigint").cast("variant")).otherwise(d.cast("variant"))
    if isinstance(dtype, _TIMESTAMPS):
        return timestamp_text(col)
    if isinstance(dtype, T.DateType):
        return col.cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.base64(col)
    return col


def _is_small_integer(d: Column) -> Column:
    return (F.rint(d) == d) & (F.abs(d) < EXACT_BELOW)


def json_quoted(text: Column) -> Column:
    """A string as a quoted JSON value; the few that need escapes take the long way."""
    plain = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(text.rlike(r'["\\\x00-\x1f]'), F.to_json(text.cast("variant"))).otherwise(plain)


def _key_order(name: str) -> bytes:
    """Order of the keys in a VARIANT, by UTF-16 units."""
    return name.encode("utf-16-be")


def typed_json(col: Column, dtype: T.DataType) -> Column:
    """JSON text of a typed value, equal to that of its VARIANT but put together from column texts."""
    if isinstance(dtype, T.StructType):
        parts: list[Column] = []
        for i, f in enumerate(sorted(dtype.fields, key=lambda f: _key_order(f.name))):
            name = json.dumps(f.name, ensure_ascii=False)
            value = col.getField(f.name)
            if f.metadata.get(HEX):
                json_text = F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null"))
            else:
                json_text = typed_json(value, f.dataType)
            parts += [F.lit(("," if i else "{") + name + ":"), json_text]
        text = F.concat(*parts, F.lit("}")) if parts else F.lit("{}")
        return F.when(col.isNull(), "null").otherwise(text)
    if isinstance(dtype, T.BooleanType) or isinstance(dtype, _INTEGRAL):
        text = col.cast("string")
    elif isinstance(dtype, T.StringType):
        text = json_quoted(col)
    elif isinstance(dtype, (*_TIMESTAMPS, T.DateType)):
        text = F.concat(F.lit('"'), _jsonable(col, dtype), F.lit('"'))
    elif isinstance(dtype, _FLOATING):
        d = col.cast("double")
        text = (
            F.when(_is_small_integer(d), d.cast("bigint").cast("string"))
            .when(F.isnan(d) | (F.abs(d) == float("inf")), F.to_json(d.cast("variant")))
            .otherwise(plain_number(d))
        )
    else:
        text = canonical_json(F.to_json(to_variant(col, dtype)))
    return F.coalesce(text, F.lit("null"))


def decimal_text(x: Column) -> Column:
    """A decimal as plain digits; a cast to string depends on the session's ANSI setting."""
    return F.to_json(x.cast("variant"))


def plain_number(d: Column) -> Column:
    """A double as decimal digits without an exponent, whatever its size."""
    return plain_digits(double_text(d))


def double_text(d: Column) -> Column:
    """The shortest text of a double. Casts give up to two digits more than needed for a few numbers, so
    long texts are tried with 15 digits, and kept so if that is the same number."""
    text, short = d.cast("string"), F.format_string("%.14E", d)
    return F.when((F.length(text) >= 17) & (short.try_cast("double") == d), short).otherwise(text)


def plain_digits(text: Column) -> Column:
    """A number's text without an exponent or zeros after its last decimal.

    The point is moved within the digits, so nothing is rounded; only texts with one digit before the
    point have an exponent, as engines write doubles."""
    parts = r"^(-?)([0-9])(?:\.([0-9]*?))?0*E([-+]?[0-9]+)$"
    part = lambda i: F.regexp_extract(text, parts, i)
    sign, digits = part(1), F.concat(part(2), part(3))
    shift = part(4).try_cast("int")
    moved = (
        F.when(shift < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -shift - 1), digits))
        .when(F.length(digits) <= shift + 1, F.rpad(digits, shift + 1, "0"))
        .otherwise(F.concat(F.substring(digits, F.lit(1), shift + 1), F.lit("."), F.substring(digits, shift + 2, F.length(digits))))
    )
    plain = F.regexp_replace(text, r"\.0*$|(\.[0-9]*?[1-9])0+$", "$1")
    return F.when(text.rlike(parts), F.concat(sign, moved)).otherwise(plain)


def general_number(d: Column) -> Column:
    """A double in general format: shortest digits, an exponent outside [1e-4, 1e6)."""
    text = F.regexp_replace(double_text(d), r"^(-?[0-9]\.[0-9]+?)0*E\+?(-?)0?([0-9]+)$", "$1E$2$3")
    for pattern, replacement in (
        # 1234567.5 and 1.5E-4 are on the other side of the bounds of the plain form.
        (r"^(-?[0-9])([0-9]{6})\.([0-9]+)$", "$1.$2$3E6"),
        (r"^(-?)([0-9])\.([0-9]*?)0*E-4$", "$10.000$2$3"),
        (r"E([0-9])", "e+$1"),
        (r"E-", "e-"),
        (r"([+-])([0-9])$", "$10$2"),
        (r"\.?0+e", "e"),
        (r"\.0$", ""),
    ):
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _has_long_digits(text: Column) -> Column:
    """More digits than a double surely holds: an integer from 2^53, or a decimal of over 15 digits."""
    digits = F.regexp_replace(text, r"^-?0*\.?0*|\.", "")
    whole = text.try_cast("decimal(38,0)")
    long_integer = text.rlike("^-?[0-9]{16,}$") & ~F.coalesce(whole.between(-EXACT_BELOW, EXACT_BELOW), F.lit(False))
    return ~text.contains("E") & (long_integer | (text.contains(".") & (F.length(digits) > 15)))


def value_text(v: Column, dtype: T.DataType | None = None) -> Column:
    """The text a sensitive value is hashed from; objects and arrays use their canonical JSON."""
    if is_variant(dtype):
        text = v.cast("string")
        schema = F.schema_of_variant(v)
        number = schema.isin("BIGINT", "DOUBLE", "FLOAT") | schema.startswith("DECIMAL")
        nested = schema.startswith("OBJECT<") | schema.startswith("ARRAY<")
        return (
            # Texts that are the same whatever the kind of the value.
            F.when(text.rlike("^-?[0-9]{1,6}$") | ~text.rlike(r"^[-0-9\[{]"), text)
            .when(number, F.when(_has_long_digits(text), text).otherwise(general_number(v.try_cast("double"))))
            .when(nested, canonical_text(v))
            .otherwise(text)
        )
    if isinstance(dtype, _INTEGRAL):
        wide = v.cast("bigint")
        plain = wide.between(-999_999, 999_999) | ~wide.between(-EXACT_BELOW, EXACT_BELOW)
        return F.when(plain, v.cast("string")).otherwise(general_number(v.cast("double")))
    if isinstance(dtype, T.DecimalType):
        text = decimal_text(v)
        return F.when(_has_long_digits(text), text).otherwise(general_number(v.cast("double")))
    if isinstance(dtype, _FLOATING):
        return general_number(v.cast("double"))
    if isinstance(dtype, _NESTED):
        return canonical_text(to_variant(v, dtype))
    return _jsonable(v, dtype).cast("string")


def key_from_json(v: Column, json: Column) -> Column:
    """Lookup text of a VARIANT key whose canonical JSON is at hand."""
    return F.when(json == "null", "").when(json.startswith('"'), v.cast("string")).otherwise(json)


def key_string(v: Column, dtype: T.DataType | None = None) -> Column:
    """A natural key as lookup text: NULL gives '', numbers have no exponent, 1 and "1" agree."""
    if is_variant(dtype):
        text = key_from_json(v, canonical_text(v))
    elif isinstance(dtype, _FLOATING):
        text = plain_number(v.cast("double"))
    elif isinstance(dtype, T.DecimalType):
        text = decimal_text(v)
    elif isinstance(dtype, _NESTED):
        text = canonical_text(to_variant(v, dtype))
    else:
        text = _jsonable(v, dtype).cast("string")
    return F.coalesce(text, F.lit(""))


# JSON texts of the values that count as an empty key.
EMPTY_JSON = ("null", '""', "false", "[]", "{}", "0", "0.0", "-0.0")


def is_empty(v: Column, dtype: T.DataType | None = None) -> Column:
    """NULL, "", false, numeric 0, [] and {} are empty; the string "0" is not."""
    if is_variant(dtype):
        return F.coalesce(F.to_json(v).isin(*EMPTY_JSON), F.lit(True))
    if isinstance(dtype, T.StringType):
        empty = v == ""
    elif isinstance(dtype, T.BooleanType):
        empty = ~v
    elif isinstance(dtype, (*_INTEGRAL, *_FLOATING, T.DecimalType)):
        empty = v == 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        empty = F.size(v) == 0
    elif isinstance(dtype, T.StructType):
        empty = F.lit(not dtype.fields)
    else:
        empty = F.lit(False)
    return v.isNull() | empty


# Only a number the source wrote with an exponent or over 38 digits renders like these.
_UNEVEN_NUMBER = r"[0-9](\.0|E-?[0-9]+)([,}\]]|$)"
_TOKENS = r'"[^"]*"|[-0-9.E]+|[^-0-9.E"]+'


def canonical_json(text: Column) -> Column:
    """One spelling for equal numbers in JSON text whose keys are sorted already.

    Escaped quotes and backslashes are masked by control characters, which JSON text never holds
    raw, so that a string is one token. Rows without such a number are returned as they are."""
    masked = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\u0001")), F.lit('\\"'), F.lit("\u0002"))
    uneven = lambda t: t.rlike(r"^-?[0-9].*(\.0$|E)")
    tokens = F.transform(
        F.regexp_extract_all(masked, F.lit(_TOKENS), F.lit(0)),
        lambda t: F.when(uneven(t), F.when(t.contains("E"), plain_number(t.try_cast("double"))).otherwise(plain_digits(t))).otherwise(t),
    )
    joined = F.array_join(tokens, "")
    normal = F.replace(F.replace(joined, F.lit("\u0002"), F.lit('\\"')), F.lit("\u0001"), F.lit("\\\\"))
    return F.when(text.rlike(_UNEVEN_NUMBER), normal).otherwise(text)


def canonical_text(v: Column) -> Column:
    """JSON text of a VARIANT: sorted keys, quoted, equal numbers spelled alike."""
    return canonical_json(F.to_json(v))
