"""Schema discovery: typed paths of every record, merged to one catalog row per path.

Records are opened level by level with variant_explode in one pass over the source, whatever their
depth. Aggregation runs on the innermost values alone; the objects around them follow from their
paths afterwards, on one row per path. Its buffers are plain numbers, so it is a two-phase hash
aggregation: the first type of a path is the smallest ``ord`` with a type code in its low digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import keys as K
from tidemark.functions import temporal as D
from tidemark.functions.values import is_variant, scalar_text, to_variant

# Object nesting opened at first; deeper records raise or are opened again, never cut short.
DEPTH = 4

# Type codes, all below CODES.
FIRST = "decimal(21,0)"
CODES = 8
BOOLEAN, NUMBER, STRING, DATE_TIME, DATE, ARRAY, OBJECT, DEEPER = range(8)
_TYPE_OF = {
    BOOLEAN: "boolean", NUMBER: "number", STRING: "string", DATE_TIME: "string", DATE: "string",
    ARRAY: "array", OBJECT: "object",
}


def _type_name(code: Column) -> Column:
    case = None
    for value, name in _TYPE_OF.items():
        case = F.when(code == value, name) if case is None else case.when(code == value, name)
    return case


def _format_name(code: Column) -> Column:
    return F.when(code == DATE_TIME, "date-time").when(code == DATE, "date")


def _code_of(type_: Column, format_: Column) -> Column:
    return (
        F.when(format_ == "date-time", DATE_TIME)
        .when(format_ == "date", DATE)
        .when(type_ == "string", STRING)
        .when(type_ == "number", NUMBER)
        .when(type_ == "boolean", BOOLEAN)
        .when(type_ == "array", ARRAY)
        .when(type_ == "object", OBJECT)
    )


def _is_object(kind: Column) -> Column:
    return kind.startswith("OBJECT<")


def _leaves(df: DataFrame, depth: int) -> DataFrame:
    """(stream, ord, k1.., pos1.., code): the innermost values of each record by their keys.

    Keys are NULL past a value's own level. A null value stands for the object that holds it, and
    values of a record that is no object or has no members are left out."""
    spark = df.sparkSession
    rec, dtype = F.col("rec"), df.schema["rec"].dataType
    if not is_variant(dtype):
        rec = to_variant(rec, dtype)
    df = df.select("stream", "ord", rec.alias("rec"))
    rec = F.col("rec")
    rows = df.select("stream", "ord", rec.alias("v"), F.schema_of_variant(rec).alias("kind"))
    keys: list[str] = []
    for level in range(1, depth + 1):
        opened = F.when(_is_object(F.col("kind").outer()), F.col("v").outer())
        members = spark.tvf.variant_explode_outer(opened)
        k, pos, v, kind = F.col("key"), F.col("pos"), F.col("value"), F.col("kind")
        kept = ["stream", "ord", *keys, *[f"pos{i}" for i in range(1, level)]]
        rows = rows.lateralJoin(members).select(
            *kept,
            k.alias(f"k{level}"),
            pos.alias(f"pos{level}"),
            F.when(k.isNotNull(), v).otherwise(F.col("v")).alias("v"),
            F.when(k.isNotNull(), F.schema_of_variant(v)).otherwise(kind).alias("kind"),
        )
        if level == 1:
            rows = rows.filter(_in_source(F.col("k1")))
        keys.append(f"k{level}")
    kind, text = F.col("kind"), F.col("text")
    rows = rows.withColumn("text", F.when(kind == "STRING", F.col("v").try_cast("string")))
    code = (
        F.when(kind == "STRING", F.when(D.is_date_time(text), DATE_TIME)
               .when(D.is_date(text), DATE).otherwise(STRING))
        .when(kind == "BOOLEAN", BOOLEAN)
        .when((kind == "OBJECT<>") | (kind == "VOID"), OBJECT)
        .when(_is_object(kind), DEEPER)
        .when(kind.startswith("ARRAY<"), ARRAY)
        .otherwise(NUMBER)
    )
    held = []
    for level in range(1, depth + 1):
        last = F.col(f"k{level + 1}").isNull() if level < depth else F.lit(True)
        held.append(
            F.when(~((kind == "VOID") & last), F.col(f"k{level}")).alias(f"k{level}")
        )
    positions = [f"pos{i}" for i in range(1, depth + 1)]
    return rows.select("stream", "ord", *held, *positions, code.alias("code")).filter(
        "k1 IS NOT NULL"
    )


_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TEXTS = (T.StringType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _typed_code(value: Column, dtype: T.DataType) -> Column | None:
    """Type code of a typed value that is not NULL; None for a type whose values must be looked at as VARIANT."""
    if type(dtype) in _NUMBERS:
        return F.lit(NUMBER)
    if type(dtype) in _TEXTS:
        text = scalar_text(value, dtype)
        return F.when(D.is_date_time(text), DATE_TIME).when(D.is_date(text), DATE).otherwise(STRING)
    known = {T.BooleanType: BOOLEAN, T.ArrayType: ARRAY, T.StructType: OBJECT}
    return F.lit(known[type(dtype)]) if type(dtype) in known else None


def _typed_entries(value: Column, dtype: T.StructType, path: tuple[str, ...], depth: int) -> list[Column] | None:
    """(k1.., code) of each innermost field of a struct; None where its values must be looked at as VARIANT."""

    def entry(keys: tuple[str, ...], code: Column) -> Column:
        named = [F.lit(k) for k in keys] + [F.lit(None).cast("string")] * (depth - len(keys))
        return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(named, 1)], code.cast("int").alias("code"))

    out = []
    for f in dtype.fields:
        if not path and f.name in K.META_FIELDS:
            continue
        v, at = value.getField(f.name), (*path, f.name)
        if len(at) > depth:
            return None
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            below = _typed_entries(v, f.dataType, at, depth)
            if below is None:
                return None
            out += below
            here = F.lit(None)
        else:
            code = _typed_code(v, f.dataType)
            if code is None:
                return None
            here = F.when(v.isNotNull(), entry(at, code))
        if path:  # A null value stands for the object that holds it.
            here = F.coalesce(here, F.when(value.isNotNull() & v.isNull(), entry(path, F.lit(OBJECT))))
        elif isinstance(f.dataType, T.StructType) and f.dataType.fields:
            continue
        out.append(here)
    return out


def _types_of_values(df: DataFrame, depth: int) -> DataFrame:
    """(stream, ord, k1.., code) of the innermost values. Those of typed records follow from their columns: no
    record is turned into a VARIANT and opened again."""
    dtype, keys = df.schema["rec"].dataType, [f"k{i}" for i in range(1, depth + 1)]
    entries = None if is_variant(dtype) else _typed_entries(F.col("rec"), dtype, (), depth)
    if not entries:
        return _leaves(df, depth).select("stream", "ord", *keys, "code")
    rows = df.select("stream", "ord", F.explode(F.array(*entries)).alias("p")).filter("p IS NOT NULL")
    return rows.select("stream", "ord", "p.*")


def _in_source(key: Column) -> Column:
    """Top-level keys that belong to the source record rather than to its metadata."""
    return key.isNotNull() & ~key.isin(*K.META_FIELDS)


def _too_deep(depth: int) -> Column:
    return F.raise_error(F.lit(f"records are nested deeper than {depth}")).cast("string")


def infer_paths(df: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(stream, ord, path, type, format) of every non-null value in ``rec``; arrays are not entered.

    An object is listed by the first of its innermost values, hence once."""
    leaves = _leaves(df, depth)
    entries = []
    for level in range(1, depth + 1):
        key = F.col(f"k{level}")
        path = F.array(*[F.col(f"k{i}") for i in range(1, level + 1)])
        own = F.col(f"k{level + 1}").isNull() if level < depth else F.lit(True)
        first = F.lit(True)
        for i in range(level + 1, depth + 1):
            first = first & (F.coalesce(F.col(f"pos{i}"), F.lit(0)) == 0)
        code = F.when(own, F.col("code")).otherwise(OBJECT)
        entries.append(
            F.when(key.isNotNull() & first, F.struct(path.alias("path"), code.alias("code")))
        )
    listed = leaves.select("stream", "ord", F.explode(F.array(*entries)).alias("p")).filter(
        "p IS NOT NULL"
    )
    code = F.col("p.code")
    return listed.select(
        "stream", "ord", "p.path",
        F.when(code == DEEPER, _too_deep(depth)).otherwise(_type_name(code)).alias("type"),
        _format_name(code).alias("format"),
    )


def _first(ord_: Column, code: Column) -> Column:
    # Wide enough for any BIGINT order; a decimal of this size is still a buffer of a hash aggregate.
    return (ord_.cast("decimal(20,0)") * CODES + code).cast(FIRST)


def _named(types: DataFrame) -> DataFrame:
    """Catalog columns from (stream, path, first, object, deeper)."""
    code = F.pmod(F.col("first"), F.lit(CODES)).cast("int")
    return types.select(
        "stream",
        "path",
        F.when(F.col("object"), "object").otherwise(_type_name(code)).alias("type"),
        (F.col("path") != F.array(F.lit(K.NATURAL_KEY))).alias("nullable"),
        _format_name(code).alias("format"),
        F.lit(None).cast("int").alias("min_length"),
        "deeper",
    )


def _fold(rows: DataFrame, *by: Column | str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.min("first").alias("first"), F.max("object").alias("object"), F.max("deeper").alias("deeper")
    )


def _flags(code: Column) -> list[Column]:
    return [(code == OBJECT).alias("object"), (code == DEEPER).alias("deeper")]


def _merge_existing(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Known paths keep their settings, but an object found in the records overrides their type.

    Both sides hold a row per path of a stream, never per record."""
    old, new = existing.alias("old"), found.alias("new")
    known = F.col("old.path").isNotNull()
    same = (F.col("old.stream") == F.col("new.stream")) & (F.col("old.path") == F.col("new.path"))
    keep = lambda c: F.when(known, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c)
    return old.join(new, same, "full_outer").select(
        F.coalesce("old.stream", "new.stream").alias("stream"),
        F.coalesce("old.path", "new.path").alias("path"),
        F.when(~known | (F.col("new.type") == "object"), F.col("new.type"))
        .otherwise(F.col("old.type"))
        .alias("type"),
        keep("nullable"),
        keep("format"),
        keep("min_length"),
        F.col("old.keywords").alias("keywords"),
    )


def merge_paths(paths: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One (stream, path, type, nullable, format, min_length, keywords) row per path.

    ``paths`` holds (stream, ord, path, type, format). The type and format of the smallest ``ord``
    win, but an object overrides a scalar or array; rows of an existing catalog come first of all."""
    code = _code_of(F.col("type"), F.col("format"))
    coded = paths.select("stream", "path", _first(F.col("ord"), code).alias("first"), *_flags(code))
    return _with_existing(_named(_fold(coded, "stream", "path")).drop("deeper"), existing)


def _with_existing(found: DataFrame, existing: DataFrame | None) -> DataFrame:
    if existing is None:
        return found.withColumn("keywords", F.lit(None).cast("map<string,string>"))
    return _merge_existing(existing, found)


def _add_meta_rows(found: DataFrame) -> DataFrame:
    """Put the metadata columns of fixed type beside each stream's natural key row."""
    columns = found.columns
    row = lambda **c: F.struct(*[c.get(n, F.col(n)).alias(n) for n in columns])

    def fixed(name: str, format_: str | None, nullable: bool, min_length: int | None) -> Column:
        return row(
            path=F.array(F.lit(name)),
            type=F.lit("string"),
            nullable=F.lit(nullable),
            format=F.lit(format_).cast("string"),
            min_length=F.lit(min_length).cast("int"),
        )

    rows = F.when(
        F.col("path") == F.array(F.lit(K.NATURAL_KEY)),
        F.array(
            row(),
            fixed(K.SURROGATE_KEY, None, False, 1),
            fixed(K.UNIQUE_KEY, None, False, 1),
            fixed(K.TIMESTAMP, "date-time", True, None),
        ),
    ).otherwise(F.array(row()))
    return found.select(F.explode(rows).alias("r")).select("r.*")


def found_types(
    df: DataFrame, key_path: Sequence[str] | None = None, depth: int = DEPTH
) -> DataFrame:
    """First types of transformed records; ``deeper`` marks objects that were not entered.

    With a ``key_path`` the metadata columns are added. A natural key has the types of its path, no
    format of its own, and counts as a string where the path was dropped."""
    keys = [f"k{i}" for i in range(1, depth + 1)]
    code = F.col("code")
    leaves = _types_of_values(df, depth).select(
        "stream", *keys, _first(F.col("ord"), code).alias("first"), *_flags(code)
    )
    leaves = _fold(leaves, "stream", *keys)
    # From here on one row per distinct path: add the objects around each value.
    around = (F.col("first") - F.pmod(F.col("first"), F.lit(CODES)) + OBJECT).cast(FIRST)
    entries = []
    for level in range(1, depth + 1):
        own = F.col(f"k{level + 1}").isNull() if level < depth else F.lit(True)
        entry = F.struct(
            F.array(*[F.col(k) for k in keys[:level]]).alias("path"),
            F.when(own, F.col("first")).otherwise(around).alias("first"),
            F.when(own, F.col("object") | F.col("deeper")).otherwise(True).alias("object"),
            F.when(own, F.col("deeper")).otherwise(False).alias("deeper"),
        )
        entries.append(F.when(F.col(keys[level - 1]).isNotNull(), entry))
    paths = leaves.select("stream", F.explode(F.array_compact(F.array(*entries))).alias("p"))
    paths = paths.select("stream", "p.*")
    if key_path is not None:
        paths = _add_natural_key(paths, tuple(key_path))
    types = _named(_fold(paths, "stream", "path"))
    return types if key_path is None else _add_meta_rows(types)


def _add_natural_key(paths: DataFrame, key_path: tuple[str, ...]) -> DataFrame:
    """Repeat what lies at and below the key's path under the natural key.

    Each path also proposes a string at the very end of the order, which stays only where the key's
    own path does not exist."""
    n = len(key_path)
    at = F.array(*[F.lit(k) for k in key_path])
    under = F.slice("path", F.lit(1), F.lit(n)) == at
    below = F.slice("path", F.lit(n + 1), F.greatest(F.size("path") - n, F.lit(0)))
    code = F.pmod(F.col("first"), F.lit(CODES)).cast("int")
    # The key itself carries no date format.
    plain = F.when(
        (F.size("path") == n) & code.isin(DATE, DATE_TIME), (F.col("first") - code + STRING).cast(FIRST)
    ).otherwise(F.col("first"))
    natural = F.array(F.lit(K.NATURAL_KEY))
    row = lambda path, first, obj, deeper: F.struct(
        path.alias("path"), first.alias("first"), obj.alias("object"), deeper.alias("deeper")
    )
    same = row(F.col("path"), F.col("first"), F.col("object"), F.col("deeper"))
    last = F.lit(str(2**63 * CODES + STRING)).cast(FIRST)
    absent = row(natural, last, F.lit(False), F.lit(False))
    copy = row(F.concat(natural, below), plain, F.col("object"), F.col("deeper"))
    rows = F.when(under, F.array(same, absent, copy)).otherwise(F.array(same, absent))
    return paths.select("stream", F.explode(rows).alias("p")).select("stream", "p.*")


def merge_found(found: DataFrame, existing: DataFrame | None, discovered_at: str) -> DataFrame:
    """Catalog rows of found types merged into an existing catalog."""
    return _with_existing(found.drop("deeper"), existing).withColumn(
        "schema_discovered_at", F.lit(discovered_at)
    )


def discover(
    df: DataFrame,
    existing: DataFrame | None,
    discovered_at: str,
    key_path: Sequence[str] | None = None,
    depth: int = DEPTH,
) -> DataFrame:
    """Catalog rows of transformed records, merged into the existing catalog.

    A record nested deeper than ``depth`` fails the job; run_discover goes deeper by itself."""
    found = found_types(df, key_path, depth)
    type_ = F.when(F.col("deeper"), _too_deep(depth)).otherwise(F.col("type"))
    return merge_found(found.withColumn("type", type_), existing, discovered_at)
