"""Record transform: key check, drop, hash, keys. One narrow chain of selects, no shuffle."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import StreamConfig
from tidemark.functions import keys as K
from tidemark.functions import paths as P
from tidemark.functions import values as V


def now_text() -> str:
    """UTC RFC 3339 text of the current time, taken once per run."""
    return datetime.now(timezone.utc).isoformat(timespec="microseconds").replace("+00:00", "Z")


def _rec_type(df: DataFrame) -> T.DataType | None:
    dtype = df.schema["rec"].dataType
    return None if V.is_variant(dtype) else dtype


def with_ord(df: DataFrame) -> DataFrame:
    """Arrival order; a caller's own ``ord`` column is kept."""
    return df if "ord" in df.columns else df.withColumn("ord", F.monotonically_increasing_id())


def key_ok(df: DataFrame, path) -> "F.Column":
    dtype = _rec_type(df)
    key = P.get_path(F.col("rec"), path, dtype)
    return ~V.is_empty(key, P.type_at(dtype, path))


def split_on_key(df: DataFrame, path) -> tuple[DataFrame, DataFrame]:
    """Records whose key is present and not empty, and the others."""
    ok = key_ok(df, path)
    return df.filter(ok), df.filter(~ok)


def objects_only(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that are objects, and the others."""
    ok = V.is_object(F.col("rec"))
    return df.filter(ok), df.filter(~ok | F.col("rec").isNull())


def transform_all(
    df: DataFrame, cfg: StreamConfig, run_ts: str, disambiguate: bool = False, stamped: bool = True
) -> DataFrame:
    """Every record with its keys; ``key_ok`` is false where the key check failed.

    Records that are shuffled first leave the extraction key for later: without ``stamped`` they have, for
    with_unique_key, a column ``content`` in its place, which is NULL where it is the ``text``.

    ``text`` is the JSON text to emit. Failed records have NULL keys; their text is edited as well, so
    that a rejects table never holds a value configured as sensitive. Of a source with a ``reason`` column
    the lines that give no record stay, with ``raw`` and ``reason``, as records that fail the key check."""
    df = with_ord(df)
    if "reason" in df.columns:
        df = df.withColumn("rec", F.when(F.col("reason").isNull(), F.col("rec")))
    if _rec_type(df) is None:
        step = _keyed_variant(df, cfg)
    else:
        step = _keyed_struct(df, cfg)
    ok = F.col("key_ok")
    step = step.select(
        F.lit(cfg.stream_name).alias("stream"),
        "ord",
        "key_ok",
        "rec",
        F.when(ok, F.col("key")).alias("key"),
        "text",
        "clean_text",
        F.when(ok, F.col("nk_json")).alias("nk_json"),
        F.when(ok, F.col("nk")).alias(K.NATURAL_KEY),
        F.when(ok, K.surrogate_key(F.col("text"))).alias(K.SURROGATE_KEY),
        F.when(ok, F.lit(run_ts)).alias(K.TIMESTAMP),
        *_told(df),
    )
    if not stamped:
        content = F.when(F.col("text") != F.col("clean_text"), F.col("text"))
        return step.withColumn("content", content).drop("text").withColumnRenamed("clean_text", "text")
    unique = K.unique_key(
        F.col("text"),
        F.col("clean_text"),
        F.col("nk_json"),
        F.col(K.SURROGATE_KEY),
        F.lit(run_ts),
        F.col("ord") if disambiguate else None,
    )
    return step.withColumn(K.UNIQUE_KEY, F.when(ok, unique)).drop("text").withColumnRenamed(
        "clean_text", "text"
    )


def with_unique_key(df: DataFrame, disambiguate: bool = False) -> DataFrame:
    """Records of transform_all without ``stamped``, with the extraction key that it would have given them."""
    unique = K.unique_key(
        F.coalesce("content", "text"),
        F.col("text"),
        F.col("nk_json"),
        F.col(K.SURROGATE_KEY),
        F.col(K.TIMESTAMP),
        F.col("ord") if disambiguate else None,
    )
    return df.withColumn(K.UNIQUE_KEY, F.when(F.col("key_ok"), unique)).drop("content")


def _told(df: DataFrame) -> list[str]:
    """What a source says of lines that give no record."""
    return ["raw", "reason"] if "reason" in df.columns else []


def _keyed_variant(df: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Dynamic records: each select names what the next one uses more than once."""
    rec, told = F.col("rec"), _told(df)
    df = df.select("ord", *told, "rec", P.get_path(rec, cfg.unique_key_path).alias("source_key"))
    df = df.select("ord", *told, "rec", (~V.is_empty(F.col("source_key"))).alias("key_ok"))
    edited, _ = P.edit_paths(rec, cfg.drop_field_paths, cfg.sensitive_field_paths)
    df = df.select("ord", *told, "key_ok", edited.alias("rec"))
    df = df.select(
        "*", F.to_json(rec).alias("json"), P.get_path(rec, cfg.unique_key_path).alias("nk")
    )
    df = df.select(
        "ord",
        *told,
        "key_ok",
        "rec",
        "nk",
        V.canonical_json(F.col("json")).alias("text"),
        V.canonical_json(F.coalesce(F.to_json("nk"), F.lit("null"))).alias("nk_json"),
    )
    return df.select(
        "*",
        K.without_meta(rec, F.col("text")).alias("clean_text"),
        V.key_from_json(F.col("nk"), F.col("nk_json")).alias("key"),
    )


def _keyed_struct(df: DataFrame, cfg: StreamConfig) -> DataFrame:
    """Typed records: text and keys come from plain columns, and rec stays a struct."""
    dtype, told = _rec_type(df), _told(df)
    edited, edited_type = P.edit_paths(
        F.col("rec"), cfg.drop_field_paths, cfg.sensitive_field_paths, dtype
    )
    ok = key_ok(df, cfg.unique_key_path)
    df = df.select("ord", *told, ok.alias("key_ok"), edited.alias("edited"))
    edited = F.col("edited")
    nk = P.get_path(edited, cfg.unique_key_path, edited_type)
    nk_type = P.type_at(edited_type, cfg.unique_key_path)
    text = V.typed_json(edited, edited_type)
    df = df.select(
        "ord",
        *told,
        "key_ok",
        edited.alias("rec"),
        text.alias("text"),
        V.key_string(nk, nk_type).alias("key"),
        nk.alias("nk"),
        V.typed_json(nk, nk_type or T.VariantType()).alias("nk_json"),
    )
    clean = F.col("text")
    if any(n.startswith("_sdc_") for n in dtype.names):
        clean = K.without_meta(V.to_variant(F.col("rec"), edited_type), F.col("text"))
    return df.select("*", clean.alias("clean_text"))


def transform(df: DataFrame, cfg: StreamConfig, run_ts: str, disambiguate: bool = False) -> DataFrame:
    """Records that pass the key check, with rec edited and all keys added."""
    return transform_all(df, cfg, run_ts, disambiguate).filter("key_ok").drop("key_ok")
