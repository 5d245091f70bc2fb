"""SCHEMA and RECORD messages as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys as K
from tidemark.functions.values import json_quoted


def record_messages(df: DataFrame) -> DataFrame:
    """(stream, message) per record, assembled from the record's text without parsing it."""
    record = K.stamped_text(
        F.col("text"), F.col("nk_json"), F.col(K.SURROGATE_KEY), F.col(K.TIMESTAMP), F.col(K.UNIQUE_KEY)
    )
    message = F.concat(
        F.lit('{"type":"RECORD","record":'), record,
        F.lit(',"stream":'), json_quoted(F.col("stream")), F.lit("}"),
    )
    return df.select("stream", message.alias("message"))


def _member(name: Column, json: Column) -> Column:
    return F.concat(json_quoted(name), F.lit(":"), json)


def _types_json() -> Column:
    names = F.split("type", r"\|")
    null = F.when(
        F.col("nullable") & ~F.array_contains(names, "null"), F.array(F.lit("null"))
    ).otherwise(F.array().cast("array<string>"))
    names = F.concat(names, null)
    return F.when(F.size(names) == 1, json_quoted(names[0])).otherwise(
        F.to_json(names)
    )


def schema_json(catalog: DataFrame) -> DataFrame:
    """(stream, schema): each stream's JSON Schema text, folded bottom-up from its catalog rows.

    One small aggregation per nesting level over a table of paths, for all streams at once."""
    own = F.array_compact(
        F.array(
            F.when(F.col("type").isNotNull(), F.concat(F.lit('"type":'), _types_json())),
            F.when(F.col("format").isNotNull(), _member(F.lit("format"), json_quoted(F.col("format")))),
            F.when(
                F.col("min_length").isNotNull(),
                _member(F.lit("minLength"), F.col("min_length").cast("string")),
            ),
        )
    )
    keywords = F.transform(
        F.array_sort(F.map_entries(F.coalesce("keywords", F.create_map().cast("map<string,string>")))),
        lambda e: _member(e["key"], e["value"]),
    )
    rows = catalog.select(
        "stream",
        "path",
        F.size("path").alias("depth"),
        F.concat(own, keywords).alias("members"),
        F.coalesce(F.array_contains(F.split("type", r"\|"), "object"), F.lit(False)).alias("object"),
    )
    depth = rows.agg(F.max("depth")).first()[0] or 0
    child = F.struct(F.element_at("path", -1).alias("name"), F.col("json"))
    parent = F.slice("path", F.lit(1), F.size("path") - 1)

    def finish(level: DataFrame) -> DataFrame:
        properties = F.when(
            F.col("children").isNotNull() | F.col("object"),
            F.concat(
                F.lit('"properties":{'),
                F.coalesce(
                    F.array_join(
                        F.transform(
                            F.array_sort("children"), lambda c: _member(c["name"], c["json"])
                        ),
                        ",",
                    ),
                    F.lit(""),
                ),
                F.lit("}"),
            ),
        )
        members = F.array_compact(F.concat("members", F.array(properties)))
        return level.withColumn(
            "json", F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
        )

    below = None
    for d in range(depth, 0, -1):
        level = rows.filter(F.col("depth") == d)
        level = _with_children(level, below)
        below = (
            finish(level)
            .groupBy("stream", parent.alias("path"))
            .agg(F.collect_list(child).alias("children"))
        )
    streams = rows.select("stream").distinct().withColumn("path", F.array().cast("array<string>"))
    root = rows.filter(F.col("depth") == 0).select("stream", "members")
    root = streams.join(root, "stream", "left").withColumns(
        {
            "members": F.coalesce("members", F.array().cast("array<string>")),
            "object": F.lit(True),
        }
    )
    typed = F.exists("members", lambda m: m.startswith('"type":'))
    root = root.withColumn(
        "members",
        F.when(typed, F.col("members")).otherwise(
            F.concat(F.array(F.lit('"type":"object"')), "members")
        ),
    )
    return finish(_with_children(root, below)).select("stream", F.col("json").alias("schema"))


def _with_children(level: DataFrame, below: DataFrame | None) -> DataFrame:
    if below is None:
        kind = "array<struct<name:string,json:string>>"
        return level.withColumn("children", F.lit(None).cast(kind))
    return level.join(below, ["stream", "path"], "left")


def schema_messages(catalog: DataFrame) -> DataFrame:
    """(stream, message): one SCHEMA message per stream."""
    keys = ",".join(f'"{k}"' for k in K.KEY_PROPERTIES)
    message = F.concat(
        F.lit('{"type":"SCHEMA","stream":'), json_quoted(F.col("stream")),
        F.lit(',"schema":'), F.col("schema"),
        F.lit(f',"key_properties":[{keys}]}}'),
    )
    return schema_json(catalog).select("stream", message.alias("message"))
