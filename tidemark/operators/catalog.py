"""Catalog rows and JSON Schema documents: the same schema as a table and as a nested dict."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import KEY_PROPERTIES

CATALOG_SCHEMA = (
    "stream string, path array<string>, type string, nullable boolean, format string, "
    "min_length int, keywords map<string,string>, schema_discovered_at string"
)

MOST_PROPERTIES = 10_000

# Keywords held in columns of their own; all others are kept as JSON in ``keywords``.
_COLUMNS = ("type", "format", "minLength", "properties")


def catalog_rows(stream: str, schema: Mapping, discovered_at: str | None = None) -> list[tuple]:
    """Rows of a hand-written JSON Schema; several types are joined by '|'."""
    rows = []

    def walk(node: Mapping, path: tuple[str, ...]) -> None:
        types = node.get("type")
        types = [types] if isinstance(types, str) else list(types or ())
        named = [t for t in types if t != "null"]
        if types and not named:
            named = ["null"]
        other = {k: json.dumps(v, sort_keys=True) for k, v in node.items() if k not in _COLUMNS}
        if path or other:
            rows.append(
                (
                    stream, list(path), "|".join(named) or None,
                    "null" in types or not types, node.get("format"), node.get("minLength"),
                    other or None, discovered_at,
                )
            )
        for name, child in node.get("properties", {}).items():
            walk(child, (*path, name))

    walk(schema, ())
    return rows


def catalog_from_schema(
    spark: SparkSession, stream: str, schema: Mapping, discovered_at: str | None = None
) -> DataFrame:
    return spark.createDataFrame(catalog_rows(stream, schema, discovered_at), CATALOG_SCHEMA)


def schema_from_rows(rows: Iterable[Row]) -> dict:
    """Nested JSON Schema of one stream's catalog rows."""
    root: dict = {"type": "object", "properties": {}}
    for row in sorted(rows, key=lambda r: len(r["path"])):
        node = root
        for key in row["path"]:
            node = node.setdefault("properties", {}).setdefault(key, {})
        types = row["type"].split("|") if row["type"] else []
        if types:
            if row["nullable"] and "null" not in types:
                types.append("null")
            node["type"] = types[0] if len(types) == 1 else types
            if "object" in types:
                node.setdefault("properties", {})
        if row["format"] is not None:
            node["format"] = row["format"]
        if row["min_length"] is not None:
            node["minLength"] = row["min_length"]
        for key, value in (row["keywords"] or {}).items():
            node[key] = json.loads(value)
    return root


def catalog_document(catalog: DataFrame, stream: str) -> dict | None:
    """A stream's catalog as the document that users edit, or None if it has none."""
    rows = catalog.filter(F.col("stream") == stream).collect()
    if not rows:
        return None
    return {
        "stream": stream, "key_properties": list(KEY_PROPERTIES), "schema": schema_from_rows(rows),
        "schema_discovered_at": max((r["schema_discovered_at"] or "" for r in rows), default=""),
    }


def catalog_from_document(spark: SparkSession, document: Mapping | str) -> DataFrame:
    """Catalog rows of such a document, given as a mapping or JSON text.

    Key properties are fixed; others raise, since records would be told apart by the wrong fields."""
    doc = json.loads(document) if isinstance(document, str) else document
    if not doc.get("stream"):
        raise ValueError("a catalog document names its stream")
    if list(doc.get("key_properties") or KEY_PROPERTIES) != list(KEY_PROPERTIES):
        raise ValueError(f"key_properties must be {list(KEY_PROPERTIES)}")
    return catalog_from_schema(spark, doc["stream"], doc.get("schema") or {}, doc.get("schema_discovered_at") or None)


def load_schema(catalog: DataFrame, stream: str) -> dict | None:
    """JSON Schema of a stream, or None if its catalog is empty.

    The rows are the stream's field list, metadata that the validator is compiled from. An object with more
    than MOST_PROPERTIES properties is a map whose keys are data: it raises before anything is collected."""
    parent = F.slice("path", F.lit(1), F.greatest(F.size("path") - 1, F.lit(0)))
    wide = catalog.filter(F.col("stream") == stream).groupBy(parent.alias("parent")).count()
    row = wide.filter(F.col("count") > MOST_PROPERTIES).first()
    if row is not None:
        at = ".".join(row["parent"]) or "(root)"
        raise ValueError(f"{at} of stream {stream} has {row['count']} properties; drop it, or store it as an array")
    rows = catalog.filter(F.col("stream") == stream).collect()
    return schema_from_rows(rows) if rows else None
