"""Read and edit values at object paths, on VARIANT records or typed structs.

All edits of a record compile into one expression that opens each touched object once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import HEX, MAP, is_object, is_variant, value_text

Path = Sequence[str]


def json_path(path: Path) -> str | None:
    """The variant path text of a key path; None if a key cannot be written in one."""
    out = "$"
    for key in path:
        if not key or "?" in key:
            return None
        if "'" not in key:
            out += f"['{key}']"
        elif '"' not in key:
            out += f'["{key}"]'
        else:
            return None
    return out


def get_raw(rec: Column, path: Path) -> Column:
    """VARIANT at a path: SQL NULL if absent, a variant null if the record holds null there."""
    if not path:
        return rec
    text = json_path(path)
    if text is not None:
        return F.try_variant_get(rec, F.lit(text), "variant")
    for key in path:
        rec = rec.try_cast(MAP).getItem(key)
    return rec


def get_path(rec: Column, path: Path, dtype: T.DataType | None = None) -> Column:
    """Value at a path; NULL where a key is missing, null, or below a non-object."""
    if is_variant(dtype):
        v = get_raw(rec, path)
        return F.when(~F.is_variant_null(v), v)
    for i, key in enumerate(path):
        if is_variant(dtype):
            return get_path(rec, path[i:])
        if not isinstance(dtype, T.StructType) or key not in dtype.names:
            return F.lit(None).cast("string")
        rec, dtype = rec.getField(key), dtype[key].dataType
    return rec


def type_at(dtype: T.DataType | None, path: Path) -> T.DataType | None:
    """Type that get_path returns; None for VARIANT."""
    for key in path:
        if is_variant(dtype):
            return None
        if not isinstance(dtype, T.StructType) or key not in dtype.names:
            return T.StringType()
        dtype = dtype[key].dataType
    return None if is_variant(dtype) else dtype


@dataclass
class _Edits:
    """What to do below one object: keys to drop, children to edit, and whether to hash it whole."""

    drops: set[str] = field(default_factory=set)
    children: dict[str, _Edits] = field(default_factory=dict)
    hashed: bool = False


def _edits(drops: Sequence[Path], hashes: Sequence[Path]) -> _Edits:
    root = _Edits()
    for path in drops:
        node = root
        for key in path[:-1]:
            node = node.children.setdefault(key, _Edits())
        if path:
            node.drops.add(path[-1])
    for path in hashes:
        node = root
        for key in path:
            # Below a hashed value or a dropped key nothing is left to reach.
            if node.hashed or key in node.drops:
                break
            node = node.children.setdefault(key, _Edits())
        else:
            node.hashed = bool(path)
    return root


def _edit_variant(v: Column, edits: _Edits) -> Column:
    out = v
    if edits.drops or edits.children:
        m = v.try_cast(MAP)
        if edits.drops:
            m = F.map_filter(m, lambda k, _: ~k.isin(*sorted(edits.drops)))
        children = {k: e for k, e in edits.children.items() if k not in edits.drops}
        if children:

            def edit_entry(k: Column, x: Column) -> Column:
                case = None
                for key, child in children.items():
                    branch = _edit_variant(x, child)
                    case = F.when(k == key, branch) if case is None else case.when(k == key, branch)
                return case.otherwise(x)

            m = F.transform_values(m, edit_entry)
        out = F.coalesce(F.to_variant_object(m), v)
    if edits.hashed:
        hashed = F.sha2(value_text(out), 256).cast("variant")
        out = F.when(v.isNull() | F.is_variant_null(v), v).otherwise(hashed)
    return out


def _edit_struct(
    col: Column, dtype: T.DataType, edits: _Edits, root: bool = False
) -> tuple[Column, T.DataType]:
    if is_variant(dtype):
        return _edit_variant(col, edits), dtype
    if isinstance(dtype, T.StructType) and (edits.drops or edits.children):
        columns, fields = [], []
        for f in dtype.fields:
            if f.name in edits.drops:
                continue
            value, kind = col.getField(f.name), f.dataType
            if f.name in edits.children:
                value, kind = _edit_struct(value, kind, edits.children[f.name])
            columns.append(value.alias(f.name))
            hashed = f.name in edits.children and edits.children[f.name].hashed
            fields.append(T.StructField(f.name, kind, metadata={HEX: True} if hashed else None))
        built = F.struct(*columns)
        # The record itself is never NULL, so the scan can prune what is dropped from it.
        col, dtype = built if root else F.when(col.isNotNull(), built), T.StructType(fields)
    if edits.hashed:
        return F.when(col.isNotNull(), F.sha2(value_text(col, dtype), 256)), T.StringType()
    return col, dtype


def edit_paths(
    rec: Column,
    drops: Sequence[Path] = (),
    hashes: Sequence[Path] = (),
    dtype: T.DataType | None = None,
) -> tuple[Column, T.DataType | None]:
    """Drop paths, then hash paths in order; returns the record and its type (None for VARIANT)."""
    edits = _edits(drops, hashes)
    if is_variant(dtype):
        return _edit_variant(rec, edits), None
    return _edit_struct(rec, dtype, edits, root=True)


def drop_paths(rec: Column, paths: Sequence[Path], dtype: T.DataType | None = None) -> Column:
    """Delete each path; a missing key or a parent that is no object leaves the record as it is."""
    return edit_paths(rec, drops=paths, dtype=dtype)[0]


def hash_paths(rec: Column, paths: Sequence[Path], dtype: T.DataType | None = None) -> Column:
    """Replace each non-null value by the SHA-256 hex of its text, in the order of the paths."""
    return edit_paths(rec, hashes=paths, dtype=dtype)[0]


def set_path(rec: Column, path: Path, value: Column) -> Column:
    """Put a VARIANT at a path of a VARIANT record, creating the parents that are missing.

    A parent that exists but is no object cannot be entered and raises."""
    key, below = path[0], path[1:]

    def put(r: Column) -> Column:
        m = r.try_cast(MAP)
        refuse = F.raise_error(F.lit(f"cannot set {list(path)}: a parent is not an object"))
        opened = F.coalesce(
            m,
            F.when(r.isNull() | F.is_variant_null(r), F.create_map().cast(MAP)).otherwise(
                refuse.cast(MAP)
            ),
        )
        child = set_path(m.getItem(key), below, value) if below else value
        rest = F.map_filter(opened, lambda k, _: k != key)
        return F.to_variant_object(F.map_concat(rest, F.create_map(F.lit(key), child)))

    # Bound to a lambda's variable, so that the record is worked out once.
    return F.transform(F.array(rec), put).getItem(0)


__all__ = [
    "drop_paths", "edit_paths", "get_path", "get_raw", "hash_paths", "is_object", "json_path",
    "set_path", "type_at",
]
