"""Stream configuration: one dataclass with the fields of a stream's config JSON."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

Path = tuple[str, ...]

SOURCE_TYPES = ("csv", "jsonl", "rest")
PAGINATION_STRATEGIES = ("next", "query")


def _path(value: Sequence[str], what: str) -> Path:
    if isinstance(value, str) or not all(isinstance(k, str) for k in value):
        raise ValueError(f"{what} must be a list of object keys, got {value!r}")
    return tuple(value)


def _paths(value: Sequence[Sequence[str]] | None, what: str) -> tuple[Path, ...]:
    paths = tuple(_path(p, what) for p in value or ())
    if any(not p for p in paths):
        raise ValueError(f"{what} holds an empty path")
    return paths


@dataclass(frozen=True)
class StreamConfig:
    stream_name: str
    unique_key_path: Path
    source_type: str = "jsonl"
    url: str = ""
    drop_field_paths: tuple[Path, ...] = ()
    sensitive_field_paths: tuple[Path, ...] = ()
    records_path: Path | None = None
    pagination: bool = False
    pagination_strategy: str | None = None
    pagination_next_path: Path = ()
    query_parameter: str = ""
    query_value: int = 0
    query_increment: int = 0
    #: Whether quoted CSV fields may hold newlines; files can be split between tasks only if not.
    multi_line: bool = True
    #: What a run does with lines that give no record: "quarantine" them in its rejects, or "fail". By
    #: default rows of a CSV scan fail, and all others are quarantined.
    on_bad: str | None = None

    def __post_init__(self) -> None:
        set_ = lambda name, value: object.__setattr__(self, name, value)
        set_("unique_key_path", _path(self.unique_key_path, "unique_key_path"))
        set_("drop_field_paths", _paths(self.drop_field_paths, "drop_field_paths"))
        set_("sensitive_field_paths", _paths(self.sensitive_field_paths, "sensitive_field_paths"))
        set_("pagination_next_path", _path(self.pagination_next_path, "pagination_next_path"))
        if self.records_path is not None:
            set_("records_path", _path(self.records_path, "records_path"))
        if not self.stream_name:
            raise ValueError("stream_name is required")
        if not self.unique_key_path:
            raise ValueError("records.unique_key_path is required")
        if self.source_type not in SOURCE_TYPES:
            raise ValueError(f"source_type must be one of {SOURCE_TYPES}, got {self.source_type!r}")
        if self.on_bad not in (None, "quarantine", "fail"):
            raise ValueError(f"on_bad must be quarantine or fail, got {self.on_bad!r}")
        if self.pagination and self.pagination_strategy not in PAGINATION_STRATEGIES:
            raise ValueError(f"pagination_strategy must be one of {PAGINATION_STRATEGIES}")
        if self.pagination and self.pagination_strategy == "next" and not self.pagination_next_path:
            raise ValueError("pagination_next_path is required by the next strategy")
        if self.pagination and self.pagination_strategy == "query" and not self.query_parameter:
            raise ValueError("pagination_query.query_parameter is required by the query strategy")
        if any(self.unique_key_path[: len(p)] == p for p in self.drop_field_paths):
            warnings.warn(
                f"stream {self.stream_name}: the unique key is dropped, so every record will have a "
                "null natural key and fail a discovered schema",
                stacklevel=2,
            )

    @classmethod
    def from_dict(cls, doc: Mapping) -> StreamConfig:
        """Build from the nested form of a config file."""
        records = doc.get("records") or {}
        response = (doc.get("rest") or {}).get("response") or {}
        query = response.get("pagination_query") or {}
        return cls(
            stream_name=doc.get("stream_name", ""),
            unique_key_path=records.get("unique_key_path") or (),
            source_type=doc.get("source_type", ""),
            url=doc.get("url", ""),
            drop_field_paths=records.get("drop_field_paths") or (),
            sensitive_field_paths=records.get("sensitive_field_paths") or (),
            records_path=response.get("records_path"),
            pagination=bool(response.get("pagination", False)),
            pagination_strategy=response.get("pagination_strategy"),
            pagination_next_path=response.get("pagination_next_path") or (),
            query_parameter=query.get("query_parameter", ""),
            query_value=query.get("query_value", 0),
            query_increment=query.get("query_increment", 0),
            multi_line=(doc.get("csv") or {}).get("multi_line", True),
            on_bad=records.get("on_bad"),
        )

    @classmethod
    def from_file(cls, path: str) -> StreamConfig:
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(json.load(f))
