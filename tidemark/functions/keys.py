"""Content and extraction keys of a record, from its canonical text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.paths import drop_paths
from tidemark.functions.values import canonical_text

# The metadata fields each record carries.
NATURAL_KEY = "_sdc_natural_key"
SURROGATE_KEY = "_sdc_surrogate_key"
TIMESTAMP = "_sdc_timestamp"
UNIQUE_KEY = "_sdc_unique_key"
META_FIELDS = (NATURAL_KEY, SURROGATE_KEY, TIMESTAMP, UNIQUE_KEY)
KEY_PROPERTIES = (UNIQUE_KEY, SURROGATE_KEY)


def surrogate_key(text: Column) -> Column:
    """SHA-256 hex of the record's canonical text."""
    return F.sha2(text, 256)


def without_meta(rec: Column, text: Column) -> Column:
    """Canonical text without metadata fields the source record may itself hold."""
    cleaned = canonical_text(drop_paths(rec, [(name,) for name in META_FIELDS]))
    return F.when(text.contains('"_sdc_'), cleaned).otherwise(text)


def stamped_text(
    text: Column, nk_json: Column, sk: Column, ts: Column, uk: Column | None = None
) -> Column:
    """The record's JSON text with its metadata fields put in front.

    The parts are JSON already, so no second serialisation of the record is needed."""
    parts = [
        F.lit(f'{{"{NATURAL_KEY}":'), nk_json,
        F.lit(f',"{SURROGATE_KEY}":"'), sk,
        F.lit(f'","{TIMESTAMP}":"'), ts,
    ]
    if uk is not None:
        parts += [F.lit(f'","{UNIQUE_KEY}":"'), uk]
    rest = F.when(text == "{}", F.lit("}")).otherwise(
        # The text of an object begins with one brace; counting characters to cut it off costs more than a hash.
        F.concat(F.lit(","), F.ltrim(text, F.lit("{")))
    )
    return F.concat(*parts, F.lit('"'), rest)


def unique_key(
    text: Column, clean_text: Column, nk_json: Column, sk: Column, ts: Column, salt: Column | None = None
) -> Column:
    """SHA-256 hex over the content text followed by the stamped record's text."""
    parts = [text, stamped_text(clean_text, nk_json, sk, ts)]
    if salt is not None:
        parts.append(salt.cast("string"))
    return F.sha2(F.concat(*parts), 256)
