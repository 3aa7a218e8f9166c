"""Reading loosely typed JSON through VARIANT: parse once, extract natively many times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_EPOCH_S = -62_135_596_800  # 0001-01-01T00:00:00Z
MAX_EPOCH_S = 253_402_300_799  # 9999-12-31T23:59:59Z


def strict_json(text: Column) -> Column:
    """Two-element VARIANT ``[document, checksum]``, or NULL for malformed text.

    The parser stops quietly at the end of the first value. Wrapping the text together with
    its own checksum exposes whatever follows: the checksum is the second element only when
    the text is exactly one value. Read the document with :func:`json_document`.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), F.crc32(text), F.lit("]")))


def json_document(wrapped: Column, text: Column) -> Column:
    """The VARIANT document inside :func:`strict_json`, NULL when ``text`` was not valid JSON."""
    checksum = F.try_variant_get(wrapped, "$[1]", "bigint")
    return F.when(checksum == F.crc32(text), F.try_variant_get(wrapped, "$[0]", "variant"))


def json_value(v: Column, path: str) -> Column:
    """Member as VARIANT: SQL NULL when absent, a JSON null stays a (non-NULL) VARIANT null."""
    return F.try_variant_get(v, path, "variant")


def json_text(v: Column, path: str) -> Column:
    """Member as text; objects and arrays come as JSON text, JSON null and absent as NULL."""
    return F.try_variant_get(v, path, "string")


def json_long(v: Column, path: str) -> Column:
    """Lenient integer: integral numbers and texts, truncated floats, booleans as 0/1, else NULL."""
    return F.try_variant_get(v, path, "bigint")


def json_list(v: Column, path: str) -> Column:
    """Member as an array of VARIANT, NULL when it is not a list."""
    return F.try_variant_get(v, path, "array<variant>")


def json_kind(v: Column) -> Column:
    """Type name of a VARIANT: OBJECT, ARRAY, STRING, BOOLEAN, VOID, BIGINT, ..."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def json_scalar(v: Column, path: str) -> Column:
    """Scalar member as text; NULL for objects and arrays."""
    text = json_text(v, path)
    # only a text that looks like a container needs its type looked at
    looks_nested = F.left(text, F.lit(1)).isin("{", "[")
    kind = json_kind(json_value(v, path))
    return F.when(~looks_nested | (kind == "STRING"), text)


def is_truthy(v: Column, path: str) -> Column:
    """False for absent, null, false, zero, empty text, empty list and empty object."""
    text = json_text(v, path)
    looks_falsy = text.isin("", "0", "0.0", "-0.0", "false", "[]", "{}")
    # a text member with one of these spellings is falsy only when it is empty
    return (
        F.when(text.isNull(), F.lit(False))
        .when(~looks_falsy, F.lit(True))
        .otherwise((text != "") & (F.schema_of_variant(json_value(v, path)) == "STRING"))
    )


def epoch_seconds(v: Column, path: str) -> Column:
    """Epoch seconds as a timestamp, NULL for garbage and years beyond 1..9999."""
    sec = json_long(v, path)
    return F.when(sec.between(MIN_EPOCH_S, MAX_EPOCH_S), F.timestamp_seconds(sec))


def long_overflows(v: Column, path: str) -> Column:
    """True when the member is an integer or a finite float too large for BIGINT.

    A number only counts as a float if it is none in quotes: a text like that is no integer at all.
    """
    text = json_text(v, path)
    digits = F.coalesce(text.rlike(r"^\s*[+-]?\d{19,}\s*$"), F.lit(False))
    is_number = F.coalesce(json_kind(json_value(v, path)).isin("DECIMAL", "DOUBLE", "FLOAT"), F.lit(False))
    size = F.abs(F.try_variant_get(v, path, "double"))
    huge = is_number & F.coalesce((size >= 2.0**63) & (size < float("inf")), F.lit(False))
    return json_long(v, path).isNull() & (digits | huge)
