"""Expressions on JSON payloads.

A payload is parsed once, into a VARIANT; every other expression reads from that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------
UNKNOWN_EVENT = "__UNKNOWN__"

SHAPE_INVALID = "invalid_json"
SHAPE_LEGACY = "legacy_event_envelope"
SHAPE_STANDARD = "standard_type_params"
SHAPE_UNKNOWN = "unknown_json_shape"

TYPE_BOOL = "UInt8"
TYPE_INT = "Int64"
TYPE_FLOAT = "Float64"
TYPE_STRING = "String"

EMPTY_RAW_VALUES = ["", "null", '""']
# ---------------------------------------------------------------------------

# Closes the one-element array that a payload is wrapped in.
_END_MARK = "~end of payload~"


def enclosed(payload: Column) -> Column:
    """Parse ``[payload, mark]``.

    ``try_parse_json`` stops after the first complete value and ignores whatever
    follows, so text after an object would pass.  Inside an array it cannot: junk
    breaks the array, a second value moves the mark, a stray bracket loses it.
    """
    return F.try_parse_json(F.concat(F.lit("["), payload, F.lit(f',"{_END_MARK}"]')))


def is_valid_json(wrapped: Column) -> Column:
    """Whether exactly one JSON value was enclosed; never NULL."""
    mark = F.try_variant_get(wrapped, "$[1]", "string") == _END_MARK
    return F.coalesce(mark, F.lit(False)) & F.try_variant_get(
        wrapped, "$[2]", "variant"
    ).isNull()


def at(wrapped: Column, *path: str) -> Column:
    """The value under a path of object keys as a VARIANT, NULL if absent."""
    keys = "".join(f".{key}" for key in path)
    return F.try_variant_get(wrapped, f"$[0]{keys}", "variant")


def has(wrapped: Column, *path: str) -> Column:
    """Whether a path exists; a JSON null exists."""
    return at(wrapped, *path).isNotNull()


def filled_text(value: Column) -> Column:
    """A VARIANT that is a JSON string, NULL when absent, empty or of another type."""
    is_text = F.schema_of_variant(value) == "STRING"
    return F.when(is_text, F.nullif(F.try_variant_get(value, "$", "string"), F.lit("")))


def texts_at(wrapped: Column, *path: str) -> Column:
    """A JSON array of strings, an empty array when absent or of another type."""
    value = F.try_variant_get(at(wrapped, *path), "$", "array<string>")
    return F.coalesce(value, F.array().cast("array<string>"))


def without_namespace(name: Column) -> Column:
    return F.regexp_replace(name, r"^.*\.", "")


def event_name(candidates: Sequence[Column]) -> Column:
    """The first non-empty candidate without its namespace, or the unknown name."""
    name = without_namespace(F.coalesce(*candidates, F.lit("")))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_EVENT))


def lacks_params(wrapped: Column) -> Column:
    """Whether a payload has no parameter value at all, or a JSON null."""
    params = at(wrapped, "params")
    return params.isNull() | F.is_variant_null(params)


def dlq_shape(valid: Column, wrapped: Column) -> Column:
    return (
        F.when(~valid, SHAPE_INVALID)
        .when(has(wrapped, "event"), SHAPE_LEGACY)
        .when(has(wrapped, "type") & has(wrapped, "params"), SHAPE_STANDARD)
        .otherwise(SHAPE_UNKNOWN)
    )


def params_map(wrapped: Column) -> Column:
    """The ``params`` object as ``map<string, variant>``; NULL when not an object."""
    return F.try_variant_get(wrapped, "$[0].params", "map<string,variant>")


def raw_text(value: Column) -> Column:
    """A value as JSON text: strings keep their quotes."""
    return F.to_json(value)


def is_filled(value: Column) -> Column:
    """Whether a value is neither a JSON null nor an empty string."""
    shown = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("-"))
    return ~F.is_variant_null(value) & (shown != "")


def value_kind(schema: Column, filled: Column) -> Column:
    """bool, int, float or other from the schema text of a VARIANT, NULL when empty.

    A whole number too long for 64 bits is held as a decimal without a fraction,
    which then has more digits than any number that was written with a point.
    """
    scale = F.regexp_extract(schema, r"^DECIMAL\((\d+),(\d+)\)$", 2)
    digits = F.regexp_extract(schema, r"^DECIMAL\((\d+),(\d+)\)$", 1)
    long_whole = (scale == "0") & (F.length(digits) == 2) & (digits > "18")
    return (
        F.when(~filled, None)
        .when(schema == "BOOLEAN", "bool")
        .when((schema == "BIGINT") | long_whole, "int")
        .when(schema.isin("DOUBLE", "FLOAT") | schema.startswith("DECIMAL"), "float")
        .otherwise("other")
    )


def merged_type(kinds_seen: dict[str, Column]) -> Column:
    """The parameter type for the kinds seen (boolean columns per kind)."""
    boolean, whole = kinds_seen["bool"], kinds_seen["int"]
    real, other = kinds_seen["float"], kinds_seen["other"]
    return (
        F.when(boolean & ~whole & ~real & ~other, TYPE_BOOL)
        .when(whole & ~boolean & ~real & ~other, TYPE_INT)
        .when(real & ~boolean & ~other, TYPE_FLOAT)
        .otherwise(TYPE_STRING)
    )
