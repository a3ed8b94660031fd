"""JSON functions: parse, look up with default, type test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferry.functions.cols import as_col


def json_lookup(c, path: str, default: str | None = None) -> Column:
    """Value at a JSON path as text, or ``default`` when absent."""
    v = F.get_json_object(as_col(c), path)
    return v if default is None else F.coalesce(v, F.lit(default))


def map_lookup(m, key: str, default: str | None = None) -> Column:
    """``m.get(key, default)`` on a map column."""
    v = F.try_element_at(as_col(m), F.lit(key))
    return v if default is None else F.coalesce(v, F.lit(default))


def variant_type(v) -> Column:
    """Upper-case type name of a variant value: STRING, OBJECT<...>, ...."""
    return F.schema_of_variant(as_col(v))


def is_text(v) -> Column:
    return variant_type(v) == F.lit("STRING")


def is_object(v) -> Column:
    return F.startswith(variant_type(v), F.lit("OBJECT"))


def parse_strict(c, schema: str) -> Column:
    """Parse JSON text; malformed text fails the query instead of giving NULL."""
    return F.from_json(as_col(c), schema, {"mode": "FAILFAST"})
