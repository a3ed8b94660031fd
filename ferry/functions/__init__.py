"""Column-expression helpers; all JVM-side built-ins, no Python UDFs."""

from ferry.functions.dates import now_local, parse_yyyymmdd
from ferry.functions.json import (is_object, is_text, json_lookup, map_lookup,
                                  parse_strict, variant_type)
from ferry.functions.text import html_escape, join_list, py_str, starts_with

__all__ = [
    "now_local", "parse_yyyymmdd", "is_object", "is_text", "json_lookup",
    "map_lookup", "parse_strict", "variant_type", "html_escape", "join_list",
    "py_str", "starts_with",
]
