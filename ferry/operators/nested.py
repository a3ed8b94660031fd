"""Recursive flatten of nested JSON objects to text leaves (SURVEY N1, F1, F2,
U1, P3, E5).

Semantics (the reference's recursive function):

* walk an object's entries in document order;
* a text value that starts with the prefix (case-sensitive) is a leaf:
  emit ``(key, value)`` -- only the leaf's own key, so keys repeat;
* an object value is walked in place (depth first), so its leaves come
  before the entries that follow it;
* anything else -- numbers, null, lists (even lists of URLs), text not
  starting with the prefix -- is dropped;
* a key repeated inside one object behaves as in a parsed dict: it stays
  at its first position and takes its last value.

Spark plan: one narrow, lazy ``mapInArrow`` over the document column; no
shuffle, no intermediate table, no session setting. A built-in expression can
only walk as many levels as it nests lambdas, and the analyser's time for them
grows with each level, so a document of any depth is walked by a small helper
with an explicit stack: time follows the text, not the depth. Leaves leave a
task in bounded batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ferry.operators.project import quoted
from ferry.session import ship_package

BATCH_LEAVES = 20_000


def path_keys(root: str | None) -> list[str]:
    """Keys of a path ``$.a.b`` or ``$['a']['b']`` (none for ``None``)."""
    if root is None:
        return []
    step = r"\.([^.\[\]]+)|\['([^']+)'\]"
    if not re.fullmatch(rf"\$(?:{step})*", root):
        raise ValueError(f"not a path of object keys: {root}")
    return [a or b for a, b in re.findall(step, root[1:])]


def walk_leaves(text: str | None, keys: list[str], prefix: str) -> Iterator[tuple[str, str]]:
    """Text leaves of one document under the object at ``keys``. Raises on
    malformed text and on a missing, null or other value in its place."""
    node = json.loads(text) if text is not None else None
    for key in keys:
        node = node.get(key) if isinstance(node, dict) else None
    if not isinstance(node, dict):
        raise ValueError(f"document without an object at {'.'.join(['$', *keys])}")
    stack = [iter(node.items())]
    while stack:
        for key, value in stack[-1]:
            if isinstance(value, dict):
                stack.append(iter(value.items()))
                break
            if isinstance(value, str) and value.startswith(prefix):
                yield key, value
        else:
            stack.pop()


def _text(s: str) -> str:
    """``s`` with any half of a surrogate pair replaced (not valid text)."""
    return s if s.isascii() else s.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _walker(keys: list[str], prefix: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, docs = batch.column(0), batch.column(1)
            at: list[int] = []
            rows: tuple[list, list, list] = ([], [], [])

            def full() -> pa.RecordBatch:
                columns = [ids.take(pa.array(at, pa.int64())), pa.array(rows[0], pa.int64()),
                           pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
                return pa.RecordBatch.from_arrays(columns, names=names)

            for n, doc in enumerate(docs):
                for pos, (key, value) in enumerate(walk_leaves(doc.as_py(), keys, prefix)):
                    at.append(n)
                    for column, x in zip(rows, (pos, _text(key), _text(value)), strict=True):
                        column.append(x)
                    if len(at) >= BATCH_LEAVES:
                        yield full()
                        at, rows = [], ([], [], [])
            yield full()
    return run


def text_leaves(docs: DataFrame, id_col: str, json_col: str, root: str | None = None,
                prefix: str = "http", key_name: str = "key", value_name: str = "value",
                levels_per_pass: int | None = None) -> DataFrame:
    """All text leaves starting with ``prefix`` under ``root`` of each document.

    Returns ``id_col, leaf_pos, key_name, value_name``; ``leaf_pos`` is the
    0-based position of the leaf in document order within its document.
    Malformed JSON, a missing or null root, or a root that is not an object
    fails the query; an object without leaves gives no rows. Nothing runs
    before an action. ``levels_per_pass`` is accepted for callers of an
    earlier form; one pass walks every level (the depth is bounded by the
    JSON parser's own limit, some thousand levels).
    """
    ship_package(docs.sparkSession)
    rows = docs.select(quoted(id_col), quoted(json_col))
    schema = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType), T.StructField("leaf_pos", T.LongType()),
        T.StructField(key_name, T.StringType()), T.StructField(value_name, T.StringType())])
    return rows.mapInArrow(_walker(path_keys(root), prefix, schema.names), schema)
