"""Column-oriented hand-over JSON writer.

The reference serialises a whole table as ``{"col": {"row label": value}}``
in one string. Here the table is cut into chunks of at most ``chunk_rows`` rows
and ``chunk_bytes`` bytes (side by side in row position) and each chunk is
written as one such object per line. Row labels are the global
0-based positions, so chunks can be read back in any order.

``write_column_text`` gives the reference's own form, one text for the whole
table, written by many tasks at their offsets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.operators.cuts import CUT_BYTES, cut_rows
from ferry.operators.ordinal import with_ordinal
from ferry.operators.project import quoted
from ferry.sinks.one_file import write_one_file


def _object_text(names: list[str]):
    """Rows ``(label, *JSON values)`` as one column-oriented object."""
    def render(rows: list[tuple]) -> str:
        return "{" + ",".join(
            name + ":{" + ",".join(f'"{r[0]}":{r[k]}' for r in rows) + "}"
            for k, name in enumerate(names, 1)) + "}"
    return render


def _value_text(c: str):
    """One value as JSON text (``null`` for none)."""
    one = F.to_json(F.struct(quoted(c).alias("v")), {"ignoreNullFields": "false"})
    return F.substr(one, F.lit(6), F.length(one) - 6)


def column_json_chunks(df: DataFrame, order_by: Sequence[str], chunk_rows: int = 100_000,
                       chunk_bytes: int = CUT_BYTES) -> DataFrame:
    """One ``value`` text per chunk: ``{"col": {"label": v, ...}, ...}``, of at
    most ``chunk_rows`` rows and about ``chunk_bytes``. One shuffle, the sort's."""
    cols = list(df.columns)
    texts = [f"_v{k}" for k in range(len(cols))]
    pos = with_ordinal(df, order_by).select(
        "ordinal", *[_value_text(c).alias(t) for c, t in zip(cols, texts, strict=True)])
    names = [json.dumps(c, ensure_ascii=False) for c in cols]
    # A row's share of an object: its label in quotes, a colon and a comma.
    return cut_rows(pos, texts, chunk_bytes, chunk_rows, _object_text(names),
                    overhead=len(cols) * 16).select(F.col("text").alias("value"))


def write_column_json(df: DataFrame, path: str, order_by: Sequence[str],
                      chunk_rows: int = 100_000, mode: str = "overwrite",
                      chunk_bytes: int = CUT_BYTES) -> str:
    column_json_chunks(df, order_by, chunk_rows, chunk_bytes).write.mode(mode).text(path)
    return path


def write_column_text(df: DataFrame, path: str, order_by: Sequence[str]) -> str:
    """The whole table as one ``{"col": {"label": v, ...}, ...}`` text in one
    file: columns in their order, labels the 0-based positions by ``order_by``."""
    cols = list(df.columns)
    pos = with_ordinal(df, order_by, name="_label")
    names = [json.dumps(c, ensure_ascii=False) for c in cols]

    entries = pos.select("_label", F.posexplode(F.array(*[_value_text(c) for c in cols]))
                         .alias("_c", "_j"))
    opening = F.element_at(F.array(*[F.lit("{" * (not k) + "}," * bool(k) + n + ":{")
                                     for k, n in enumerate(names)]), F.col("_c") + 1)
    text = F.concat(F.when(F.col("_label") == 0, opening).otherwise(F.lit(",")), F.lit('"'),
                    F.col("_label").cast("string"), F.lit('":'), F.col("_j"))
    bare = "{" + ",".join(n + ":{}" for n in names) + "}"
    return write_one_file(entries.select("_c", "_label", text.alias("_text")), "_text",
                          ["_c", "_label"], path, tail="}}", empty=bare)
