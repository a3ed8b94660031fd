"""String functions and Python-style value text (P5).

The reference renders values the way Python's ``str()`` does inside
templates: a missing value prints ``None`` and booleans print ``True`` /
``False``; nothing is HTML-escaped. Spark's casts print ``null``/``true``,
so the rendering is spelled out here as column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.functions.cols import as_col

# The text Python prints for a missing value and for booleans.
PY_NONE = "None"
PY_TRUE = "True"
PY_FALSE = "False"


def py_str(c, dtype: T.DataType | None = None) -> Column:
    """Text of a value as Python's ``str()`` prints it (no doubles)."""
    c = as_col(c)
    if isinstance(dtype, T.BooleanType):
        return (F.when(c.isNull(), F.lit(PY_NONE))
                .when(c, F.lit(PY_TRUE)).otherwise(F.lit(PY_FALSE)))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # Python prints all six fraction digits when there is a fraction.
        frac = F.date_format(c, "SSSSSS")
        txt = F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
                       F.when(frac != "000000", F.concat(F.lit("."), frac))
                       .otherwise(F.lit("")))
        return F.coalesce(txt, F.lit(PY_NONE))
    return F.coalesce(c.cast("string"), F.lit(PY_NONE))


def html_escape(c) -> Column:
    """Escape ``& < > "`` for HTML text (the reference does not; opt-in)."""
    c = as_col(c)
    for src, dst in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(src), F.lit(dst))
    return c


def starts_with(c, prefix: str) -> Column:
    """Case-sensitive prefix test; NULL input gives NULL."""
    return F.startswith(as_col(c), F.lit(prefix))


def join_list(items, sep: str = ", ") -> Column:
    """Join a list of texts with a separator."""
    if isinstance(items, (list, tuple)):
        items = F.array(*[F.lit(i) if isinstance(i, str) else i for i in items])
    return F.concat_ws(sep, as_col(items))
