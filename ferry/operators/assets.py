"""Binary asset checks with a placeholder fallback.

The reference fetches one image per row, keeps it when the response says
``image/...`` and the bytes decode, and otherwise uses one placeholder
image fetched once. Here the per-row decision is a column expression; the
placeholder is a literal shared by every row (no per-row fetch, no join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import starts_with

PLACEHOLDER_URL = "https://placeholder.example.com/150.png"


def choose_asset(df: DataFrame, url_col: str, content_type_col: str,
                 placeholder: str = PLACEHOLDER_URL) -> DataFrame:
    """Keep the URL when its content type starts with ``image/``
    (case-sensitive; a missing type counts as ``''``), else the placeholder
    (F3, J2, X11)."""
    is_image = starts_with(F.coalesce(F.col(content_type_col), F.lit("")), "image/")
    return (df.withColumn("is_image", is_image)
            .withColumn("asset_url", F.when(F.col("is_image"), F.col(url_col))
                        .otherwise(F.lit(placeholder))))


def audit_images(measured: DataFrame, columns, key: str,
                 placeholder: str = PLACEHOLDER_URL) -> DataFrame:
    """Manifest rows with image size or a placeholder (F4, P8), from
    ``sources.assets.with_image_sizes``: an empty or unreadable file is
    ``unidentified``, one that is not there ``missing``."""
    ok = F.col("_status") == F.lit("ok")
    return measured.select(
        *[F.col(c) for c in columns], F.col("_status").alias("status"),
        F.col("_width").alias("width"), F.col("_height").alias("height"),
        F.when(ok, F.col(key)).otherwise(F.lit(placeholder)).alias("asset"))


def audit_fetched(rows: DataFrame, fetched: DataFrame, url_col: str,
                  placeholder: str = PLACEHOLDER_URL) -> DataFrame:
    """The reference's per-row check on fetched assets.

    ``fetched`` is ``fetch_urls(..., measure_image=True)``. A row without a
    URL is ``missing``; a response whose content type is not ``image/...``
    is ``not_image`` (whatever its HTTP status); bytes that are not a
    recognisable image, or none, are ``unidentified``; otherwise ``ok`` with
    the image size. Anything but ``ok`` gets the placeholder.
    """
    j = rows.join(fetched.withColumnRenamed("url", url_col), url_col, "left")
    is_image = starts_with(F.coalesce(F.col("content_type"), F.lit("")), "image/")
    status = (F.when(F.col("http_status").isNull(), F.lit("missing"))
              .when(~is_image, F.lit("not_image"))
              .when(F.col("width") < 0, F.lit("unidentified"))
              .otherwise(F.lit("ok")))
    ok = status == F.lit("ok")
    return j.select(*[F.col(c) for c in rows.columns], status.alias("status"),
                    F.when(ok, F.col("width")).alias("width"),
                    F.when(ok, F.col("height")).alias("height"),
                    F.when(ok, F.col(url_col)).otherwise(F.lit(placeholder)).alias("asset"))
