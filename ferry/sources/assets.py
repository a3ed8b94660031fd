"""Binary assets: landed files and live fetches.

Landed assets named in a manifest are opened one by one by the task that
holds their row (``with_image_sizes``). Whole folders can also be read by
Spark's own file sources: ``image`` decodes and reports width/height (``-1``
when undecodable), ``binaryFile`` gives bytes and length.

Live assets (URLs) are fetched on the executors with ``mapInPandas``, one
Arrow batch at a time; the driver never sees the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferry.session import ship_package


def _relative_to(root: str):
    """Path of ``_origin`` below ``root`` (``a/b.png``), whatever URI form
    (``file:/x``, ``file:///x``) the source reports."""
    from urllib.parse import urlparse
    base = (urlparse(root).path if "://" in root or root.startswith("file:") else root)
    base = "/" + base.strip("/") + "/"
    origin = F.col("_origin")
    return F.substring(origin, F.instr(origin, base) + F.lit(len(base)), F.lit(1 << 30))


def read_image_sizes(spark: SparkSession, path: str, key: str = "name") -> DataFrame:
    """``key`` (path below ``path``, e.g. ``a/b.png``), ``width``, ``height``
    for every non-empty file under ``path`` (recursively), decoded by Spark's
    ``image`` source; ``-1``/``-1`` when it does not decode. CPU and memory
    heavy; ``with_image_sizes`` reads headers only."""
    img = (spark.read.format("image").option("dropInvalid", False)
           .option("recursiveFileLookup", True).load(path))
    return (img.select(F.col("image.origin").alias("_origin"),
                       F.col("image.width").alias("width"),
                       F.col("image.height").alias("height"))
            .select(_relative_to(path).alias(key), "width", "height"))


def file_system(uri: str):
    """(pyarrow file system, path) for a Hadoop-style file URI."""
    from urllib.parse import unquote, urlparse

    from pyarrow import fs as pafs
    u = urlparse(uri)
    if u.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(u.path)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(u.scheme, u.scheme)
    return pafs.FileSystem.from_uri(uri.replace(u.scheme + "://", scheme + "://", 1))


def _header_size(uri: str) -> tuple[str, int | None, int | None]:
    """Status and size of one landed file. A file that is not there is
    ``missing``; any other storage failure fails the task."""
    from ferry.functions.image_header import image_size

    fsys, p = file_system(uri)
    try:
        with fsys.open_input_file(p) as f:
            def read(off: int, n: int) -> bytes:
                f.seek(off)
                return f.read(n)
            size = image_size(read)
    except FileNotFoundError:
        return "missing", None, None
    return ("ok", *size) if size else ("unidentified", None, None)


# Remote header reads and fetches wait on storage / the network, not the
# CPU: each task overlaps that many requests (threads release the GIL on
# I/O). Local files are read in order -- threads would only add overhead.
IO_THREADS = 16


def _io_map(fn, items: list):
    if all(str(i).startswith("file:") or "://" not in str(i) for i in items):
        return [fn(i) for i in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(min(IO_THREADS, max(1, len(items)))) as pool:
        return list(pool.map(fn, items))


def _header_sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = pd.DataFrame(_io_map(_header_size, pdf["_path"].tolist()),
                           columns=["_status", "_width", "_height"], index=pdf.index)
        out = pd.concat([pdf, out], axis=1)
        yield out.astype({"_width": "Int32", "_height": "Int32"})


def with_image_sizes(manifest: DataFrame, path) -> DataFrame:
    """``manifest`` plus ``_path``, ``_status`` (``ok``, ``unidentified`` or
    ``missing``), ``_width``, ``_height`` of the file each row names.

    Every path is opened by the task that holds its row: no listing, no join.
    Only a few KB of header are read, no pixels.
    """
    ship_package(manifest.sparkSession)
    named = manifest.withColumn("_path", path)
    schema = T.StructType([*named.schema.fields, T.StructField("_status", T.StringType()),
                           T.StructField("_width", T.IntegerType()),
                           T.StructField("_height", T.IntegerType())])
    return named.mapInPandas(_header_sizes, schema)


def read_binary(spark: SparkSession, path: str, key: str = "name",
                with_content: bool = False) -> DataFrame:
    """``key`` (path below ``path``), ``length`` [, ``content``] for every
    non-empty file under ``path``."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = [F.col("path").alias("_origin"), "length"] + (["content"] if with_content else [])
    out = b.select(*cols)
    return out.select(_relative_to(path).alias(key),
                      *[c for c in out.columns if c != "_origin"])


FETCH_SCHEMA = "url string, http_status int, content_type string, content binary"
SIZED_SCHEMA = ("url string, http_status int, content_type string, n_bytes long, "
                "width int, height int")
# A batch of response bodies is handed on when it holds this many bytes.
BATCH_BYTES = 32 << 20


def _response(u: str, timeout: float) -> tuple[int, str | None, bytes]:
    """Status, content type and body of one URL. ``http(s)`` through the
    standard library (an error status is a response too); any other scheme
    through that storage's own file system, typed by its name."""
    import mimetypes
    import urllib.error
    import urllib.request

    if u.split(":", 1)[0].lower() in ("http", "https"):
        try:
            with urllib.request.urlopen(u, timeout=timeout) as r:
                return r.status, r.headers.get("Content-Type"), r.read()
        except urllib.error.HTTPError as e:
            with e:
                return e.code, e.headers.get("Content-Type"), e.read()
    fsys, p = file_system(u)
    with fsys.open_input_stream(p) as f:
        return 200, mimetypes.guess_type(p)[0], f.read()


def _fetch_one(u: str, timeout: float, attempts: int, measure: bool) -> tuple:
    """One row per URL; a URL that gives no response after ``attempts`` tries
    fails the task."""
    import time

    from ferry.functions.image_header import image_size

    for left in range(attempts - 1, -1, -1):
        try:
            status, kind, body = _response(u, timeout)
            break
        except FileNotFoundError:
            raise
        except OSError:
            if not left:
                raise
            time.sleep(0.2 * (attempts - left))
    if not measure:
        return u, status, kind, body
    w, h = image_size(lambda off, n: body[off:off + n]) or (-1, -1)
    return u, status, kind, len(body), w, h


def _fetch_batches(url_col: str, timeout: float, attempts: int, measure: bool):
    cols = (["url", "http_status", "content_type", "n_bytes", "width", "height"]
            if measure else ["url", "http_status", "content_type", "content"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            urls, rows, held = pdf[url_col].tolist(), [], 0
            for i in range(0, len(urls), IO_THREADS):
                rows += _io_map(lambda u: _fetch_one(u, timeout, attempts, measure),
                                urls[i:i + IO_THREADS])
                held += 0 if measure else sum(len(r[3]) for r in rows[-IO_THREADS:])
                if held >= BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=cols)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=cols)
    return run


def fetch_urls(df: DataFrame, url_col: str, timeout: float = 30.0, attempts: int = 3,
               measure_image: bool = False) -> DataFrame:
    """Fetch each URL once on the executors (S6, live form).

    Returns ``url, http_status, content_type, content``; join it back on
    ``url``. Distinct URLs are fetched, so a URL shared by many rows costs one
    request. A response with an error status is a row like any other; a fetch
    that gives no response fails the query after ``attempts`` tries.
    ``measure_image=True`` reads the image size from the bytes in the same
    pass and returns ``n_bytes, width, height`` (-1 where they are no image)
    instead of the content, so no bytes travel through later shuffles.
    """
    ship_package(df.sparkSession)
    urls = df.select(F.col(url_col).alias("url")).where(F.col("url").isNotNull()).distinct()
    return urls.mapInPandas(_fetch_batches("url", timeout, attempts, measure_image),
                            SIZED_SCHEMA if measure_image else FETCH_SCHEMA)
