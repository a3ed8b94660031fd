"""Stage the FIXTURES.md inputs from the driver tables, with Spark.

The reference reads JSON APIs, SQL tables and document stores; the driver
gives Parquet tables. Each fixture here is derived from a driver table by a
Spark job and written, in the format the reference's source would hand us,
under the shared scratch folder. Its size therefore grows with the tables.

The same rules are written independently as SQL in ``ferry.plans.oracle``
so DuckDB derives identical rows from the same Parquet files.

A staged fixture is reused for the life of the Spark application (keyed by
application id, table folder and fixture name); every staging run writes a
new folder, nothing is overwritten or deleted.
"""

from __future__ import annotations

import os
import struct
import threading
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import scratch_path, ship_package

_STAGED: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCK = threading.RLock()


def _staged(name: str):
    def deco(fn: Callable[[SparkSession, str, str], None]):
        def get(spark: SparkSession, sf_dir: str) -> str:
            key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)
            with _LOCK:  # one staging per fixture, even with concurrent callers
                if key not in _STAGED:
                    path = scratch_path(spark, f"fixture-{name}")
                    _STAGED[key] = fn(spark, sf_dir, path) or path
                return _STAGED[key]
        get.__name__ = name
        get.__doc__ = fn.__doc__
        return get
    return deco


def _case(key: Column, values: list) -> Column:
    """``values[key]`` as a CASE expression (``None`` entries give NULL)."""
    out = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        out = F.when(key == i, lit) if out is None else out.when(key == i, lit)
    return out


# ---------------------------------------------------------------- daily_metrics

def daily_metrics_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order date: what the daily metrics API returns."""
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return (o.groupBy(day.alias("day"))
            .agg(F.count(F.lit(1)).alias("positive"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
                 F.count_if(F.col("o_orderstatus") == "O").alias("n_o"))
            .select(F.date_format("day", "yyyyMMdd").cast("int").alias("date"),
                    F.col("positive"),
                    F.nullif(F.col("n_f"), F.lit(0)).alias("death"),
                    F.when(F.col("day") >= F.lit("1996-01-01").cast("date"),
                           F.col("n_o")).alias("hospitalizedCurrently"),
                    F.lit(56).alias("states"),
                    F.lit("c0ffee").alias("hash")))


@_staged("daily_metrics")
def daily_metrics(spark: SparkSession, sf_dir: str, path: str) -> None:
    """JSON lines; NULL counts are absent fields, as in the API payload."""
    daily_metrics_frame(spark, sf_dir).write.json(path)


@_staged("daily_metrics_array")
def daily_metrics_array(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The payload as one JSON array in one file, the youngest day first."""
    return _write_array(daily_metrics_frame(spark, sf_dir), f"{path}/daily.json")


def _write_array(days: DataFrame, path: str) -> str:
    from ferry.operators.ordinal import with_ordinal
    from ferry.sinks.one_file import write_one_file

    numbered = with_ordinal(days.withColumn("_k", -F.col("date")), ["_k"])
    text = F.concat(F.when(F.col("ordinal") == 0, F.lit("")).otherwise(F.lit(",\n ")),
                    F.to_json(F.struct(*days.columns)))
    return write_one_file(numbered.select("ordinal", text.alias("text")), "text", ["ordinal"],
                          path, "[", "]\n")


def day_payload(spark: SparkSession, sf_dir: str, k: int, path: str) -> str:
    """What the API returns on day ``k`` of three: a third of the records."""
    days = daily_metrics_frame(spark, sf_dir)
    return _write_array(days.filter(F.col("date") % 3 == k), path)


# ---------------------------------------------------------------------- photos

PHOTO_CONTENT_TYPES = ["image/png", "image/jpeg", "text/html", None, "IMAGE/PNG"]


def photos_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    return p.select(
        (pid % 10).alias("albumId"),
        pid.alias("id"),
        F.col("url").alias("title"),
        F.col("url"),
        F.concat(F.col("url"), F.lit("/thumb")).alias("thumbnailUrl"),
        _case(pid % 5, PHOTO_CONTENT_TYPES).alias("content_type"))


@_staged("photos")
def photos(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Records in an order in which the ids do not ascend, over four files
    whose names follow that order."""
    order = [(F.col("id") * 7919) % 10007, F.col("id")]
    (photos_frame(spark, sf_dir).repartitionByRange(4, *order)
     .sortWithinPartitions(*order).write.json(path))


# ----------------------------------------------------------------------- users

def users_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        k.cast("string").alias("_id"),
        F.lower("c_name").alias("username"),
        F.concat(F.col("c_name"),
                 F.when(k % 11 == 0, F.lit(" <b>&")).otherwise(F.lit(""))).alias("name"),
        F.concat(F.lit("user"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("c_mktsegment").alias("clase"),
        F.when(k % 7 != 0, (k % 80).cast("int")).alias("age"),
        F.when(k % 13 != 0, F.col("c_acctbal") < 0).alias("disabled"),
        F.timestamp_add("MINUTE", k, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("load_datetime"))


@_staged("users")
def users(spark: SparkSession, sf_dir: str, path: str) -> None:
    """JSON lines. ``age`` is an absent field when unknown; ``disabled`` is an
    explicit ``null`` -- both must read back as NULL. ``tag`` is a field that
    no declared schema has."""
    u = users_frame(spark, sf_dir).withColumn(
        "tag", F.concat(F.lit("tag "), F.col("_id"), F.lit(' "x"')))
    keep_nulls = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    with_age = F.to_json(F.struct("_id", "username", "name", "email", "clase", "age",
                                  "disabled", "load_datetime", "tag"), keep_nulls)
    no_age = F.to_json(F.struct("_id", "username", "name", "email", "clase",
                                "disabled", "load_datetime", "tag"), keep_nulls)
    (u.select(F.when(F.col("age").isNull(), no_age).otherwise(with_age).alias("value"))
     .write.text(path))


@_staged("growing_users")
def growing_users(spark: SparkSession, sf_dir: str, path: str) -> list[str]:
    """The users table at three times: by then the first third, two thirds and
    all of the keys had been loaded. ``load_hour`` is cut to the hour, so rows
    that arrive later share the value of the last mark."""
    u = users_frame(spark, sf_dir).select(
        "_id", "username", F.date_trunc("HOUR", "load_datetime").cast("timestamp_ntz")
        .alias("load_hour"))
    last = table(spark, sf_dir, "customer").agg(F.max("c_custkey")).first()[0]
    folders = []
    for k in (1, 2, 3):
        folders.append(f"{path}/{k}")
        u.filter(F.col("_id").cast("long") * 3 <= last * k).write.parquet(folders[-1])
    return folders


# ------------------------------------------------------------------- task_runs

def task_runs_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("event_id").alias("run_id"),
        F.col("ts"),
        F.concat(F.lit("dag_"), (F.col("user_id") % 20).cast("string")).alias("dag_id"),
        F.concat(F.lit("task_"), (k % 4).cast("string")).alias("task_id"),
        F.to_date("ts").alias("execution_date"),
        F.when(F.col("event_type") == "error", F.lit("failed"))
        .otherwise(F.lit("success")).alias("state"),
        F.concat(F.lit("http://logs.example.com/"), F.col("event_id").cast("string"))
        .alias("log_url"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 9 != 0),
               F.concat(F.lit("ValueError: bad value "), (F.col("event_id") % 100).cast("string")))
        .alias("exception"))


@_staged("task_runs")
def task_runs(spark: SparkSession, sf_dir: str, path: str) -> None:
    task_runs_frame(spark, sf_dir).write.parquet(path)


# ----------------------------------------------------------------- asset_trees

# One nested document per supplier. Every tenth document has no URL leaf.
# ``{b}`` is the supplier's http base, ``{k}`` its key.
_TREE = ('{{"name":"{name}","sprites":{{'
         '"front_default":"{b}/f",'
         '"back_female":null,'
         '"other":{{"dream-world":{{"front_default":"{b}/d"}},'
         '"official-artwork":{{"front_default":"https://img.example.com/{k}/o"}},'
         '"upper":"HTTP://IMG.EXAMPLE.COM/{k}/U"}},'
         '"versions":{{"generation-i":{{"red":{{"front_gray":"{b}/g"}}}}}},'
         '"back_default":"{b}/b",'
         '"order":{k},'
         '"list":["{b}/l"],'
         '"trap":"{{\\"u\\": \\"{b}/t\\"}}",'
         '"empty":{{}}}}}}')
_TREE_NO_URL = ('{{"name":"{name}","sprites":{{'
                '"back_female":null,"order":{k},"list":["{b}/l"],'
                '"trap":"{{\\"u\\": \\"{b}/t\\"}}","empty":{{}},'
                '"other":{{"upper":"HTTP://IMG.EXAMPLE.COM/{k}/U"}}}}}}')


def _fill(template: str, **cols: Column) -> Column:
    """Fill ``{name}`` slots of a text template with column values."""
    import re
    parts = re.split(r"(?<!\{)\{(\w+)\}(?!\})", template)
    out = []
    for i, p in enumerate(parts):
        if i % 2:
            out.append(cols[p].cast("string"))
        elif p:
            out.append(F.lit(p.replace("{{", "{").replace("}}", "}")))
    return F.concat(*out)


def asset_trees_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    slots = dict(name=F.col("s_name"), k=k,
                 b=F.concat(F.lit("http://img.example.com/"), k.cast("string")))
    doc = F.when(k % 10 == 0, _fill(_TREE_NO_URL, **slots)).otherwise(_fill(_TREE, **slots))
    return s.select(k.alias("doc_id"), doc.alias("doc"))


@_staged("asset_trees")
def asset_trees(spark: SparkSession, sf_dir: str, path: str) -> None:
    asset_trees_frame(spark, sf_dir).write.parquet(path)


# ---------------------------------------------------------------- trajectories

@_staged("trajectories")
def trajectories(spark: SparkSession, sf_dir: str, path: str) -> None:
    e = table(spark, sf_dir, "embeddings")
    e.select("vec_id", F.col("embedding").alias("coordenadas")).write.parquet(path)


# --------------------------------------------------------------------- images

def png_bytes(width: int, height: int, rgb: tuple[int, int, int] = (200, 80, 40)) -> bytes:
    """A valid 8-bit RGB PNG of the given size (zlib + struct only)."""
    row = b"\x00" + bytes(rgb) * width
    def chunk(tag: bytes, data: bytes) -> bytes:
        return (struct.pack(">I", len(data)) + tag + data
                + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF))
    return (b"\x89PNG\r\n\x1a\n"
            + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(row * height))
            + chunk(b"IEND", b""))


def image_kind(page_id: int) -> str:
    """Which file a photo gets: five of eight decode, then one text file
    named ``.png``, one empty file, and one HTML page (no ``.png``)."""
    return ("png", "png", "png", "png", "png", "text", "empty", "html")[page_id % 8]


def image_size(page_id: int) -> tuple[int, int]:
    return 1 + page_id % 7, 1 + page_id % 5


def _write_images(out_dir: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ferry.sources.assets import file_system
        fsys, base = file_system(out_dir)
        fsys.create_dir(base, recursive=True)
        for pdf in batches:
            names = []
            for pid in pdf["page_id"].tolist():
                kind = image_kind(pid)
                name = f"{pid}.html" if kind == "html" else f"{pid}.png"
                data = {"png": lambda: png_bytes(*image_size(pid)),
                        "text": lambda: b"not an image", "empty": lambda: b"",
                        "html": lambda: b"<html>no image here</html>"}[kind]()
                with fsys.open_output_stream(f"{base}/{name}") as f:
                    f.write(data)
                names.append(name)
            yield pd.DataFrame({"id": pdf["page_id"], "name": names})
    return run


@_staged("images")
def images(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``{path}/files``: one file per photo, written by the executors;
    ``{path}/manifest``: ``id, name`` for every photo."""
    ship_package(spark)
    pages = table(spark, sf_dir, "pages").select("page_id")
    manifest = pages.mapInPandas(_write_images(f"{path}/files"), "id long, name string")
    manifest.write.parquet(f"{path}/manifest")


# ------------------------------------------------------- one document per URL

# The URL leaves of a document in document order, by their keys.
SPRITE_KEYS = ["front_default", "front_default", "front_gray", "back_default"]


def _write_documents(out_dir: str, image_root: str, n_images: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        from ferry.sources.assets import file_system
        fsys, base = file_system(out_dir)
        fsys.create_dir(base, recursive=True)
        for pdf in batches:
            for k in pdf["doc_id"].tolist():
                ids = [(k * len(SPRITE_KEYS) + i) % n_images for i in range(len(SPRITE_KEYS))]
                u = [f"{image_root}/{i}.{'html' if image_kind(i) == 'html' else 'png'}"
                     for i in ids]
                sprites = {"back_female": None, "order": k} if k % 10 == 0 else {
                    "front_default": u[0], "back_female": None,
                    "other": {"dream-world": {"front_default": u[1]}, "list": [u[0]]},
                    "versions": {"generation-i": {"red": {"front_gray": u[2]}}},
                    "back_default": u[3], "order": k}
                with fsys.open_output_stream(f"{base}/{k}.json") as f:
                    f.write(json.dumps({"name": f"s{k}", "sprites": sprites}).encode())
            yield pd.DataFrame({"doc_id": pdf["doc_id"],
                                "url": [f"{out_dir}/{k}.json" for k in pdf["doc_id"]]})
    return run


@_staged("sprite_documents")
def sprite_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``{path}/files``: one nested document per supplier, as an API returns
    it, whose leaves are URLs of the staged photo images (page ids count from
    0); ``{path}/manifest``: ``doc_id, url``."""
    ship_package(spark)
    n = table(spark, sf_dir, "pages").count()
    docs = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    written = docs.mapInPandas(_write_documents(f"{path}/files", f"{images(spark, sf_dir)}/files",
                                                n), "doc_id long, url string")
    written.write.parquet(f"{path}/manifest")


# ------------------------------------------------------- landed SQL tables

@_staged("sql_tables")
def sql_tables(spark: SparkSession, sf_dir: str, path: str) -> None:
    """``{path}/EXPERIMENTS`` (= part) and ``{path}/USERS`` as Parquet tables
    that every executor can read. (The JDBC reader itself is unit-tested on an
    embedded database, which only its own process sees.)"""
    table(spark, sf_dir, "part").write.parquet(f"{path}/EXPERIMENTS")
    users_frame(spark, sf_dir).write.parquet(f"{path}/USERS")


# ---------------------------------------------------------- task_runs stream

@_staged("task_run_files")
def task_run_files(spark: SparkSession, sf_dir: str, path: str, chunks: int = 4) -> None:
    """Task runs landed in ``chunks`` jobs out of ``ts`` order: a run lands by
    a hash of its id, so every key is spread over all landings and repeats
    arrive after runs that are days younger."""
    runs = task_runs_frame(spark, sf_dir).drop("exception")
    tagged = runs.withColumn("_chunk", F.pmod(F.xxhash64("run_id"), F.lit(chunks)))
    for i in range(chunks):
        tagged.where(F.col("_chunk") == i).drop("_chunk").write.mode("append").parquet(path)
