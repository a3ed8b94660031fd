"""JSON over HTTP as a Spark data source.

``spark.read.format("json_http").option("urls", ...)`` plans one input
partition per URL (or per ``urlsPerPartition`` URLs), so the requests run
on the executors, in parallel, and
the driver never holds a payload. The reader streams the response and splits
it into record texts; typing is done by Spark's JSON parser with the caller's
declared schema (``from_json``), exactly as for landed files.

Layouts:

* ``array`` -- the body is a JSON array of records (an API page);
* ``lines`` -- the body is JSON lines, one record per line;
* ``document`` -- the whole body is one record (e.g. one nested object).

A non-2xx response fails the read, as does a malformed body.

The URL list of ``read_json_http`` travels in the read options, which suits
a handful of API pages. When the URLs are themselves data (a table of
pages), use ``read_json_from_urls``: the URL column is fetched on the
executors (``fetch_urls``) and payloads are parsed by Spark.
"""

from __future__ import annotations

import codecs
import io
import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ferry.session import scratch_path

RAW_SCHEMA = "url string, ordinal long, record string"


class _UrlPartition(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(urls)
        self.urls = urls


CHUNK = 1 << 16
_SPACE = " \t\r\n"


def array_items(chunks: Iterator[str]) -> Iterator[str]:
    """The items of one JSON array as texts, without holding the array."""
    decoder = json.JSONDecoder()
    held, at, opened, comma = "", 0, False, False
    for chunk in chunks:
        held, at = held[at:] + chunk, 0
        while True:
            while at < len(held) and held[at] in _SPACE:
                at += 1
            if at == len(held):
                break
            if not opened:
                if held[at] != "[":
                    raise ValueError("the payload is not a JSON array")
                opened, at = True, at + 1
                continue
            if held[at] == "]":
                if held[at + 1:].strip(_SPACE) or any(c.strip(_SPACE) for c in chunks):
                    raise ValueError("text after the JSON array")
                return
            if comma:
                if held[at] != ",":
                    raise ValueError("no comma between items of the JSON array")
                comma, at = False, at + 1
                continue
            try:
                _, end = decoder.raw_decode(held, at)
            except json.JSONDecodeError:
                break  # the item goes on in the next chunk
            if end == len(held):
                break  # a number may go on
            yield held[at:end]
            at, comma = end, True
    raise ValueError("malformed or unfinished JSON array")


class JsonHttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = json.loads(options.get("urls", "[]"))
        self.layout = options.get("layout", "document")
        self.timeout = float(options.get("timeout", "60"))
        self.per_partition = max(1, int(options.get("urlsPerPartition", "1")))

    def partitions(self) -> Sequence[InputPartition]:
        n = self.per_partition
        return [_UrlPartition(self.urls[i:i + n]) for i in range(0, len(self.urls), n)]

    def read(self, partition: _UrlPartition) -> Iterator[tuple]:
        for url in partition.urls:
            for i, record in enumerate(self._records(url)):
                yield url, i, record

    def _records(self, url: str) -> Iterator[str]:
        with _open_url(url, self.timeout) as r:
            body = codecs.getreader("utf-8")(r)
            if self.layout == "document":
                yield body.read()
            elif self.layout == "lines":
                for line in r:
                    if line.strip():
                        yield line.decode("utf-8")
            else:
                yield from array_items(iter(lambda: body.read(CHUNK), ""))


def _open_url(url: str, timeout: float):
    """A byte stream of the body; an error status raises."""
    import urllib.request

    if url.split(":", 1)[0].lower() in ("http", "https"):
        return urllib.request.urlopen(url, timeout=timeout)  # raises HTTPError
    from ferry.sources.assets import file_system

    fsys, path = file_system(url)
    return io.BufferedReader(fsys.open_input_file(path))


class JsonHttpDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_http"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return JsonHttpReader(self.options)


def register(spark: SparkSession) -> None:
    from ferry.session import ship_package
    ship_package(spark)
    spark.dataSource.register(JsonHttpDataSource)


def read_json_http(spark: SparkSession, urls: Sequence[str], schema: T.StructType | str,
                   layout: str = "array", keep_source: bool = False,
                   urls_per_partition: int = 1,
                   required: Sequence[str] = ()) -> DataFrame:
    """Records fetched from ``urls``, typed by ``schema`` (FAILFAST).

    Every URL is requested once: the records are landed in the shared folder,
    and what is returned reads the landed table, so a later sort or retry does
    not fetch again. A column of ``required`` that no record has fails the
    read. ``keep_source`` adds ``url`` and ``ordinal``, the record's position
    in its payload.
    """
    register(spark)
    raw = (spark.read.format("json_http").option("urls", json.dumps(list(urls)))
           .option("layout", layout).option("urlsPerPartition", urls_per_partition).load())
    path = scratch_path(spark, "json-http")
    raw.write.parquet(path)
    landed = spark.read.schema(RAW_SCHEMA).parquet(path)
    check_present(landed, "record", required)
    st = schema if isinstance(schema, str) else schema.simpleString()
    extra = ["url", "ordinal"] if keep_source else []
    return landed.select(*extra, F.from_json("record", f"struct<{_fields(st)}>", _STRICT)
                         .alias("_r")).select(*extra, "_r.*")


def check_present(records: DataFrame, text_col: str, required: Sequence[str]) -> None:
    """Fail if a required column is in none of the records (an absent column
    is an error, a column that is null or absent in some records is not)."""
    if not required:
        return
    names = F.json_object_keys(F.col(text_col))
    row = records.agg(F.count("*").alias("n"), *[
        F.max(F.array_contains(names, c)).alias(f"_{i}") for i, c in enumerate(required)]).first()
    absent = [c for i, c in enumerate(required) if row["n"] and not row[f"_{i}"]]
    if absent:
        raise ValueError(f"columns missing from every record: {', '.join(absent)}")


_STRICT = {"mode": "FAILFAST"}


def _fields(ddl: str) -> str:
    """``"a BIGINT, b STRING"`` or ``"struct<a:bigint>"`` -> struct field list."""
    d = ddl.strip()
    if d.lower().startswith("struct<") and d.endswith(">"):
        return d[7:-1]
    return T._parse_datatype_string(d).simpleString()[7:-1]


def read_json_from_urls(urls: DataFrame, url_col: str, schema: T.StructType | str,
                        array: bool = True) -> DataFrame:
    """Fetch every URL of a column on the executors and parse the payloads.

    ``array=True``: each body is a JSON array of records (one row per
    record); otherwise each body is one record. A failed fetch or a
    non-2xx status fails the query.
    """
    from ferry.sources.assets import fetch_urls

    fetched = fetch_urls(urls, url_col)
    checked = fetched.select(
        "url", F.when(F.col("http_status").between(200, 299), F.col("content").cast("string"))
        .otherwise(F.raise_error(F.concat(F.lit("fetch failed: "), F.col("url"), F.lit(" "),
                                          F.col("http_status").cast("string"))))
        .alias("_body"))
    st = schema if isinstance(schema, str) else schema.simpleString()
    if array:
        parsed = F.explode(F.from_json("_body", f"array<{st}>", {"mode": "FAILFAST"}))
    else:
        parsed = F.from_json("_body", st, {"mode": "FAILFAST"})
    return checked.select("url", parsed.alias("_r")).select("url", "_r.*")
