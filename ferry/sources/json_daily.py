"""A payload a day, each read once.

The reference fetches its whole payload anew every day. Here the payloads of
successive days are a stream: ``url`` holds ``{ds}``, which becomes
``2024-01-10`` and so on from ``start``. The offset is the number of days read;
a batch takes the days from there up to the first one that is not there yet,
so a late day is waited for and none is skipped. Offsets and rows are committed
by the query's checkpoint, so a payload is read once, also after a restart, and
a batch that is repeated reads the same days again.

One input partition per day, read on the executors as a stream of records
(``json_http``); the driver only asks whether the next day is there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ferry.functions.json import parse_strict
from ferry.session import ship_package
from ferry.sources.json_http import JsonHttpReader

SCHEMA = "ds DATE, ordinal BIGINT, record STRING"


class _Day(InputPartition):
    def __init__(self, ds: dt.date, url: str):
        self.ds, self.url = ds, url


def is_there(url: str, timeout: float = 30.0) -> bool:
    """Whether a payload can be fetched; anything but "not there" raises."""
    if url.split(":", 1)[0].lower() in ("http", "https"):
        import urllib.error
        import urllib.request

        try:
            request = urllib.request.Request(url, method="HEAD")
            with urllib.request.urlopen(request, timeout=timeout):
                return True
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                return False
            raise
    from pyarrow import fs

    from ferry.sources.assets import file_system

    files, path = file_system(url)
    return files.get_file_info(path).type == fs.FileType.File


class JsonDailyReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.url, self.start = options["url"], dt.date.fromisoformat(options["start"])
        self.layout = options.get("layout", "array")
        if "{ds}" not in self.url:
            raise ValueError("url needs a {ds} for the day")
        self.known = 0

    def _day(self, n: int) -> _Day:
        ds = self.start + dt.timedelta(days=n)
        return _Day(ds, self.url.replace("{ds}", ds.isoformat()))

    def initialOffset(self) -> dict:
        return {"days": 0}

    def latestOffset(self) -> dict:
        # Days up to ``known`` were there before; after a restart they are
        # looked for again from the start, which asks once a day.
        n = self.known
        while is_there(self._day(n).url):
            n += 1
        self.known = n
        return {"days": n}

    def partitions(self, start: dict, end: dict) -> list[_Day]:
        return [self._day(n) for n in range(start["days"], end["days"])]

    def read(self, partition: _Day) -> Iterator[tuple]:
        import json

        reader = JsonHttpReader({"urls": json.dumps([partition.url]), "layout": self.layout})
        for n, record in enumerate(reader._records(partition.url)):
            yield partition.ds, n, record

    def commit(self, end: dict) -> None:
        """Nothing to release: payloads stay where they are."""


class JsonDailySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_daily"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return JsonDailyReader(self.options)


def read_json_daily(spark: SparkSession, url: str, start: str, schema: str,
                    layout: str = "array") -> DataFrame:
    """A stream of the days' records, typed by ``schema`` (FAILFAST), with the
    day (``ds``) and the record's position in its payload (``ordinal``)."""
    ship_package(spark)
    spark.dataSource.register(JsonDailySource)
    raw = (spark.readStream.format("json_daily").option("url", url).option("start", start)
           .option("layout", layout).load())
    return raw.select("ds", "ordinal", parse_strict("record", schema).alias("_r")).select(
        "ds", "ordinal", "_r.*")


def land_daily(spark: SparkSession, url: str, start: str, schema: str, out: str,
               layout: str = "array") -> DataFrame:
    """Land every day that has come since the last call; all landed rows."""
    rows = read_json_daily(spark, url, start, schema, layout)
    q = (rows.writeStream.format("parquet").option("path", f"{out}/rows")
         .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(rows.schema).parquet(f"{out}/rows")
