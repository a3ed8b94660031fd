"""Registered queries: each stages its fixture, then runs ferry operators.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the staged data (staging itself runs eagerly, once per application).
Column names match ``ferry.plans.oracle``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.json import json_lookup
from ferry.operators import alerts as A
from ferry.operators import assets as S
from ferry.operators import handoff as H
from ferry.operators import incremental as I
from ferry.operators import project as P
from ferry.operators import report as R
from ferry.operators.nested import text_leaves
from ferry.operators.ordinal import with_payload_ordinal
from ferry.plans import fixtures as fx
from ferry.session import scratch_path
from ferry.sinks.files import (document_lines, read_csv, read_csv_blocks, write_csv,
                               write_csv_file, write_lines, write_report_table)
from ferry.sinks.handover import write_column_json, write_column_text
from ferry.sinks.one_file import write_one_file
from ferry.sinks.tables import create_table, insert_select
from ferry.sources.assets import fetch_urls, with_image_sizes
from ferry.sources.footers import read_table_footers
from ferry.sources.footers import table_extent as footer_extent
from ferry.sources.handover import read_column_json, read_column_text
from ferry.sources.json_daily import land_daily
from ferry.sources.json_http import read_json_http
from ferry.sources.json_records import (payload_positions, read_documents, read_json_array,
                                        read_json_records, read_required, read_whole_documents)
from ferry.streaming.failure_state import latest_failures, run_failure_state
from ferry.streaming.first_failure import run_first_failure_batches

# Declared schemas of the staged payloads (no inference pass).
DAILY_SCHEMA = ("date INT, positive BIGINT, death BIGINT, hospitalizedCurrently BIGINT, "
                "states INT, hash STRING")
PHOTO_SCHEMA = ("albumId BIGINT, id BIGINT, title STRING, url STRING, thumbnailUrl STRING, "
                "content_type STRING")
USER_SCHEMA = ("_id STRING, username STRING, name STRING, email STRING, clase STRING, "
               "age INT, disabled BOOLEAN, load_datetime TIMESTAMP_NTZ")

DAILY_COLUMNS = ["date", "positive", "death", "hospitalizedCurrently"]
PHOTO_COLUMNS = ["id", "title", "url", "thumbnailUrl"]
USER_FIELDS = ["_id", "username", "name", "email", "clase", "age", "disabled"]


# ------------------------------------------------------------ daily API report

def daily_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_records(spark, fx.daily_metrics(spark, sf_dir), DAILY_SCHEMA)


def daily_table(df: DataFrame, sort: bool = True) -> DataFrame:
    """Project four columns, parse the date, sort by it (nulls last)."""
    t = df.transform(P.keep_columns, DAILY_COLUMNS).transform(P.parse_date_column, "date")
    return t.transform(P.sort_nulls_last, "date") if sort else t


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 P1 P2 X1 O1. A payload that lacks one of the columns fails."""
    return daily_table(read_required(spark, fx.daily_metrics(spark, sf_dir), DAILY_SCHEMA,
                                     DAILY_COLUMNS))


def daily_report_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the payload as the API returns it, one JSON
    array in one file, read in byte blocks by several tasks."""
    return daily_table(read_json_array(spark, fx.daily_metrics_array(spark, sf_dir),
                                       DAILY_SCHEMA))


def daily_report_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 (live): the same report, its payload fetched through the
    ``json_http`` data source -- one input partition per URL, fetched once on
    the executors and landed before the sort. URLs are the staged files here
    (no network), opened through their own file system."""
    urls = sorted(spark.read.text(fx.daily_metrics(spark, sf_dir)).inputFiles())
    return daily_table(read_json_http(spark, urls, DAILY_SCHEMA, layout="lines",
                                      required=DAILY_COLUMNS))


def daily_report_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 on its schedule: three daily payloads that come one after the other,
    each landed once by a stream that goes on from its checkpoint."""
    folder = scratch_path(spark, "daily-payloads")
    for k, ds in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        fx.day_payload(spark, sf_dir, k, f"{folder}/daily-{ds}.json")
        rows = land_daily(spark, f"{folder}/daily-{{ds}}.json", "2024-01-01", DAILY_SCHEMA,
                          f"{folder}/landed")
    return rows.transform(P.keep_columns, ["ds", *DAILY_COLUMNS])


def daily_report_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the four columns of the report on a sheet, written and read back."""
    t = daily_table(daily_records(spark, sf_dir), sort=False)
    return written_sheet(spark, R.sheet_rows(t, ["date"], DAILY_COLUMNS))


def written_sheet(spark: SparkSession, sheet: DataFrame) -> DataFrame:
    """Write a sheet table and read the written report back."""
    path = write_report_table(sheet, scratch_path(spark, "sheet"))
    return read_csv(spark, path, sheet.schema)


def daily_report_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rows in the report and the last sheet row (header is row 1)."""
    return daily_records(spark, sf_dir).transform(R.sheet_extent)


# ---------------------------------------------------------------------- photos

def photo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_json_records(spark, fx.photos(spark, sf_dir), PHOTO_SCHEMA)


def photos_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 P1."""
    return photo_records(spark, sf_dir).transform(P.keep_columns, PHOTO_COLUMNS)


# ----------------------------------------------------------------------- users

def user_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, fx.users(spark, sf_dir), USER_SCHEMA)


def users_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, seven fields, absent field -> NULL."""
    return user_documents(spark, sf_dir).transform(P.keep_columns, USER_FIELDS)


def daily_report_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns 2-4 of the sheet as three named series, x = row position."""
    # The series' own ordinal sorts by date; no separate sort first.
    t = daily_table(daily_records(spark, sf_dir), sort=False)
    return R.chart_series(t, ["date"], ["positive", "death", "hospitalizedCurrently"],
                          carry=["date"])


def photos_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photo records with their position in the payload (``ordinal``)."""
    return with_payload_ordinal(payload_positions(photo_records(spark, sf_dir)))


def photos_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, title`` on the sheet in payload order, image anchored
    in column D; written and read back."""
    return written_sheet(spark, R.placed(photos_in_order(spark, sf_dir), ["id", "title"], "D"))


def photos_assets_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The photo sheet with each row's fetched image: its
    status and size, the placeholder where it is none, and the anchor; written
    and read back. An image shared by many rows is fetched once."""
    rows = R.placed(photos_in_order(spark, sf_dir), ["id", "title"], "D")
    urls = photo_urls(spark, sf_dir)
    audit = S.audit_fetched(urls, fetch_urls(urls, "url", measure_image=True), "url")
    sheet = rows.join(audit, "id").select(
        "sheet_row", "id", "title", "status", "width", "height",
        (F.col("asset") != F.col("url")).alias("is_placeholder"), "anchor_cell")
    return written_sheet(spark, sheet)


def photo_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, url`` of every photo's image: the staged files here (no
    network); ``http(s)://`` URLs go the same way."""
    root = fx.images(spark, sf_dir)
    return spark.read.parquet(f"{root}/manifest").select(
        "id", F.concat(F.lit(f"{root}/files/"), F.col("name")).alias("url"))


def photos_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numeric ``id`` column as a chart series, x = payload position."""
    return R.series(photos_in_order(spark, sf_dir).select("id", "ordinal"), ["id"])


def asset_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thumbnail kept when its content type is ``image/...``."""
    return (photo_records(spark, sf_dir)
            .transform(S.choose_asset, "thumbnailUrl", "content_type")
            .select("id", "content_type", "is_image", "asset_url"))


def image_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landed image's size from its header, or a placeholder.
    The manifest names ``<id>.png`` for every photo; one of eight is not there."""
    root = fx.images(spark, sf_dir)
    manifest = spark.read.parquet(f"{root}/manifest").select(
        "id", F.concat(F.col("id").cast("string"), F.lit(".png")).alias("name"))
    sizes = with_image_sizes(manifest, F.concat(F.lit(f"{root}/files/"), F.col("name")))
    audit = S.audit_images(sizes, ["id", "name"], "name")
    return audit.select("id", "status", "width", "height",
                        (F.col("asset") != F.col("name")).alias("is_placeholder"))


def asset_fetch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 (live) F3 F4 J2: fetch each photo's URL on the executors, check
    content type and bytes, placeholder otherwise."""
    rows = photo_urls(spark, sf_dir)
    audit = S.audit_fetched(rows, fetch_urls(rows, "url", measure_image=True), "url")
    return audit.select("id", "status", "width", "height",
                        (F.col("asset") != F.col("url")).alias("is_placeholder"))


def interchange_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photos -> column-oriented hand-over chunks -> rows again."""
    photos = photos_projection(spark, sf_dir)
    path = write_column_json(photos, scratch_path(spark, "handover"), ["id"], chunk_rows=1000)
    return read_column_json(spark, path, "id BIGINT, title STRING, url STRING, thumbnailUrl STRING")


def interchange_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same hand-over as the reference makes it, one column-oriented
    text for the whole table in one file, written and read by many tasks."""
    photos = photos_projection(spark, sf_dir)
    path = write_column_text(photos, f"{scratch_path(spark, 'handover-text')}/photos.json", ["id"])
    return read_column_text(spark, path,
                            "id BIGINT, title STRING, url STRING, thumbnailUrl STRING")


# ------------------------------------------------------------------ nested docs

def sprite_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL leaves under ``sprites``, document order."""
    docs = spark.read.parquet(fx.asset_trees(spark, sf_dir))
    return text_leaves(docs, "doc_id", "doc", root="$.sprites", prefix="http",
                       key_name="sprite_name", value_name="sprite_url")


def sprite_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document sheet, names in column A, image anchored in B."""
    leaves = sprite_urls(spark, sf_dir)
    row = (F.col("leaf_pos") + R.FIRST_DATA_ROW)
    return leaves.select("doc_id", row.alias("sheet_row"), "sprite_name",
                         F.concat(F.lit("B"), row.cast("string")).alias("anchor_cell"))


def sprite_assets_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nested document fetched from its URL, its URL
    leaves fetched in turn and checked, the placeholder where one is no image;
    a sheet per document, written and read back. The URLs are staged files here
    (no network); ``http(s)://`` ones go the same way."""
    manifest = spark.read.parquet(f"{fx.sprite_documents(spark, sf_dir)}/manifest")
    bodies = fetch_urls(manifest, "url").select("url", F.col("content").cast("string").alias("doc"))
    docs = manifest.join(bodies, "url").select("doc_id", "doc")
    leaves = text_leaves(docs, "doc_id", "doc", root="$.sprites",
                         prefix=f"{fx.images(spark, sf_dir)}/files", key_name="sprite_name",
                         value_name="url")
    audit = S.audit_fetched(leaves, fetch_urls(leaves, "url", measure_image=True), "url")
    row = F.col("leaf_pos") + R.FIRST_DATA_ROW
    return written_sheet(spark, audit.select(
        "doc_id", row.alias("sheet_row"), "sprite_name", "status", "width", "height",
        (F.col("asset") != F.col("url")).alias("is_placeholder"),
        F.concat(F.lit("B"), row.cast("string")).alias("anchor_cell")))


# ----------------------------------------------------------------- SQL sources

def table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: ``SELECT *`` of a SQL table; splits follow its size."""
    return spark.sql("SELECT * FROM {experiments}", experiments=spark.read.parquet(
        f"{fx.sql_tables(spark, sf_dir)}/EXPERIMENTS"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 K2: table -> CSV (header, no index) -> read back with its schema."""
    part = fx.table(spark, sf_dir, "part")
    path = write_csv(part, scratch_path(spark, "csv"))
    return read_csv(spark, path, part.schema)


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 K2 over free text: padded, quoted, multi-line and null cells."""
    odd_docs = odd_documents(spark, sf_dir)
    path = write_csv(odd_docs, scratch_path(spark, "csv"))
    return read_csv(spark, path, odd_docs.schema)


def odd_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text with padded, quoted, multi-line and null cells."""
    d = fx.table(spark, sf_dir, "documents")
    k, text = F.col("doc_id") % 5, F.col("text")
    return d.withColumn("text", (
        F.when(k == 0, F.concat(F.lit("  "), text, F.lit("\t")))
        .when(k == 1, F.concat(F.lit('"'), text, F.lit('", x')))
        .when(k == 2, F.lit(None)).otherwise(text)))


def csv_documents_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 K2: the same rows as one CSV object, written by many tasks at their
    offsets, and read back in byte blocks by many tasks."""
    docs = odd_documents(spark, sf_dir)
    path = write_csv_file(docs, f"{scratch_path(spark, 'csv-object')}/documents.csv", ["doc_id"])
    return read_csv_blocks(spark, path, docs.schema)


def insert_select_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``INSERT INTO target SELECT coordenadas ... LIMIT 1``. The
    catalog entry goes again; what is returned reads the table's files."""
    src = spark.read.parquet(fx.trajectories(spark, sf_dir))
    target = f"ferry_insert_{uuid.uuid4().hex[:8]}"
    location = scratch_path(spark, "target")
    create_table(spark, target, "coordenadas ARRAY<FLOAT>", location)
    try:
        insert_select(spark, target, src, ["coordenadas"], order_by=["vec_id"], limit=1)
        schema = spark.table(target).schema
    finally:
        spark.sql(f"DROP TABLE {target}")  # external: the files stay
    return spark.read.schema(schema).parquet(location)


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: ``max(load_datetime)`` of a SQL table."""
    users = spark.read.parquet(f"{fx.sql_tables(spark, sf_dir)}/USERS")
    return H.high_water_mark(users, "load_datetime")


def table_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: rows of a table and those with a key, from its file footers."""
    table = read_table_footers(spark, f"{fx.sql_tables(spark, sf_dir)}/EXPERIMENTS")
    return footer_extent(table, "p_partkey")


def high_water_mark_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark, handed to the next step as a scalar subquery."""
    users = user_documents(spark, sf_dir).select("_id", "load_datetime")
    tagged = H.with_high_water_mark(users, "load_datetime")
    return tagged.withColumn(
        "minutes_behind",
        F.timestamp_diff("MINUTE", F.col("load_datetime"), F.col("high_water_mark")))


def run_date_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User SQL with bound run parameters."""
    sql = ("SELECT o_orderkey, CAST(:ds AS DATE) AS run_date, :bucket AS bucket, "
           ":version AS version, datediff(CAST(:ds AS DATE), o_orderdate) AS days_before_run "
           "FROM {orders}")
    return H.with_parameters(spark, sql, RUN_PARAMETERS, orders=fx.table(spark, sf_dir, "orders"))


# The sample run parameters (FIXTURES.md "parameters").
RUN_PARAMETERS = {"ds": "2024-01-10", "bucket": "bucket", "version": 2}


# ------------------------------------------------------------------- users, HTML

def users_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as one JSON line each, explicit nulls and
    undeclared fields included; read back and fields taken out to check it."""
    docs = read_whole_documents(spark, fx.users(spark, sf_dir))
    path = write_lines(document_lines(docs), scratch_path(spark, "lines"))
    line = F.col("value")
    return spark.read.text(path).select(
        json_lookup(line, "$._id").alias("_id"),
        F.size(F.json_object_keys(line)).alias("n_fields"),
        json_lookup(line, "$.age").alias("age_text"),
        json_lookup(line, "$.disabled").alias("disabled_text"),
        F.coalesce(F.is_variant_null(F.try_variant_get(F.parse_json(line), "$.disabled",
                                                       "variant")), F.lit(False))
        .alias("disabled_is_null"),
        json_lookup(line, "$.tag").alias("undeclared"))


def users_html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: one HTML table row per document, Python-style values."""
    return user_documents(spark, sf_dir).transform(R.html_row, USER_FIELDS, keep=["_id"])


# The column headings of the user table in the report.
USER_HEADINGS = ["ID", "Username", "Name", "Email", "Clase", "Age", "Disabled"]
USERS_DOC_HEAD = ("<html><body><h3>User documents</h3><table border=\"1\"><thead><tr>"
                  + "".join(f"<th>{h}</th>" for h in USER_HEADINGS)
                  + "</tr></thead><tbody>")
USERS_DOC_TAIL = "</tbody></table></body></html>"
USERS_PAGE_ROWS = 100


def users_html_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: one document, rendered rows in ``_id`` order, in pages of 100."""
    rows = users_html_rows(spark, sf_dir)
    return R.html_pages(rows, ["_id"], USERS_PAGE_ROWS, USERS_DOC_HEAD, USERS_DOC_TAIL)


def users_html_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: the one HTML document as one object under its name, written by many
    tasks; read back by many, cut behind each table row."""
    rows = users_html_rows(spark, sf_dir)
    path = write_one_file(rows, "row_html", ["_id"],
                          f"{scratch_path(spark, 'html')}/users.html", USERS_DOC_HEAD,
                          USERS_DOC_TAIL)
    return spark.read.option("lineSep", "</tr>").text(path).withColumnRenamed("value", "piece")


# --------------------------------------------------------- incremental extract

def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a table that grows between them, each extracting
    what is newer than the committed mark; the rows with the run that took
    them."""
    folder = scratch_path(spark, "extract")
    for path in fx.growing_users(spark, sf_dir):
        users = spark.read.parquet(path)
        I.extract_new(users, "load_hour", folder)
    return I.extracted(spark, folder, users.schema)


# -------------------------------------------------------------- failure notices

def task_run_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(fx.task_runs(spark, sf_dir))


def failure_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A notice for every failed run."""
    return A.failure_notices(task_run_table(spark, sf_dir), style="plain")


def failure_alerts_exception(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout that reports the exception text."""
    return A.failure_notices(task_run_table(spark, sf_dir), style="exception")


def first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A notice only for the first failure of each task and date."""
    return A.first_failures(task_run_table(spark, sf_dir), style="styled")


def first_failure_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stream of landed run files, one notice per key ever,
    for any landing order and batch size."""
    src = fx.task_run_files(spark, sf_dir)
    out = run_first_failure_batches(spark, src, scratch_path(spark, "notices"))
    return out.select("dag_id", "task_id", "execution_date", "subject")


def first_failure_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earliest failure of each task and date on a stream, with
    its log link, corrected when an earlier run lands later."""
    revisions = run_failure_state(spark, fx.task_run_files(spark, sf_dir),
                                  scratch_path(spark, "failure-state"), files_per_batch=2)
    return latest_failures(revisions)


QUERIES = {
    "daily_report": daily_report,
    "daily_report_array": daily_report_array,
    "daily_report_http": daily_report_http,
    "daily_report_days": daily_report_days,
    "daily_report_series": daily_report_series,
    "daily_report_sheet": daily_report_sheet,
    "daily_report_rowcount": daily_report_rowcount,
    "photos_projection": photos_projection,
    "photos_sheet": photos_sheet,
    "photos_series": photos_series,
    "photos_assets_sheet": photos_assets_sheet,
    "asset_status": asset_status,
    "image_audit": image_audit,
    "asset_fetch_audit": asset_fetch_audit,
    "sprite_urls": sprite_urls,
    "sprite_sheet": sprite_sheet,
    "sprite_assets_sheet": sprite_assets_sheet,
    "table_extract": table_extract,
    "csv_roundtrip": csv_roundtrip,
    "csv_documents": csv_documents,
    "csv_documents_file": csv_documents_file,
    "insert_select_limit": insert_select_limit,
    "high_water_mark": high_water_mark,
    "table_extent": table_extent,
    "high_water_mark_handoff": high_water_mark_handoff,
    "incremental_extract": incremental_extract,
    "users_documents": users_documents,
    "users_json_rows": users_json_rows,
    "users_html_rows": users_html_rows,
    "users_html_doc": users_html_doc,
    "users_html_file": users_html_file,
    "interchange_roundtrip": interchange_roundtrip,
    "interchange_text": interchange_text,
    "failure_alerts": failure_alerts,
    "failure_alerts_exception": failure_alerts_exception,
    "first_failure": first_failure,
    "first_failure_stream": first_failure_stream,
    "first_failure_state": first_failure_state,
    "run_date_tag": run_date_tag,
}
