"""Oracle SQL (DuckDB dialect) for every registered query.

DuckDB sees only the driver tables, so each fixture of ``FIXTURES.md`` is
re-derived here as a CTE from those tables -- written independently of the
Spark staging code in ``ferry.plans.fixtures``. Output column names and
types match the Spark queries.
"""

from __future__ import annotations

from ferry.operators.alerts import LAYOUTS, LINKS, SUBJECTS

# ----------------------------------------------------------------- fixture CTEs

DAILY_METRICS = """
daily_metrics AS (
  SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date,
         positive,
         NULLIF(n_f, 0) AS death,
         CASE WHEN day >= DATE '1996-01-01' THEN n_o END AS hospitalizedCurrently,
         56 AS states, 'c0ffee' AS hash
  FROM (SELECT CAST(o_orderdate AS DATE) AS day,
               COUNT(*) AS positive,
               COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
               COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_o
        FROM orders GROUP BY 1) g
)"""

PHOTOS = """
photos AS (
  SELECT page_id % 10 AS albumId,
         page_id AS id,
         url AS title,
         url,
         url || '/thumb' AS thumbnailUrl,
         CASE page_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg'
              WHEN 2 THEN 'text/html' WHEN 4 THEN 'IMAGE/PNG' END AS content_type
  FROM pages
)"""

USERS = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS _id,
         lower(c_name) AS username,
         c_name || CASE WHEN c_custkey % 11 = 0 THEN ' <b>&' ELSE '' END AS name,
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         c_mktsegment AS clase,
         CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 80 AS INTEGER) END AS age,
         CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal < 0 END AS disabled,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS load_datetime
  FROM customer
)"""

TASK_RUNS = """
task_runs AS (
  SELECT event_id AS run_id,
         ts,
         'dag_' || CAST(user_id % 20 AS VARCHAR) AS dag_id,
         'task_' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR) AS task_id,
         CAST(ts AS DATE) AS execution_date,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state,
         'http://logs.example.com/' || CAST(event_id AS VARCHAR) AS log_url,
         CASE WHEN event_type = 'error' AND event_id % 9 <> 0
              THEN 'ValueError: bad value ' || CAST(event_id % 100 AS VARCHAR) END AS exception
  FROM events
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# --------------------------------------------------------------------- queries

ORACLE: dict[str, str] = {}

ORACLE["daily_report"] = _with(DAILY_METRICS) + """
SELECT strptime(CAST(date AS VARCHAR), '%Y%m%d') AS date,
       positive, death, hospitalizedCurrently
FROM daily_metrics
ORDER BY date NULLS LAST"""

ORACLE["daily_report_http"] = ORACLE["daily_report"]

ORACLE["daily_report_days"] = _with(DAILY_METRICS) + """
SELECT DATE '2024-01-01' + CAST(date % 3 AS INTEGER) AS ds, date, positive, death,
       hospitalizedCurrently
FROM daily_metrics"""

ORACLE["daily_report_array"] = ORACLE["daily_report"]

ORACLE["daily_report_rowcount"] = _with(DAILY_METRICS) + """
SELECT COUNT(*) AS n_rows, COUNT(*) + 1 AS last_sheet_row FROM daily_metrics"""

ORACLE["photos_projection"] = _with(PHOTOS) + """
SELECT id, title, url, thumbnailUrl FROM photos"""

ORACLE["users_documents"] = _with(USERS) + """
SELECT _id, username, name, email, clase, age, disabled FROM users"""

# Asset documents: the same tree rules as the Spark staging, as SQL text.
ASSET_TREES = r"""
asset_trees AS (
  SELECT doc_id,
         CASE WHEN doc_id % 10 = 0 THEN
           '{"name":"' || name || '","sprites":{"back_female":null,"order":' || k
           || ',"list":["' || b || '/l"],"trap":"{\"u\": \"' || b || '/t\"}","empty":{},'
           || '"other":{"upper":"HTTP://IMG.EXAMPLE.COM/' || k || '/U"}}}'
         ELSE
           '{"name":"' || name || '","sprites":{"front_default":"' || b || '/f",'
           || '"back_female":null,'
           || '"other":{"dream-world":{"front_default":"' || b || '/d"},'
           || '"official-artwork":{"front_default":"https://img.example.com/' || k || '/o"},'
           || '"upper":"HTTP://IMG.EXAMPLE.COM/' || k || '/U"},'
           || '"versions":{"generation-i":{"red":{"front_gray":"' || b || '/g"}}},'
           || '"back_default":"' || b || '/b","order":' || k
           || ',"list":["' || b || '/l"],"trap":"{\"u\": \"' || b || '/t\"}","empty":{}}}'
         END AS doc
  FROM (SELECT s_suppkey AS doc_id, s_name AS name, CAST(s_suppkey AS VARCHAR) AS k,
               'http://img.example.com/' || CAST(s_suppkey AS VARCHAR) AS b
        FROM supplier) s
)"""

# Leaves by DuckDB's own JSON walker: text nodes starting with 'http',
# not under an array, numbered in document order.
SPRITE_LEAVES = """
sprite_leaves AS (
  SELECT doc_id,
         row_number() OVER (PARTITION BY doc_id ORDER BY node) - 1 AS leaf_pos,
         sprite_name, sprite_url
  FROM (SELECT a.doc_id, j.id AS node, j.key AS sprite_name, j.type AS jtype,
               j.fullkey AS fullkey, j.value ->> '$' AS sprite_url
        FROM asset_trees a, json_tree(a.doc, '$.sprites') j) t
  WHERE jtype = 'VARCHAR' AND starts_with(sprite_url, 'http') AND strpos(fullkey, '[') = 0
)"""

PY_ROW_HTML = """'<tr><td>' || coalesce(_id, 'None') || '</td><td>' || coalesce(username, 'None')
  || '</td><td>' || coalesce(name, 'None') || '</td><td>' || coalesce(email, 'None')
  || '</td><td>' || coalesce(clase, 'None') || '</td><td>' || coalesce(CAST(age AS VARCHAR), 'None')
  || '</td><td>' || CASE WHEN disabled IS NULL THEN 'None' WHEN disabled THEN 'True' ELSE 'False' END
  || '</td></tr>'"""

RECIPIENTS = "'ops@example.com, oncall@example.com'"


def _notice(style: str) -> str:
    """Subject and body of a layout as SQL, from the same field lists."""
    text, slots = SUBJECTS[style]
    heading, fields = LAYOUTS[style]
    as_text = {f: f"coalesce(CAST({f} AS VARCHAR), '')" for f in fields}
    rows = " || ".join(
        f"""'<tr><th scope="row">{f}</th><td>'""" + (
            f""" || '<a href="' || {as_text[f]} || '">' || {as_text[f]} || '</a>'"""
            if f in LINKS else f" || {as_text[f]}") + " || '</td></tr>'"
        for f in fields)
    return f"""printf('{text}', {', '.join(slots)}) AS subject,
       '<table class="notice notice-{style}"><caption>{heading}</caption>' || {rows} || '</table>'
       AS body, {RECIPIENTS} AS recipients"""


ORACLE["daily_report_series"] = _with(DAILY_METRICS, """
p AS (SELECT row_number() OVER (ORDER BY d) - 1 AS ordinal, d AS date,
             positive, death, hospitalizedCurrently
      FROM (SELECT strptime(CAST(date AS VARCHAR), '%Y%m%d') AS d, * FROM daily_metrics) x)""") + """
SELECT ordinal, date, 'positive' AS series, positive AS value FROM p
UNION ALL SELECT ordinal, date, 'death', death FROM p
UNION ALL SELECT ordinal, date, 'hospitalizedCurrently', hospitalizedCurrently FROM p"""

# Position in the payload, whose ids do not ascend (see the photos fixture).
PAYLOAD = "row_number() OVER (ORDER BY (id * 7919) % 10007, id)"

ORACLE["photos_sheet"] = _with(PHOTOS) + f"""
SELECT {PAYLOAD} + 1 AS sheet_row, id, title,
       'D' || CAST({PAYLOAD} + 1 AS VARCHAR) AS anchor_cell
FROM photos"""

ORACLE["photos_series"] = _with(PHOTOS) + f"""
SELECT {PAYLOAD} - 1 AS ordinal, 'id' AS series, id AS value FROM photos"""

# What fetching a photo's image gives, by page_id % 8: five of eight decode,
# one is a text file named .png, one is empty, one is an HTML page.
PHOTO_STATUS = """CASE WHEN id % 8 < 5 THEN 'ok' WHEN id % 8 = 7 THEN 'not_image'
              ELSE 'unidentified' END"""

ORACLE["photos_assets_sheet"] = _with(PHOTOS) + f"""
SELECT sheet_row, id, title, status,
       CASE WHEN status = 'ok' THEN CAST(1 + id % 7 AS INTEGER) END AS width,
       CASE WHEN status = 'ok' THEN CAST(1 + id % 5 AS INTEGER) END AS height,
       status <> 'ok' AS is_placeholder, 'D' || CAST(sheet_row AS VARCHAR) AS anchor_cell
FROM (SELECT {PAYLOAD} + 1 AS sheet_row, id, title, {PHOTO_STATUS} AS status FROM photos) p"""

ORACLE["daily_report_sheet"] = _with(DAILY_METRICS) + """
SELECT row_number() OVER (ORDER BY d) + 1 AS sheet_row, d AS date,
       positive, death, hospitalizedCurrently
FROM (SELECT strptime(CAST(date AS VARCHAR), '%Y%m%d') AS d, * EXCLUDE (date) FROM daily_metrics) x"""

ORACLE["asset_status"] = _with(PHOTOS) + """
SELECT id, content_type,
       starts_with(coalesce(content_type, ''), 'image/') AS is_image,
       CASE WHEN starts_with(coalesce(content_type, ''), 'image/') THEN thumbnailUrl
            ELSE 'https://placeholder.example.com/150.png' END AS asset_url
FROM photos"""

# Landed files: the one empty file is there and cannot be identified.
ORACLE["image_audit"] = """
SELECT page_id AS id,
       CASE WHEN page_id % 8 = 7 THEN 'missing' WHEN page_id % 8 IN (5, 6) THEN 'unidentified'
            ELSE 'ok' END AS status,
       CASE WHEN page_id % 8 < 5 THEN CAST(1 + page_id % 7 AS INTEGER) END AS width,
       CASE WHEN page_id % 8 < 5 THEN CAST(1 + page_id % 5 AS INTEGER) END AS height,
       page_id % 8 >= 5 AS is_placeholder
FROM pages"""

ORACLE["asset_fetch_audit"] = _with(PHOTOS) + f"""
SELECT id, status, CASE WHEN status = 'ok' THEN CAST(1 + id % 7 AS INTEGER) END AS width,
       CASE WHEN status = 'ok' THEN CAST(1 + id % 5 AS INTEGER) END AS height,
       status <> 'ok' AS is_placeholder
FROM (SELECT id, {PHOTO_STATUS} AS status FROM photos) p"""

ORACLE["sprite_urls"] = _with(ASSET_TREES, SPRITE_LEAVES) + """
SELECT doc_id, leaf_pos, sprite_name, sprite_url FROM sprite_leaves"""

ORACLE["sprite_sheet"] = _with(ASSET_TREES, SPRITE_LEAVES) + """
SELECT doc_id, leaf_pos + 2 AS sheet_row, sprite_name,
       'B' || CAST(leaf_pos + 2 AS VARCHAR) AS anchor_cell
FROM sprite_leaves"""

ORACLE["sprite_assets_sheet"] = f"""
SELECT doc_id, sheet_row, sprite_name, status,
       CASE WHEN status = 'ok' THEN CAST(1 + id % 7 AS INTEGER) END AS width,
       CASE WHEN status = 'ok' THEN CAST(1 + id % 5 AS INTEGER) END AS height,
       status <> 'ok' AS is_placeholder, 'B' || CAST(sheet_row AS VARCHAR) AS anchor_cell
FROM (SELECT *, {PHOTO_STATUS} AS status
      FROM (SELECT s_suppkey AS doc_id, i + 2 AS sheet_row, sprite_name,
                   (s_suppkey * 4 + i) % (SELECT count(*) FROM pages) AS id
            FROM supplier, (VALUES (CAST(0 AS BIGINT), 'front_default'), (1, 'front_default'),
                                   (2, 'front_gray'), (3, 'back_default')) l(i, sprite_name)
            WHERE s_suppkey % 10 <> 0) s) t"""

ORACLE["table_extract"] = "SELECT * FROM part"

ORACLE["csv_roundtrip"] = "SELECT * FROM part"

ORACLE["csv_documents"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '  ' || text || '	' WHEN 1 THEN '"' || text || '", x'
       WHEN 2 THEN NULL ELSE text END AS text, lang, source, n_chars
FROM documents"""

ORACLE["csv_documents_file"] = ORACLE["csv_documents"]

ORACLE["insert_select_limit"] = """
SELECT embedding AS coordenadas FROM embeddings ORDER BY vec_id LIMIT 1"""

ORACLE["table_extent"] = """
SELECT count(*) AS n_rows, count(p_partkey) AS n_values FROM part"""

ORACLE["high_water_mark"] = _with(USERS) + """
SELECT max(load_datetime) AS high_water_mark FROM users"""

ORACLE["high_water_mark_handoff"] = _with(USERS) + """
SELECT _id, load_datetime,
       (SELECT max(load_datetime) FROM users) AS high_water_mark,
       date_diff('minute', load_datetime, (SELECT max(load_datetime) FROM users)) AS minutes_behind
FROM users"""

# The table held the first third, two thirds and all of the keys by then.
ORACLE["incremental_extract"] = _with(USERS) + """
SELECT _id, username, date_trunc('hour', load_datetime) AS load_hour,
       CASE WHEN CAST(_id AS BIGINT) * 3 <= last THEN 1
            WHEN CAST(_id AS BIGINT) * 3 <= 2 * last THEN 2 ELSE 3 END AS run
FROM users, (SELECT max(c_custkey) AS last FROM customer) m"""

ORACLE["run_date_tag"] = """
SELECT o_orderkey, DATE '2024-01-10' AS run_date, 'bucket' AS bucket, 2 AS version,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-01-10') AS INTEGER)
         AS days_before_run
FROM orders"""

ORACLE["users_json_rows"] = _with(USERS) + """
SELECT _id,
       9 - CAST(age IS NULL AS INTEGER) AS n_fields,
       CAST(age AS VARCHAR) AS age_text,
       CASE WHEN disabled THEN 'true' WHEN NOT disabled THEN 'false' END AS disabled_text,
       disabled IS NULL AS disabled_is_null,
       'tag ' || _id || ' "x"' AS undeclared
FROM users"""

ORACLE["users_html_rows"] = _with(USERS) + f"""
SELECT _id, {PY_ROW_HTML} AS row_html FROM users"""


def _users_html_doc() -> str:
    from ferry.plans.queries import USERS_DOC_HEAD, USERS_DOC_TAIL, USERS_PAGE_ROWS
    head = USERS_DOC_HEAD.replace("'", "''")
    tail = USERS_DOC_TAIL.replace("'", "''")
    return _with(USERS, f"""
r AS (SELECT {PY_ROW_HTML} AS row_html, row_number() OVER (ORDER BY _id) - 1 AS ordinal,
             COUNT(*) OVER () AS n FROM users)""") + f"""
SELECT ordinal // {USERS_PAGE_ROWS} AS page_no, COUNT(*) AS n_rows,
       CASE WHEN ordinal // {USERS_PAGE_ROWS} = 0 THEN '{head}' ELSE '' END
       || string_agg(row_html, '' ORDER BY ordinal)
       || CASE WHEN ordinal // {USERS_PAGE_ROWS} = (any_value(n) - 1) // {USERS_PAGE_ROWS}
          THEN '{tail}' ELSE '' END AS html
FROM r GROUP BY ordinal // {USERS_PAGE_ROWS}"""


ORACLE["users_html_doc"] = _users_html_doc()


def _users_html_file() -> str:
    from ferry.plans.queries import USERS_DOC_HEAD, USERS_DOC_TAIL
    head = USERS_DOC_HEAD.replace("'", "''")
    tail = USERS_DOC_TAIL.replace("'", "''")
    return _with(USERS, f"r AS (SELECT _id, {PY_ROW_HTML} AS row_html FROM users)") + f"""
SELECT unnest(string_split('{head}' || string_agg(row_html, '' ORDER BY _id) || '{tail}', '</tr>'))
       AS piece FROM r"""


ORACLE["users_html_file"] = _users_html_file()

ORACLE["interchange_roundtrip"] = _with(PHOTOS) + """
SELECT row_number() OVER (ORDER BY id) - 1 AS row_label, id, title, url, thumbnailUrl
FROM photos"""

ORACLE["interchange_text"] = ORACLE["interchange_roundtrip"]

ORACLE["failure_alerts"] = _with(TASK_RUNS) + f"""
SELECT run_id, dag_id, task_id, execution_date, {_notice("plain")}
FROM task_runs WHERE state = 'failed'"""

ORACLE["failure_alerts_exception"] = _with(TASK_RUNS) + f"""
SELECT run_id, dag_id, task_id, execution_date, {_notice("exception")}
FROM task_runs WHERE state = 'failed'"""

ORACLE["first_failure"] = _with(TASK_RUNS) + f"""
SELECT run_id, dag_id, task_id, execution_date, ts AS first_ts, n_failures, {_notice("styled")}
FROM (SELECT *,
             row_number() OVER (PARTITION BY dag_id, task_id, execution_date
                                ORDER BY ts, run_id) AS rn,
             COUNT(*) OVER (PARTITION BY dag_id, task_id, execution_date) AS n_failures
      FROM task_runs WHERE state = 'failed') f
WHERE rn = 1"""

ORACLE["first_failure_state"] = ORACLE["first_failure"]

ORACLE["first_failure_stream"] = _with(TASK_RUNS) + """
SELECT DISTINCT dag_id, task_id, execution_date,
       printf('Fallo en DAG: %s, Task: %s', dag_id, task_id) AS subject
FROM task_runs WHERE state = 'failed'"""
