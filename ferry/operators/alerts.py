"""Failure notices from task runs.

The reference sends one message per failed task from a callback. Here the
runs are a table (or a stream, see ``ferry.streaming.first_failure``) and
the notices are a table: subject, HTML body, recipients. Delivery is out
of scope.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.functions.text import join_list

# The subject lines of the failure notices (formats of the
# reference), with the columns that fill them.
SUBJECTS = {
    "plain": ("Fallo en DAG: %s, Task: %s", ("dag_id", "task_id")),
    "styled": ("Fallo en DAG: %s, Task: %s", ("dag_id", "task_id")),
    "exception": ("Task %s in DAG %s Failed", ("task_id", "dag_id")),
}

NOTICE_KEYS = ("dag_id", "task_id", "execution_date")

# What each layout reports: a heading, the columns listed (one table row
# each), and the columns whose values are links.
LAYOUTS = {
    "plain": ("Failed run", ("run_id", "dag_id", "task_id", "execution_date", "log_url")),
    "styled": ("First failure of the day", ("execution_date", "dag_id", "task_id", "run_id",
                                            "log_url")),
    "exception": ("Failed run and its exception", ("task_id", "dag_id", "run_id", "exception",
                                                   "log_url")),
}
LINKS = ("log_url",)


def layout_template(style: str) -> str:
    """The HTML of a layout with ``{column}`` slots: a key/value table."""
    heading, fields = LAYOUTS[style]
    cell = {f: f'<a href="{{{f}}}">{{{f}}}</a>' if f in LINKS else f"{{{f}}}" for f in fields}
    rows = "".join(f'<tr><th scope="row">{f}</th><td>{cell[f]}</td></tr>' for f in fields)
    return f'<table class="notice notice-{style}"><caption>{heading}</caption>{rows}</table>'


DEFAULT_RECIPIENTS = ("ops@example.com", "oncall@example.com")


def render_template(template: str) -> Column:
    """``'<p>{col}</p>'`` -> ``concat('<p>', col, '</p>')``.

    Placeholders name columns; a NULL value prints as empty text.
    """
    parts = re.split(r"\{(\w+)\}", template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2:
            cols.append(F.coalesce(F.col(p).cast("string"), F.lit("")))
        elif p:
            cols.append(F.lit(p))
    return F.concat(*cols)


def failed_runs(runs: DataFrame) -> DataFrame:
    """Runs that failed (F6): the callback fires only for these."""
    return runs.where(F.col("state") == F.lit("failed"))


def notice_columns(style: str = "plain",
                   recipients: Sequence[str] = DEFAULT_RECIPIENTS) -> list[Column]:
    text, slots = SUBJECTS[style]
    return [
        F.format_string(text, *map(F.col, slots)).alias("subject"),
        render_template(layout_template(style)).alias("body"),
        join_list(list(recipients)).alias("recipients"),
    ]


def failure_notices(runs: DataFrame, style: str = "plain",
                    recipients: Sequence[str] = DEFAULT_RECIPIENTS) -> DataFrame:
    """One notice per failed run (R1). Narrow: no shuffle."""
    return failed_runs(runs).select(
        "run_id", *NOTICE_KEYS, *notice_columns(style, recipients))


def first_failures(runs: DataFrame, keys: Sequence[str] = NOTICE_KEYS,
                   style: str = "styled",
                   recipients: Sequence[str] = DEFAULT_RECIPIENTS) -> DataFrame:
    """Only the first failure per key gives a notice.

    "First" is the earliest ``ts`` (ties by ``run_id``). This is a
    ``min(struct(ts, run_id, ...))`` aggregate rather than a window: the
    hash aggregate combines partial minima on the map side, so a key that
    holds a third of all failures is reduced before the shuffle instead of
    being sorted in one task.
    """
    first = F.min(F.struct("ts", "run_id", "log_url")).alias("_first")
    agg = (failed_runs(runs).groupBy(*keys)
           .agg(first, F.count(F.lit(1)).alias("n_failures")))
    flat = agg.select(*keys, "n_failures",
                      F.col("_first.ts").alias("first_ts"),
                      F.col("_first.run_id").alias("run_id"),
                      F.col("_first.log_url").alias("log_url"))
    return flat.select("run_id", *keys, "first_ts", "n_failures",
                       *notice_columns(style, recipients))
