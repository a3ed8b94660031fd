"""Earliest failure with corrections: the last revision equals the batch form."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from ferry.operators.alerts import first_failures
from ferry.streaming.failure_state import latest_failures, run_failure_state
from ferry.streaming.first_failure import TASK_RUN_SCHEMA

DAY = dt.datetime(2024, 1, 1)


def runs(n=60, seed=0):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 6)  # one key holds a third
        ts = None if i % 23 == 0 else DAY + dt.timedelta(minutes=rnd.randrange(40))
        rows.append((i if i % 17 else None, ts, f"dag_{key}" if key < 5 else None, "t",
                     DAY.date() if key % 2 else None, "success" if i % 7 == 0 else "failed",
                     f"http://log/{i}"))
    return rows


def land(spark, rows, path, files):
    for k in range(files):
        (spark.createDataFrame(rows[k::files], TASK_RUN_SCHEMA).coalesce(1)
         .write.mode("append").parquet(path))


def table(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("files_per_batch,seed", [(1, 0), (3, 1)])
def test_last_revision_equals_the_batch_form(spark, tmp_dir, files_per_batch, seed):
    rows = runs(seed=seed)
    random.Random(seed).shuffle(rows)
    first, rest = rows[:40], rows[40:]
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    land(spark, first, src, 4)
    got = run_failure_state(spark, src, out, files_per_batch)
    want = first_failures(spark.createDataFrame(first, TASK_RUN_SCHEMA))
    assert table(latest_failures(got)) == table(want)
    land(spark, rest, src, 2)  # goes on from its checkpoint
    got = run_failure_state(spark, src, out, files_per_batch)
    want = first_failures(spark.createDataFrame(rows, TASK_RUN_SCHEMA))
    assert table(latest_failures(got)) == table(want)
    per_key = {}
    for r in got.collect():
        per_key.setdefault((r.dag_id, r.task_id, r.execution_date), []).append(r.revision)
    assert all(sorted(v) == list(range(len(v))) for v in per_key.values())
    assert max(map(len, per_key.values())) > 1


def test_no_failures(spark, tmp_dir):
    ok = [(1, DAY, "d", "t", DAY.date(), "success", "u")]
    land(spark, ok, f"{tmp_dir}/src", 1)
    got = run_failure_state(spark, f"{tmp_dir}/src", f"{tmp_dir}/out")
    assert latest_failures(got).collect() == []
