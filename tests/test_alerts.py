"""Failure notices: batch first-failure, stream first-failure, templates."""

from __future__ import annotations

import datetime as dt

import pytest

from ferry.operators.alerts import failure_notices, first_failures, render_template
from ferry.session import scratch_path
from ferry.streaming.first_failure import TASK_RUN_SCHEMA, run_first_failure_batches

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
D0 = T0.date()


def runs(spark, rows):
    return spark.createDataFrame(rows, TASK_RUN_SCHEMA)


def _r(run_id, minutes, state="failed", task="t1", day=D0):
    return (run_id, T0 + dt.timedelta(minutes=minutes), "dag_a", task, day, state,
            f"http://logs.example.com/{run_id}")


def test_only_failed_runs_give_notices(spark):
    df = runs(spark, [_r(1, 0), _r(2, 1, state="success")])
    out = failure_notices(df).collect()
    assert [r.run_id for r in out] == [1]
    assert out[0].subject == "Fallo en DAG: dag_a, Task: t1"
    assert out[0].recipients == "ops@example.com, oncall@example.com"
    assert 'href="http://logs.example.com/1"' in out[0].body
    assert "2024-01-01" in out[0].body


def test_first_failure_earliest_then_lowest_id(spark):
    df = runs(spark, [_r(5, 3), _r(4, 1), _r(3, 1), _r(9, 0, task="t2"), _r(8, 0, state="success")])
    out = {r.task_id: (r.run_id, r.n_failures) for r in first_failures(df).collect()}
    assert out == {"t1": (3, 3), "t2": (9, 1)}


def test_first_failure_hot_key(spark):
    rows = [_r(i, i % 97) for i in range(3000)] + [_r(10_000 + i, 5, task=f"k{i}") for i in range(20)]
    out = {r.task_id: r.run_id for r in first_failures(runs(spark, rows)).collect()}
    assert out["t1"] == 0 and len(out) == 21


def test_render_template_null_is_empty(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(render_template("<{x}|{y}>").alias("o")).first().o == "<a|>"


def test_notices_run_unchanged_on_a_stream(spark):
    src = scratch_path(spark, "test-stream-plain")
    runs(spark, [_r(1, 0), _r(2, 1, state="success"), _r(3, 2)]).write.parquet(src)
    stream = spark.readStream.schema(TASK_RUN_SCHEMA).parquet(src)
    out = scratch_path(spark, "test-stream-plain-out")
    q = (failure_notices(stream).writeStream.format("parquet")
         .option("path", f"{out}/data").option("checkpointLocation", f"{out}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.run_id for r in spark.read.parquet(f"{out}/data").collect()) == [1, 3]


DAY2 = D0 + dt.timedelta(days=1)
LANDINGS = [
    [_r(2, 5), _r(1, 0), _r(3, 1, task="t2")],
    [_r(4, 60 * 24 + 2, day=DAY2), _r(5, 60 * 24 + 1, day=DAY2)],
    # three days later: a repeat of an old key (no new notice) and a late
    # first failure of an old date (must not be dropped)
    [_r(6, 60 * 24 * 4, day=DAY2), _r(7, 3, task="t3"), _r(8, 1), _r(9, 0, state="success")],
]
WANT = [("2024-01-01", "t1"), ("2024-01-01", "t2"), ("2024-01-01", "t3"), ("2024-01-02", "t1")]


@pytest.mark.parametrize("size", [1, 1000])
@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_stream_notices_for_any_order_and_batch_size(spark, size, order):
    src = scratch_path(spark, "test-fb-src")
    for k in order:
        runs(spark, LANDINGS[k]).coalesce(1).write.mode("append").parquet(src)
    out = run_first_failure_batches(spark, src, scratch_path(spark, "test-fb-out"),
                                    files_per_batch=size)
    assert sorted((str(r.execution_date), r.task_id) for r in out.collect()) == WANT
    assert out.first().subject == f"Fallo en DAG: dag_a, Task: {out.first().task_id}"


def test_stream_without_failures(spark):
    src = scratch_path(spark, "test-fb-none")
    runs(spark, [_r(1, 0, state="success")]).write.parquet(src)
    out = run_first_failure_batches(spark, src, scratch_path(spark, "test-fb-none-out"))
    assert out.collect() == []


def test_stream_replay_is_idempotent_and_compaction_keeps_keys(spark):
    from ferry.streaming.first_failure import _notify_batch, compact_notices, read_notices
    out = scratch_path(spark, "test-fb-replay") + "/data"
    fn = _notify_batch(out)
    batch = runs(spark, [_r(1, 0), _r(2, 1, task="t2")])
    fn(batch, 0)
    fn(batch, 0)  # the same batch again, as after a failure
    fn(runs(spark, [_r(3, 2), _r(4, 2, task="t3"), _r(5, 2, day=DAY2)]), 1)
    keys = lambda: sorted((str(r.execution_date), r.task_id)
                          for r in read_notices(spark, out).collect())
    assert keys() == WANT
    compact_notices(spark, out, [D0, DAY2, D0 + dt.timedelta(days=9)], before_batch=2)
    assert keys() == WANT
    fn(runs(spark, [_r(6, 9), _r(7, 9, task="t4")]), 2)
    assert keys() == sorted([*WANT, ("2024-01-01", "t4")])


def test_exception_layout(spark):
    df = runs(spark, [_r(1, 0), _r(2, 1)]).selectExpr("*", "if(run_id = 1, 'KeyError: x', null) "
                                                      "AS exception")
    out = {r.run_id: r for r in failure_notices(df, style="exception").collect()}
    assert out[1].subject == "Task t1 in DAG dag_a Failed"
    assert "<td>KeyError: x</td>" in out[1].body and "<td></td>" in out[2].body
