"""Measure what each query scans and shuffles, from Spark's event log.

    python tools/scale_report.py [sf_dir]

Each query runs once to stage its fixture, then once more under its own job
group with every row written to the ``noop`` sink. The event log (written
to the scratch folder) gives, per query: jobs, stages, bytes read by scans,
rows read by scans, rows and bytes written to shuffles, and the largest
task's share of its stage's shuffle read (skew). AQE partition coalescing
is off for the measurement so every shuffle keeps its 16 partitions and
the skew figure means something. Writes SCALE.md.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _metric(task_metrics: dict, *path, default=0):
    cur = task_metrics
    for p in path:
        if not isinstance(cur, dict) or p not in cur:
            return default
        cur = cur[p]
    return cur


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from ferry.plans.queries import QUERIES
    from ferry.session import build_session, scratch_root

    probe = build_session(app="ferry-scale-probe")
    log_dir = f"{scratch_root(probe)}/ferry/eventlog-{os.getpid()}"
    probe.stop()
    os.makedirs(log_dir.removeprefix("file:"), exist_ok=True)
    spark = build_session(app="ferry-scale", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.rolling.enabled": "false",
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    names = list(QUERIES)
    for name, fn in QUERIES.items():
        fn(spark, sf_dir).count()  # stage fixtures outside the measured group
        sc.setJobGroup(name, name)
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        sc.setJobGroup("", "")
    spark.stop()

    job_group, stage_job = {}, {}
    stage_read, stage_shuffle_w, stage_shuffle_r, stage_shuffle_n = (
        defaultdict(int) for _ in range(4))
    task_shuffle_r = defaultdict(list)
    logs = glob.glob(os.path.join(log_dir.removeprefix("file:"), "**", "*"), recursive=True)
    for path in [p for p in logs if os.path.isfile(p)]:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerTaskEnd":
                sid, tm = ev["Stage ID"], ev.get("Task Metrics") or {}
                stage_read[sid] += _metric(tm, "Input Metrics", "Records Read")
                stage_shuffle_w[sid] += _metric(tm, "Shuffle Write Metrics",
                                                "Shuffle Bytes Written")
                stage_shuffle_n[sid] += _metric(tm, "Shuffle Write Metrics",
                                                "Shuffle Records Written")
                r = (_metric(tm, "Shuffle Read Metrics", "Remote Bytes Read")
                     + _metric(tm, "Shuffle Read Metrics", "Local Bytes Read"))
                stage_shuffle_r[sid] += r
                task_shuffle_r[sid].append(r)

    per = defaultdict(lambda: {"jobs": set(), "stages": set(), "read": 0, "shuffle": 0,
                               "rows": 0, "skew": 0.0})
    for sid, job in stage_job.items():
        q = job_group.get(job, "")
        if q not in names:
            continue
        d = per[q]
        d["jobs"].add(job)
        d["stages"].add(sid)
        d["read"] += stage_read[sid]
        d["shuffle"] += stage_shuffle_w[sid]
        d["rows"] += stage_shuffle_n[sid]
        tasks = task_shuffle_r[sid]
        if stage_shuffle_r[sid] > 0 and len(tasks) > 1:
            d["skew"] = max(d["skew"], max(tasks) / stage_shuffle_r[sid])

    out = ["# SCALE", "",
           f"Measured with Spark's event log (`tools/scale_report.py`, {sf_dir}, `local[8]`, "
           "16 shuffle partitions, AQE on). One measured run per query, after staging; "
           "eager steps inside a query (ordinal sort, block scans, stream drain, "
           "writes) are included.", "",
           "* **rows scanned**: records read by file scans (includes re-reads of tables "
           "a query writes itself). **rows shuffled / MB**: records and bytes written to "
           "shuffle files. **ratio**: rows shuffled per row scanned.",
           "* **max task share**: the largest single task's share of a stage's shuffle "
           "read, worst stage; 1/16 = 0.06 is perfectly even over the 16 partitions.", "",
           "| Query | jobs | stages | rows scanned | rows shuffled | shuffle MB | ratio "
           "| max task share |",
           "|---|---|---|---|---|---|---|---|"]
    for q in names:
        d = per.get(q)
        if not d:
            out.append(f"| `{q}` | 0 | 0 | 0 | 0 | 0 | - | - |")
            continue
        ratio = f"{d['rows'] / d['read']:.2f}" if d["read"] else "-"
        skew = f"{d['skew']:.2f}" if d["skew"] else "-"
        out.append(f"| `{q}` | {len(d['jobs'])} | {len(d['stages'])} | {d['read']:,} | "
                   f"{d['rows']:,} | {d['shuffle'] / 1e6:.2f} | {ratio} | {skew} |")
    out += ["", "Reading the numbers:", "",
            "* No query shuffles more rows than it reads records. Aggregations shuffle far "
            "fewer (`first_failure`: map-side partial minima leave one row per key and task). "
            "`daily_report_http` scans one row per fetched payload and splits it into "
            "records after the scan, so its ratio counts records per payload.",
            "* Rows scanned exceed the input where a range sort samples its input first "
            "(Spark's range partitioner reads it once for bounds) or a query re-reads a "
            "table it wrote itself (ordinal table, block states, CSV round trip).",
            "* A high task share with few groups is not growing skew when every group is "
            "bounded: `interchange_roundtrip` groups rows into hand-over chunks of at most "
            "1,000 rows, so a small table makes a few chunks on a few tasks; at scale "
            "there are millions of chunks.",
            "* `image_audit` reads image headers in Python (a few KB per file); those reads "
            "are not scan rows, and the file listing reads no file content.",
            "* `first_failure_stream`: micro-batches run on the stream's own thread and job "
            "group, so only the read of its output is attributed to it here.", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "SCALE.md")
    with open(path, "w") as f:
        f.write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
