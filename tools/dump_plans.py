"""Write PLANS.md: the physical plan of every query of the reference's operators.

    python tools/dump_plans.py [sf_dir]

Plans are taken after staging (eager steps such as the ordinal sort, the
first pass over a large text and the stream drain have already run; what is shown is the
plan of the returned DataFrame). Scratch paths are shortened.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "daily_report": "Scan of the four columns landed by one pass over the JSON (values counted on "
                    "the way); one range shuffle for the sort.",
    "daily_report_array": "mapInArrow over block rows (one task each), JVM parse, one range shuffle "
                          "for the sort; no text is shuffled before it.",
    "daily_report_days": "Scan of the rows that the stream landed.",
    "csv_documents_file": "mapInArrow over block rows, JVM parse: one file, many tasks.",
    "interchange_text": "mapInArrow over block rows; one shuffle by row label.",
    "users_html_file": "Text scan of one file, split.",
    "incremental_extract": "Scan of the committed runs; no exchange.",
    "table_extent": "PushedAggregation in the scan: footers only.",
    "first_failure_state": "Last revision per key: one shuffle of the stream's output.",
    "sprite_assets_sheet": "CSV scan of the written sheet.",
    "daily_report_http": "Scan of the records landed by the Python data source (one partition "
                         "per URL, each requested once); one range shuffle for the sort.",
    "daily_report_sheet": "CSV scan of the written sheet.",
    "photos_assets_sheet": "CSV scan of the written sheet.",
    "csv_documents": "CSV scan of the written folder (multi-line: one task per file).",
    "failure_alerts_exception": "Narrow: filter + project, no exchange.",
    "asset_fetch_audit": "mapInPandas fetch of distinct URLs (sizes measured in the same pass, "
                         "no bytes shuffled); join back on url.",
    "daily_report_series": "Rows come from the range-sorted ordinal table; offsets: partial counts "
                           "of _ferry_pid only, a window over one row per partition, broadcast.",
    "daily_report_rowcount": "Partial count per task, one final merge.",
    "photos_projection": "Narrow: scan + project.",
    "photos_sheet": "CSV scan of the written sheet.",
    "photos_series": "Rows as landed; one offset per read block, joined by measured size; no sort.",
    "asset_status": "Narrow; the placeholder is a literal.",
    "image_audit": "Header sizes via mapInPandas over the manifest: no listing, no join.",
    "sprite_urls": "One lazy mapInArrow over the documents: no exchange.",
    "sprite_sheet": "As sprite_urls plus a projection.",
    "table_extract": "Narrow: table scan, splits follow its size.",
    "csv_roundtrip": "CSV scan of the written folder.",
    "insert_select_limit": "Scan of the target table (the insert ran TakeOrderedAndProject).",
    "high_water_mark": "Partial max per task, one final merge.",
    "high_water_mark_handoff": "Scalar subquery (partial max, one merge), no join.",
    "users_documents": "Narrow.",
    "users_json_rows": "Text scan of the written lines.",
    "users_html_rows": "Narrow; codegen'd string building.",
    "users_html_doc": "Ordinal table + one hash aggregate per page (groups bounded by page size).",
    "interchange_roundtrip": "Narrow: text scan, one parse per chunk line, explode.",
    "failure_alerts": "Narrow: filter + project, no exchange.",
    "first_failure": "partial_min per task before the exchange, so hot keys are pre-reduced. "
                     "Sort-based, because the min(struct) buffer holds strings, which hash "
                     "aggregation cannot update in place; it spills instead of failing.",
    "first_failure_stream": "Scan of the notices table the foreachBatch stream wrote.",
    "run_date_tag": "Narrow; parameters bound as literals.",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ferry.plans.queries import QUERIES
    from ferry.session import build_session

    spark = build_session(shuffle_partitions=16)
    jvm = spark.sparkContext._jvm
    out = ["# PLANS", "",
           f"Physical plans of the registered queries (`tools/dump_plans.py`, {sf_dir}, "
           "16 shuffle partitions, AQE on: plans are shown before AQE's runtime changes).", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        plan = re.sub(r"file:[^\],\s]*/ferry/([a-z_-]+)-[0-9a-f]{12}", r"<scratch>/\1", plan)
        plan = re.sub(r"(?<=[A-Za-z0-9_)])#\d+L?\b", "", plan)
        out += [f"## {name}", "", NOTES.get(name, ""), "", "```", plan.strip(), "```", ""]
    spark.stop()
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
