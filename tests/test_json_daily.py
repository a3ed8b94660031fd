"""A payload a day: each is read once, also after a restart."""

from __future__ import annotations

import json
import os

import pytest

from ferry.sources.json_daily import is_there, land_daily


def put(tmp_dir, ds, n):
    with open(os.path.join(tmp_dir, f"p-{ds}.json"), "w") as f:
        json.dump([{"id": int(ds[-2:]) * 100 + k} for k in range(n)], f)


def landed(spark, tmp_dir):
    df = land_daily(spark, f"file://{tmp_dir}/p-{{ds}}.json", "2024-01-30", "id BIGINT",
                    f"{tmp_dir}/out")
    return sorted((str(r.ds), r.ordinal, r.id) for r in df.collect())


def test_days_are_read_once_across_restarts(spark, tmp_dir):
    put(tmp_dir, "2024-01-30", 2)
    put(tmp_dir, "2024-02-01", 1)  # the day before it is not there yet
    first = [("2024-01-30", 0, 3000), ("2024-01-30", 1, 3001)]
    assert landed(spark, tmp_dir) == first
    assert landed(spark, tmp_dir) == first  # nothing new, nothing twice
    put(tmp_dir, "2024-01-31", 0)  # an empty payload
    assert landed(spark, tmp_dir) == [*first, ("2024-02-01", 0, 100)]


def test_missing_and_wrong_urls(spark, tmp_dir):
    assert not is_there(f"file://{tmp_dir}/none.json")
    with pytest.raises(Exception):
        land_daily(spark, f"file://{tmp_dir}/p.json", "2024-01-30", "id BIGINT", f"{tmp_dir}/o")
