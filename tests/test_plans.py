"""The plan properties the README claims, pinned on the smoke-size tables."""

import re

import numpy as np
import pytest

from conftest import SF_SMALL
from tidewatch.config import EVENTS
from tidewatch.operators import cleaning, scan, streaks
from tidewatch.plans import queries
from tidewatch.sources.tables import readings


def _final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_streak_scan_shuffles_rows_once(spark):
    plan = _final_plan(queries.q_rising_streaks(spark, SF_SMALL))
    assert "ReusedExchange" in plan
    lines = plan.splitlines()
    assert sum("Exchange rangepartitioning" in ln and "ReusedExchange" not in ln for ln in lines) == 1
    assert "BroadcastExchange" in plan          # the per-slice carry table


def test_sliding_windows_prune_and_preaggregate(spark):
    df = queries.q_sliding_extremes(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["event_type", "ts", "value"]
    assert "partial_max" in plan and "partial_min" in plan


def test_dataset_filter_reaches_the_scan(spark):
    df = cleaning.only_dataset(readings(spark, SF_SMALL), EVENTS.temperature)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan


def test_kernel_follows_spark_nan_order():
    # NaN is the largest value: 1 -> NaN rises, NaN -> 2 restarts, NaN -> NaN restarts
    v = np.array([1.0, np.nan, 2.0, np.nan, np.nan])
    ts = np.arange(5, dtype="int64")
    _, counts, _ = scan.advance_runs(None, None, None, ts, v, None)
    assert counts.tolist() == [1, 2, 1, 2, 1]


def test_empty_input(spark):
    df = readings(spark, SF_SMALL).where("1 = 0")
    assert streaks.streak_counts(df).count() == 0
    assert scan.ordered_running_count(df, "device_id", "ts_ms", "seq").count() == 0


@pytest.mark.parametrize("name", ["upsert_final_state", "streak_upserts"])
def test_upserts_rank_within_tasks_first(spark, name):
    """The keyed pick limits every key to one row before the shuffle, and sorts no aggregate."""
    plan = _final_plan(queries.QUERIES[name](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan
