"""Several analyses of one stream in one query: each micro-batch is read and parsed
once, persisted, and every analysis adds it to the small partial results it carries
(:mod:`.partials`, :mod:`.streaks`).

The carried results are versions of the batch ids (:mod:`tidewatch.sinks.versions`)
and are written after the sinks: a replayed batch starts from the state before it,
and repeats the same rows to sinks that know its id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import cleaning
from tidewatch.operators import histogram as hist_ops
from tidewatch.sinks.owner import claim, query_id
from tidewatch.sinks.versions import read_version, write_version
from tidewatch.streaming import maintained, partials
from tidewatch.streaming.streaks import RUN_STATE, advance_batch, merged_runs, run_ends

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Analyses:
    """How the three analyses see a batch's readings, and their parameters."""

    histogram_input: Callable[[DataFrame], DataFrame]
    window_input: Callable[[DataFrame], DataFrame]
    streak_input: Callable[[DataFrame], DataFrame]
    bins: tuple                             # start, step, count
    size: str
    slide: str
    lateness: str
    limit: int
    mode: str = "append"                    # of the windows
    slices: int | None = None
    idle_ms: int | None = None
    deny: tuple = ()
    allow: tuple = ()
    newest: int = 5                         # windows per dataset that a dashboard shows


def combined_writer(a: Analyses, sinks: Mapping[str, Sink], state_root: str) -> Sink:
    """``foreachBatch`` function over lines (``value``) or readings.

    ``sinks`` names the results wanted: ``histogram`` (bins whose count changed, with
    their new counts), ``changelog`` (one updated count per reading), ``windows``,
    ``late`` (readings that no open window covers), ``streaks`` (alerts),
    ``quarantine`` (lines that are no readings; for lines only) and ``dashboard``
    (any value: the newest windows, the newest streak and the bins are kept for
    :func:`tidewatch.streaming.maintained.read_dashboard`).
    """
    root = state_root.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        claim(spark, root, query_id(batch))
        lines = "dataset_id" not in batch.columns
        whole = (cleaning.classify_parsed(batch, a.deny, a.allow) if lines else batch).persist(StorageLevel.MEMORY_AND_DISK)
        held = [whole]

        def keep(df: DataFrame) -> DataFrame:
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return held[-1]

        try:
            readings = cleaning.readings_of_lines(whole) if lines else whole
            states: dict[str, DataFrame] = {}
            shown: dict[str, DataFrame] = {}
            if lines and "quarantine" in sinks:
                sinks["quarantine"](cleaning.quarantine_of_lines(whole), batch_id)

            if {"histogram", "changelog", "dashboard"} & set(sinks):
                before = read_version(spark, f"{root}/bins", partials.BIN_STATE, batch_id)
                mine = a.histogram_input(readings)
                counts = keep(hist_ops.histogram(mine, *a.bins))
                states["bins"] = keep(partials.add_counts(before, counts))
                changed = F.broadcast(counts.select("bin"))             # at most one row per bin
                shown["histogram"] = states["bins"].join(changed, "bin", "left_semi")
                if "changelog" in sinks:
                    sinks["changelog"](partials.changelog(mine, before, *a.bins, slices=a.slices), batch_id)

            if {"windows", "late", "dashboard"} & set(sinks):
                clock = read_version(spark, f"{root}/clock", partials.CLOCK_STATE, batch_id).first()
                step = partials.advance_windows(
                    a.window_input(readings), read_version(spark, f"{root}/panes", partials.PANE_STATE, batch_id),
                    clock[0] if clock else partials.NO_WATERMARK, a.size, a.slide, a.lateness, a.mode)
                shown["windows"] = keep(step.results)
                shown["late"] = step.late
                states["panes"] = step.panes
                states["clock"] = spark.createDataFrame([(step.watermark_us,)], partials.CLOCK_STATE)

            if {"streaks", "dashboard"} & set(sinks):
                runs = read_version(spark, f"{root}/runs", RUN_STATE, batch_id)
                counted = keep(advance_batch(a.streak_input(readings), runs, a.slices)[0])
                alerts = counted.where(F.col("counts") >= a.limit)
                shown["streaks"] = alerts.select("device_id", "start_ms", "counts", "ts_ms")
                states["runs"] = merged_runs(runs, run_ends(counted), a.idle_ms)

            for name, rows in shown.items():
                if name in sinks:
                    sinks[name](rows, batch_id)
            if "dashboard" in sinks:
                maintained.refresh(spark, f"{root}/dashboard", batch_id, shown["windows"], shown["streaks"], a.newest)
            for name, table in states.items():
                write_version(table, f"{root}/{name}", batch_id)
        finally:
            for df in reversed(held):
                df.unpersist()
    return write
