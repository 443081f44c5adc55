import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewatch.plans import jobs, pipelines
from tidewatch.sinks import append, archive, outputs, upsert, versions
from tidewatch.sources.files import text_source
from tidewatch.sources.kafka import kafka_available, kafka_reader
from tidewatch.sources.tables import readings, result_table


def test_g7_upsert_replay_is_noop(spark, tmp_dir):
    root = os.path.join(tmp_dir, "hist")
    assert upsert.read_table(spark, root) is None
    assert upsert.read_table(spark, root, "bin double, cnt long").count() == 0
    b1 = spark.createDataFrame([(25.5, 1), (26.0, 2)], "bin double, cnt long")
    b2 = spark.createDataFrame([(26.0, 5), (26.5, 1)], "bin double, cnt long")
    upsert.upsert(spark, root, b1, 0, ["bin"])
    upsert.upsert(spark, root, b2, 1, ["bin"])
    want = {25.5: 1, 26.0: 5, 26.5: 1}
    assert {r.bin: r.cnt for r in upsert.read_table(spark, root).collect()} == want
    upsert.upsert(spark, root, b2, 1, ["bin"])              # replay: the same partition again
    upsert.upsert(spark, root, b1, 0, ["bin"])
    assert {r.bin: r.cnt for r in upsert.read_table(spark, root).collect()} == want
    assert {r.bin: r.cnt for r in upsert.read_table(spark, root, upto=0).collect()} == {25.5: 1, 26.0: 2}
    assert spark.read.parquet(root).count() == 4            # an ordinary Parquet table


def test_upsert_keeps_newest_in_batch(spark, tmp_dir):
    root = os.path.join(tmp_dir, "streaks")
    b = spark.createDataFrame([("a", 0, 3), ("a", 0, 4), ("b", 5, 3)], "device_id string, start_ms long, counts long")
    upsert.upsert(spark, root, b, 7, ["device_id", "start_ms"], order="counts")
    got = sorted(tuple(r) for r in upsert.read_table(spark, root).collect())
    assert got == [("a", 0, 4), ("b", 5, 3)]


def test_idempotent_append(spark, tmp_dir):
    root = os.path.join(tmp_dir, "win")
    b = spark.createDataFrame([("x", 1.0)], "dataset_id string, max_value double")
    append.append_batch(b, 0, root)
    append.append_batch(b, 1, root)
    append.append_batch(b, 1, root)   # replay
    assert append.read_appended(spark, root).count() == 2


def test_archive_layout_and_pruning(spark, tmp_dir):
    root = os.path.join(tmp_dir, "arch")
    lines = pipelines.event_lines(spark, SF_SMALL, with_ts=True)
    archive.write_archive(lines, root, time_col="ts")
    back = archive.read_archive(spark, root)
    assert back.count() == lines.count()
    day = sorted(d for d in os.listdir(root) if d.startswith("day="))[0].split("=")[1]
    one = archive.read_archive(spark, root, day=day, hour="07")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan
    assert one.count() == lines.where(F.date_format("ts", "yyyyMMdd") == day).where(
        F.date_format("ts", "HH") == "07").count()
    assert dict(back.dtypes)["hour"] == "string"


def test_lines_sink_and_text_source(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines")
    r = readings(spark, SF_SMALL)
    outputs.write_lines(r, path)
    back = jobs.readings_from_lines(text_source(spark, path), jobs.JobParams(deny=(), allow=(",",)))
    assert back.count() == r.count()


def test_fan_out_writes_every_sink(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    w = outputs.fan_out([append.append_writer(a), upsert.upsert_writer(b, ["k"])])
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    w(df, 3)
    assert append.read_appended(spark, a).count() == 2
    assert upsert.read_table(spark, b).count() == 2


def test_decode_to_lines_job(spark, tmp_dir):
    out = os.path.join(tmp_dir, "decoded")
    r = jobs.decode_to_lines_job(pipelines.event_responses(spark, SF_SMALL), out)
    assert spark.read.text(out).count() == r.count() > 0


def test_jdbc_round_trip_embedded_derby(spark, tmp_dir):
    # Embedded Derby runs inside this JVM: no server, no port.
    url = f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"
    df = spark.createDataFrame([("humidity_data", "2022-03-30:02:30:10", 42.0)],
                               "datasetid string, winstart string, value double")
    outputs.write_jdbc(df, url, "temphumimax", driver="org.apache.derby.jdbc.EmbeddedDriver")
    back = result_table(spark, fmt="jdbc", url=url, dbtable="temphumimax",
                        driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert [tuple(r) for r in back.collect()] == [("humidity_data", "2022-03-30:02:30:10", 42.0)]


def test_kafka_needs_its_connector(spark):
    from tidewatch.sources.kafka import kafka_source
    assert kafka_reader(spark, "broker:9092", "readings") is not None
    if not kafka_available(spark):
        with pytest.raises(RuntimeError, match="classpath"):
            kafka_source(spark, "broker:9092", "readings")


def test_upsert_writes_only_the_batch(spark, tmp_dir):
    root = os.path.join(tmp_dir, "mor")
    rows = {}
    for b in range(5):
        batch = [(k, b * 10 + k) for k in range(b, b + 3)]          # keys overlap between batches
        upsert.upsert(spark, root, spark.createDataFrame(batch, "k int, v long"), b, ["k"])
        rows.update(dict(batch))
        # a write adds exactly one folder; earlier ones are untouched
        assert sorted(d for d in os.listdir(root) if d.startswith("batch="))[-1] == f"batch={b}"
    assert {r.k: r.v for r in upsert.read_table(spark, root).collect()} == rows
    plan = upsert.read_table(spark, root, upto=3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan and "SortAggregate" not in plan


def test_resolved_rows_are_whole_rows(spark, tmp_dir):
    """Ties on the order column cannot mix columns of different rows; nulls lose."""
    root = os.path.join(tmp_dir, "whole")
    rows = [("a", 1, "x", 1.0), ("a", 1, "y", None), ("a", None, "z", 3.0)]
    for b in range(2):
        upsert.upsert(spark, root, spark.createDataFrame(rows, "k string, o int, v string, w double"), b, ["k"], order="o")
    assert tuple(upsert.read_table(spark, root).first()) in {("a", 1, "x", 1.0), ("a", 1, "y", None)}


def test_archive_splits_a_hot_hour(spark, tmp_dir):
    """Processing-time folders put a whole batch in one hour; the write must
    still be spread over several tasks (AQE splits the rebalanced partition)."""
    root = os.path.join(tmp_dir, "hot")
    # eight input splits, as a multi-file source has; AQE splits a hot reducer
    # partition along map-task boundaries
    lines = pipelines.event_lines(spark, SF_SMALL).repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        archive.write_archive(lines, root)                # processing time: one (day, hour)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    days = [d for d in os.listdir(root) if d.startswith("day=")]
    hours = [os.path.join(root, d, h) for d in days for h in os.listdir(os.path.join(root, d))
             if h.startswith("hour=")]
    files = [f for h in hours for f in os.listdir(h) if f.startswith("part-")]
    assert len(files) >= 4
    assert archive.read_archive(spark, root).count() == lines.count()


def test_state_versions_keep_what_a_replay_needs(spark, tmp_dir):
    root = os.path.join(tmp_dir, "state")
    assert versions.read_version(spark, root, "k int").count() == 0
    for b in (0, 1, 4, 5):
        versions.write_version(spark.createDataFrame([(b,)], "k int"), root, b)
    assert versions.versions(spark, root) == [4, 5]
    assert versions.read_version(spark, root, "k int").first()[0] == 5
    assert versions.read_version(spark, root, "k int", before=5).first()[0] == 4
    versions.write_version(spark.createDataFrame([(50,)], "k int"), root, 5)            # replay
    assert versions.versions(spark, root) == [4, 5] and versions.read_version(spark, root, "k int").first()[0] == 50
    os.remove(os.path.join(root, "version=5", "_SUCCESS"))                              # a write that did not end
    assert versions.read_version(spark, root, "k int").first()[0] == 4


def test_order_column_wins_over_a_later_batch(spark, tmp_dir):
    """A run that restarts at the same start in a later batch keeps its highest count."""
    root = os.path.join(tmp_dir, "k3")
    for b, n in enumerate((5, 3)):
        upsert.upsert(spark, root, spark.createDataFrame([("a", 0, n)], "d string, s long, n long"), b, ["d", "s"], order="n")
    assert [tuple(r) for r in upsert.read_table(spark, root).collect()] == [("a", 0, 5)]
