"""K1/K3 and S5 against the embedded database of the test's own JVM (no server, no port)."""

import os

import pytest
from pyspark.sql import functions as F

from sample_lines import sample_lines
from test_streaming import write_line_files
from tidewatch.operators import streaks
from tidewatch.plans import jobs
from tidewatch.sinks import jdbc_upsert as ju
from tidewatch.sinks.owner import OtherQueryError
from tidewatch.sinks.outputs import write_jdbc
from tidewatch.sources import jdbc
from tidewatch.sources.tables import result_table
from tidewatch.streaming.readers import line_readings_stream

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture()
def url(tmp_dir):
    return f"jdbc:derby:{os.path.join(tmp_dir, 'db')};create=true"


def table(spark, url, name):
    return result_table(spark, fmt="jdbc", url=url, dbtable=name, **DRIVER)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def notes(spark, url):
    return rows_of(table(spark, url, ju.NOTES))


def test_histogram_upsert_updates_and_inserts(spark, url):
    t = ju.Target(url, "tempintervalcount", ("tempinterval",), options=DRIVER)
    schema = "tempinterval double, intervalcount long"
    one = spark.createDataFrame([(25.5, 1), (26.0, 2)], schema)
    two = spark.createDataFrame([(26.0, 5), (26.5, 1)], schema)
    assert ju.jdbc_upsert(one, 0, t) and ju.jdbc_upsert(two, 1, t)
    want = [(25.5, 1), (26.0, 5), (26.5, 1)]
    assert rows_of(table(spark, url, t.table)) == want
    # a replayed batch changes nothing, a changed one under an old id neither
    assert not ju.jdbc_upsert(two, 1, t)
    assert not ju.jdbc_upsert(one, 0, t)
    assert rows_of(table(spark, url, t.table)) == want and table(spark, url, t.staging).count() == 0
    assert notes(spark, url) == [("tempintervalcount", "", 1)]


def test_streak_replaces_by_key_and_keeps_the_highest_count(spark, url):
    t = ju.Target(url, "tempincrease", ("deviceid", "starttime"), order="counts", options=DRIVER)
    schema = "deviceid string, starttime string, counts long"
    ju.jdbc_upsert(spark.createDataFrame([("a'; drop table x; --", "t1", 3), ("a'; drop table x; --", "t1", 4), ("b", "t1", 9)], schema), 4, t)
    ju.jdbc_upsert(spark.createDataFrame([("b", "t1", 5), ("c", "t2", 3)], schema), 7, t)
    assert rows_of(table(spark, url, t.table)) == [("a'; drop table x; --", "t1", 4), ("b", "t1", 9), ("c", "t2", 3)]


def test_a_failed_batch_leaves_the_table_as_it_was(spark, url):
    t = ju.Target(url, "tempintervalcount", ("tempinterval",), options=DRIVER)
    schema = "tempinterval double, intervalcount long"
    ju.jdbc_upsert(spark.createDataFrame([(25.5, 1)], schema), 0, t)
    bad = spark.createDataFrame([(26.0, 2), (None, 3)], schema)
    with pytest.raises(Exception):
        ju.jdbc_upsert(bad, 1, t)                       # a key is missing: the database refuses it
    assert rows_of(table(spark, url, t.table)) == [(25.5, 1)] and notes(spark, url)[0][2] == 0
    # the merge itself fails: neither the rows nor the batch's note stay
    with pytest.raises(Exception):
        with ju.transaction(spark, t) as c:
            ju._execute(c, f"UPDATE {ju.NOTES} SET batch_id = ? WHERE target = ?", 9, t.table)
            ju._execute(c, "INSERT INTO tempintervalcount VALUES (25.5, 7)")
    assert notes(spark, url)[0][2] == 0
    assert ju.jdbc_upsert(spark.createDataFrame([(26.0, 2)], schema), 1, t)
    assert rows_of(table(spark, url, t.table)) == [(25.5, 1), (26.0, 2)]


def test_another_query_is_refused(spark, url):
    t = ju.Target(url, "w", ("k",), options=DRIVER)
    df = spark.createDataFrame([(1, 1)], "k int, v int")
    assert ju.jdbc_upsert(df, 0, t, "query-1")
    with pytest.raises(OtherQueryError):
        ju.jdbc_upsert(df, 0, t, "query-2")


def test_statements_of_the_dialects():
    def sql(dialect, order=None, columns=("k", "v", "n")):
        return ju.apply_sql(ju.Target("u", "t", ("k",), order, dialect), columns)

    assert sql("merge") == ("MERGE INTO t t USING t_staging s ON t.k = s.k WHEN MATCHED THEN UPDATE SET v = s.v, n = s.n "
                            "WHEN NOT MATCHED THEN INSERT (k, v, n) VALUES (s.k, s.v, s.n)")
    assert " AND s.n >= t.n THEN UPDATE" in sql("merge", "n")
    assert sql("on_conflict", "n").endswith("ON CONFLICT (k) DO UPDATE SET v = excluded.v, n = excluded.n WHERE excluded.n >= t.n")
    assert sql("on_duplicate_key", "n").endswith("v = IF(VALUES(n) >= n, VALUES(v), v), n = IF(VALUES(n) >= n, VALUES(n), n)")
    assert "DO NOTHING" in sql("on_conflict", columns=("k",)) and "UPDATE SET" not in sql("merge", columns=("k",))
    with pytest.raises(ValueError):
        sql("other")


def test_combined_stream_into_the_database(spark, tmp_dir, url):
    """J1 with its reference sinks: counts and streaks upserted, windows inserted, in database tables."""
    src = os.path.join(tmp_dir, "in")
    rows = sample_lines()
    write_line_files(src, [rows[:60], rows[60:120], rows[120:]])
    p = jobs.JobParams(streak_limit=2)
    hist = ju.Target(url, "tempintervalcount", ("bin",), options=DRIVER)
    streak = ju.Target(url, "tempincrease", ("device_id", "start_ms"), order="counts", options=DRIVER)
    window = ju.Target(url, "temphumimax", ("dataset_id", "win_start"), options=DRIVER)
    sinks = {"histogram": ju.jdbc_upsert_writer(hist), "windows": ju.jdbc_upsert_writer(window),
             "streaks": jobs._without_time(ju.jdbc_upsert_writer(streak))}
    q = jobs.start_combined_stream(line_readings_stream(spark, src, max_files_per_trigger=1), {"state": os.path.join(tmp_dir, "state")},
                                   p, os.path.join(tmp_dir, "ck"), {"availableNow": True}, sinks=sinks)
    q.awaitTermination()
    assert q.exception() is None
    batch = jobs.combined_job(spark.createDataFrame([(r,) for r in rows], "value string"), p)
    assert rows_of(table(spark, url, hist.table)) == rows_of(batch["histogram"])
    assert rows_of(table(spark, url, streak.table)) == rows_of(streaks.streak_table(batch["streaks"]))
    closed = rows_of(table(spark, url, window.table).select("dataset_id", "win_start", "max_value", "n"))
    assert len(closed) == 24 and set(closed) <= set(rows_of(batch["windows"].select("dataset_id", "win_start", "max_value", "n")))
    assert {n[1] for n in notes(spark, url)} == {q.id} and {n[2] for n in notes(spark, url)} == {2}


# -- partitioned reads --------------------------------------------------------

def windows_table(spark, url, n=300):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "humidity_data").otherwise("temperature_data").alias("datasetid"),
        F.date_format(F.timestamp_seconds(1_648_600_000 + F.col("id") * 10), "yyyy-MM-dd:HH:mm:ss").alias("winstart"),
        (F.col("id") % 50).cast("double").alias("value"), F.col("id").alias("seq"))
    write_jdbc(df, url, "temphumimax", createTableColumnTypes="datasetid VARCHAR(64), winstart VARCHAR(32)", **DRIVER)
    return df


@pytest.mark.parametrize("key", ["winstart", "seq", "value"])
def test_partitioned_read_has_several_tasks_and_equal_rows(spark, url, key):
    df = windows_table(spark, url)
    back = jdbc.partitioned_table(spark, url, "temphumimax", key, tasks=6, **DRIVER)
    assert back.rdd.getNumPartitions() == 6
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) <= 60
    assert rows_of(back) == rows_of(df)
    by_size = jdbc.partitioned_table(spark, url, "temphumimax", key, rows_per_task=100, **DRIVER)
    assert by_size.rdd.getNumPartitions() == 3


def test_filters_and_top_rows_reach_the_database(spark, url):
    df = windows_table(spark, url)
    back = jdbc.partitioned_table(spark, url, "temphumimax", "winstart", tasks=4, **DRIVER)
    one = back.where((F.col("datasetid") == "humidity_data") & (F.col("value") > 40)).select("winstart")
    plan = one._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "EqualTo(DATASETID,humidity_data)" in pushed.replace("datasetid", "DATASETID") and "GreaterThan" in pushed
    assert one.count() == df.where((F.col("datasetid") == "humidity_data") & (F.col("value") > 40)).count() > 0
    top = jdbc.top_rows(spark, url, "temphumimax", [("winstart", "desc")], 5, {"datasetid": "humidity_data"}, **DRIVER)
    want = df.where("datasetid = 'humidity_data'").orderBy(F.col("winstart").desc()).limit(5)
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in want.collect()]
    assert "FETCH FIRST 5 ROWS ONLY" in top._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        jdbc.top_rows(spark, url, "temphumimax", [("winstart", "desc; drop table x")], 5, **DRIVER)
    with pytest.raises(ValueError):
        jdbc.top_rows(spark, url, "temphumimax", [("nothing", "desc")], 5, **DRIVER)


def test_ranges_cover_nulls_and_small_tables(spark, url):
    df = spark.createDataFrame([("2022-03-30:02:30:10", 2), ("2022-03-30:02:30:50", 3), ("2022-03-30:02:30:30", 4)], "winstart string, v int")
    text = {"createTableColumnTypes": "winstart VARCHAR(32)", **DRIVER}
    write_jdbc(df, url, "few", **text)
    with ju.transaction(spark, ju.Target(url, "few", (), options=DRIVER)) as c:
        ju._execute(c, "INSERT INTO few VALUES (NULL, 1)")
    back = jdbc.partitioned_table(spark, url, "few", "winstart", tasks=4, **DRIVER)
    assert {r["v"] for r in back.collect()} == {1, 2, 3, 4} and back.rdd.getNumPartitions() == 4
    write_jdbc(df.limit(0), url, "nothing", **text)
    assert jdbc.partitioned_table(spark, url, "nothing", "winstart", tasks=4, **DRIVER).count() == 0
    assert jdbc.range_predicates("abc", "xyz", "k", 4) == [] and jdbc.range_predicates(5, 5, "k", 4) == []
    assert jdbc.range_predicates(0, 10, "k", 2) == ["k < 5 OR k IS NULL", "k >= 5"]
