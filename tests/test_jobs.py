"""The jobs, batch and streaming: results, quarantine, noise, console, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sample_lines import FIRST_MS, sample_lines
from test_streaming import write_line_files
from tidewatch.config import EVENTS
from tidewatch.operators import cleaning, dedup, responses, streaks, windows
from tidewatch.plans import jobs, pipelines
from tidewatch.sinks.owner import OtherQueryError
from tidewatch.sinks.upsert import read_table
from tidewatch.sources.files import text_stream
from tidewatch.sources.tables import readings
from tidewatch.streaming.operators import stream_sliding_extremes
from tidewatch.streaming.readers import line_readings_stream
from tidewatch.streaming.streaks import advance_batch

BAD = ["dev-1,temperature_data,xx,30.0", "dev-1,temperature_data,1648607465903", "dev-1,temperature_data,1648607465903,NaN",
       "dev-1,humidity_data,1648607465903,wet"]


def lines_df(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def rows_of(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_g2_sample(spark):
    lines = lines_df(spark, sample_lines())
    assert lines.count() == 189 and lines.distinct().count() == 85
    r = jobs.readings_from_lines(lines)
    assert {x["dataset_id"]: x["count"] for x in r.groupBy("dataset_id").count().collect()} == {"humidity_data": 63, "temperature_data": 63}
    once = dedup.drop_repeated_polls(r)
    assert once.count() == 84
    assert rows_of(jobs.histogram_job(lines)) == [(30.5, 63)]
    temp = r.where("dataset_id = 'temperature_data'").agg(F.min("value"), F.max("value")).first()
    assert tuple(temp) == (30.100000381469727, 30.5)
    humi = {x["value"]: x["count"] for x in r.where("dataset_id = 'humidity_data'").groupBy("value").count().collect()}
    assert humi == {41.0: 37, 42.0: 26}
    assert rows_of(jobs.streak_job(lines)) == []
    assert jobs.streak_job(lines, jobs.JobParams(streak_limit=2)).count() == 8
    two = streaks.rising_streaks(once.where("dataset_id = 'temperature_data'"), 2)
    assert two.count() == 8


def test_g2_windows(spark):
    lines = lines_df(spark, sample_lines())

    def by_window(df):
        return {(x.dataset_id, x.ms): (x.max_value, x.min_value, x.n) for x in df.withColumn("ms", F.unix_millis("win_start")).collect()}

    full = by_window(jobs.window_job(lines))
    assert len(full) == 36
    assert full["humidity_data", 1648607410000] == (42.0, 42.0, 3)
    assert full["humidity_data", 1648607420000] == (42.0, 41.0, 9)
    assert full["temperature_data", 1648607580000] == (30.5, 30.399999618530273, 6)
    once = by_window(windows.sliding_extremes(dedup.drop_repeated_polls(jobs.readings_from_lines(lines))))
    assert [once[k][2] for k in (("humidity_data", 1648607410000), ("humidity_data", 1648607420000), ("temperature_data", 1648607580000))] == [3, 7, 4]


def test_g2_stream_appends_closed_windows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [sample_lines()])
    q = (stream_sliding_extremes(line_readings_stream(spark, src)).writeStream.format("memory").queryName("g2_windows")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("g2_windows").count() == 24


def test_combined_batch_job_and_its_parts(spark):
    lines = lines_df(spark, sample_lines() + BAD + ["dev-1,other_data,1,2", None])
    p = jobs.JobParams(streak_limit=2)
    all_of = jobs.combined_job(lines, p)
    assert set(all_of) == {"histogram", "windows", "streaks", "quarantine"}
    assert rows_of(all_of["histogram"]) == rows_of(jobs.histogram_job(lines, p))
    assert rows_of(all_of["windows"]) == rows_of(jobs.window_job(lines, p))
    assert rows_of(all_of["streaks"]) == rows_of(jobs.streak_job(lines, p))
    outcome = {x["outcome"]: x["count"] for x in cleaning.classify_lines(lines).groupBy("outcome").count().collect()}
    assert outcome == {"reading": 126, "filtered": 64, "bad timestamp": 1, "too few fields": 1, "NaN value": 1, "bad value": 1, "no text": 1}
    assert all_of["quarantine"].count() == 5
    assert lines.count() == jobs.readings_from_lines(lines, p).count() + outcome["filtered"] + all_of["quarantine"].count()


def test_every_branch_draws_its_own_noise(spark):
    lines = lines_df(spark, sample_lines())
    p = jobs.JobParams().noisy()
    r = jobs.readings_from_lines(lines).where("dataset_id = 'temperature_data'").withColumn("clean", F.col("value"))

    def drawn(noisy):
        return {(x.ts_ms, x.seq): x.value - x.clean for x in noisy.collect()}

    h, w, s = drawn(jobs.histogram_input(r, p)), drawn(jobs.window_input(r, p)), drawn(jobs.streak_input(r, p))
    assert all(0 <= v < 1 + 1e-9 for v in list(w.values()) + list(s.values()))
    assert min(h.values()) < 0 < max(h.values())
    assert all(abs(w[k] - s[k]) > 1e-9 for k in w)
    assert drawn(jobs.window_input(r, p)) == w                         # a retried task draws the same


def test_a_new_checkpoint_on_an_old_folder_is_refused(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, [sample_lines()])
    stream = line_readings_stream(spark, src)
    root = os.path.join(tmp_dir, "histogram")
    jobs.start_histogram_stream(stream, root, checkpoint_root=os.path.join(tmp_dir, "ck1"), trigger={"availableNow": True}).awaitTermination()
    before = rows_of(read_table(spark, root))
    q = jobs.start_histogram_stream(stream, root, checkpoint_root=os.path.join(tmp_dir, "ck2"), trigger={"availableNow": True})
    with pytest.raises(Exception, match=OtherQueryError.__name__):
        q.awaitTermination()
    assert rows_of(read_table(spark, root)) == before
    # the same checkpoint goes on
    with open(os.path.join(src, "later.txt"), "w") as f:
        f.write(f"dev-1,temperature_data,{FIRST_MS + 200_000},26.0\n")
    jobs.start_histogram_stream(stream, root, checkpoint_root=os.path.join(tmp_dir, "ck1"), trigger={"availableNow": True}).awaitTermination()
    assert rows_of(read_table(spark, root)) == sorted(before + [(26.0, 1)])


def test_hot_device_stream_equals_batch_and_is_split(spark, tmp_dir):
    """Most rows of every micro-batch belong to one device; runs cross batches."""
    rows = [f"hot,temperature_data,{t},{20 + (t * 7) % 11}" for t in range(3000)]
    rows += [f"d{t % 5},temperature_data,{t},{t % 13}" for t in range(0, 3000, 10)]
    cut = [[r for r in rows if lo <= int(r.split(",")[2]) < lo + 1000] for lo in (0, 1000, 2000)]
    src = os.path.join(tmp_dir, "in")
    write_line_files(src, cut)
    root = os.path.join(tmp_dir, "streaks")
    p = jobs.JobParams(streak_limit=2, slices=8)
    q = jobs.start_streak_stream(line_readings_stream(spark, src, max_files_per_trigger=1), root, p, os.path.join(tmp_dir, "ck"), {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    batch = streaks.streak_table(jobs.streak_job(lines_df(spark, rows), p))
    assert rows_of(read_table(spark, root), "device_id", "start_ms", "counts") == rows_of(batch, "device_id", "start_ms", "counts")
    # the device's rows of one batch are spread over several tasks
    one = jobs.streak_input(jobs.readings_from_lines(lines_df(spark, cut[1])), p)
    counted, _ = advance_batch(one, None, slices=8)
    hot = counted.where("device_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 4


@pytest.mark.parametrize("keyed", [False, True])
def test_null_values_do_not_disturb_a_stream(spark, tmp_dir, keyed):
    schema = "device_id string, dataset_id string, ts_ms long, value double, ts timestamp, seq long"
    r = spark.createDataFrame([("a", "temperature_data", t, v, None, t) for t, v in ((1, None), (2, 1.0), (3, None), (4, 2.0))], schema)
    src = os.path.join(tmp_dir, "src")
    r.write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    root = os.path.join(tmp_dir, "t")
    q = jobs.start_streak_stream(stream, root, jobs.JobParams(streak_limit=2), os.path.join(tmp_dir, "ck"), {"availableNow": True}, keyed_state=keyed)
    q.awaitTermination()
    assert rows_of(read_table(spark, root), "device_id", "start_ms", "counts") == [("a", 2, 2)]
    batch = streaks.rising_streaks(r, 2)
    assert [(x.start_ms, x.counts, x.ts_ms) for x in batch.collect()] == [(2, 2, 4)]


def test_publish_to_topic_and_archive(spark, tmp_dir):
    """K7: one micro-batch goes to the topic and to the archive (the publisher
    stands in for a broker, which is not here)."""
    sent = []

    def publish(servers, topic):
        def run(batch, batch_id):
            sent.extend((servers, topic, r.value) for r in batch.collect())
        return run

    src, arch = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "arch")
    rows = sample_lines()[:30]
    write_line_files(src, [rows])
    q = jobs.start_publish_stream(text_stream(spark, src), "broker:9092", "readings", arch, os.path.join(tmp_dir, "ck"), {"availableNow": True}, publish)
    q.awaitTermination()
    from tidewatch.sinks.archive import read_archive
    assert sorted(v for _, _, v in sent) == sorted(rows) == sorted(r.value for r in read_archive(spark, arch).collect())
    assert {x[:2] for x in sent} == {("broker:9092", "readings")}


def test_no_ok_status_is_lost(spark, tmp_dir):
    head = "HTTP 200 body="
    good = '{"value":"1.5","timestamp":"10","datasetId":"a"}'
    rows = [
        ("d", 200, head + '{"deviceStatusList":[%s]}' % good), ("d", 200, head + '{"deviceStatusList":[%s,%s]}' % (good, good.replace("1.5", "xx"))),
        ("d", 200, head + "{broken"), ("d", 200, head + "[1"), ("d", 200, head + '{"deviceStatusList":[]}'), ("d", 200, head + "{}"),
        ("d", 200, "HTTP 200 timeout"), ("d", 200, None), ("d", 200, head + '{"deviceStatusList":[%s]}' % good.replace('"10"', '"soon"')),
        ("d", 200, head + '{"deviceStatusList":[%s]}' % good.replace("1.5", "NaN")), ("d", 500, head + '{"deviceStatusList":[%s]}' % good),
    ]
    df = spark.createDataFrame(rows, "device_id string, status_code int, resp string")
    assert [r.value for r in responses.decode_responses(df).collect()] == [1.5, 1.5]
    reasons = sorted(r.reason for r in responses.response_quarantine(df).collect())
    assert reasons == ["NaN value", "bad timestamp", "bad value", "no body", "no body", "no status", "no status", "unreadable body", "unreadable body"]
    out, bad = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "bad")
    jobs.decode_to_lines_job(df, out, bad)
    assert spark.read.text(out).count() == 2 and spark.read.parquet(bad).count() == 9
    # on the events: readings and quarantine together are every OK response and status
    ev = pipelines.event_responses(spark, SF_SMALL)
    whole = responses.classify_responses(ev)
    assert whole.count() == responses.decode_responses(ev).count() + responses.response_quarantine(ev).count()
    ok = ev.where("status_code = 200")
    assert whole.count() == ok.count() + whole.where("position = 2").count()


def test_dashboard_of_result_tables_equals_the_raw_form(spark):
    r = readings(spark, SF_SMALL)
    hist = pipelines.temperature_histogram(r, EVENTS)
    ext = pipelines.extremes(r, EVENTS)
    table = pipelines.streak_upserts(pipelines.temperature_streaks(r, EVENTS))
    assert pipelines.dashboard_of_tables(hist, ext, table, EVENTS).collect() == pipelines.dashboard(r, EVENTS).collect()


def test_with_device_id_and_kafka_shape(spark):
    from tidewatch.sinks.outputs import kafka_frame
    from tidewatch.sources.kafka import kafka_records
    r = cleaning.with_device_id(spark.createDataFrame([(1.0,)], "value double"), "dev-9").first()
    assert r.device_id == "dev-9"
    df = spark.createDataFrame([("a start", "t1", "k", "temperature_data")], "value string, to string, id string, dataset_id string")
    tagged = cleaning.tag_dataset_header(df)
    shaped = kafka_frame(tagged, topic_col="to", key_col="id", headers_col="headers")
    got = shaped.first()
    assert shaped.columns == ["value", "key", "topic", "headers"]
    assert (got.value, got.key, got.topic) == ("a start", "k", "t1")
    assert [(h.key, bytes(h.value)) for h in got.headers] == [("datasetId", b"temperature_data")]
    back = kafka_records(spark.createDataFrame([(bytearray(b"line"), "t", 0, 5, None, None)],
                                               "value binary, topic string, partition int, offset long, timestamp timestamp, "
                                               "headers array<struct<key:string,value:binary>>"))
    assert back.columns == ["value", "topic", "partition", "offset", "kafka_ts", "headers"] and back.first().value == "line"
