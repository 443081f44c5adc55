import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import brute_changelog, brute_streaks
from tidewatch.functions.timefmt import ms_to_ts
from tidewatch.operators import cleaning, dedup, histogram, responses, serving, streaks, windows

G1 = [
    "dev-1,sensor_data,1648606918090,AQQA",
    "dev-1,humidity_data,1648607463508,42.0",
    "dev-1,temperature_data,1648607463508,30.100000381469727",
    "dev-1,sensor_data,1648606918090,AQQA",
    "dev-1,humidity_data,1648607465903,42.0",
    "dev-1,temperature_data,1648607465903,30.100000381469727",
]
BAD = ["dev-1,temperature_data,xx,30.0", "dev-1,temperature_data,1648607465903",
       "dev-1,temperature_data,1648607465903,NaN"]


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def readings_df(spark, rows):
    """rows: (device, dataset, ts_ms, value[, seq])"""
    full = [(d, ds, t, v, i if len(r) == 4 else r[4]) for i, r in enumerate(rows) for d, ds, t, v in [r[:4]]]
    df = spark.createDataFrame(full, "device_id string, dataset_id string, ts_ms long, value double, seq long")
    return df.withColumn("ts", ms_to_ts("ts_ms"))


def test_g1_parse_and_quarantine(spark):
    df = lines(spark, G1 + BAD)
    got = cleaning.lines_to_readings(df).collect()
    assert len(got) == 4
    assert sorted({r.dataset_id for r in got}) == ["humidity_data", "temperature_data"]
    assert {r.ts_ms for r in got} == {1648607463508, 1648607465903}
    q = cleaning.quarantine_lines(cleaning.keep_lines_containing(cleaning.drop_lines_containing(df))).collect()
    assert sorted(r.reason for r in q) == ["NaN value", "bad timestamp", "too few fields"]


def test_only_dataset_and_noise(spark):
    r = cleaning.lines_to_readings(lines(spark, G1))
    temp = cleaning.only_dataset(r, "temperature_data")
    assert temp.count() == 2
    noisy = cleaning.add_noise(temp, "gaussian").collect()
    noisy2 = cleaning.add_noise(temp, "gaussian").collect()
    assert [x.value for x in noisy] == [x.value for x in noisy2]
    assert all(x.value != 30.100000381469727 for x in noisy)
    assert cleaning.add_noise(temp, "none").collect() == temp.collect()


G4 = [(0, 1.0), (1, 2.0), (2, 3.0), (3, 3.0), (4, 4.0), (5, 5.0), (6, 6.0), (7, 2.0)]


@pytest.mark.parametrize("slices", [1, 2, 3, 5, 16])
def test_g4_streaks_any_slicing(spark, slices):
    rows = [("a", "temperature_data", t, v) for t, v in G4]
    # second device interleaved must not disturb the first
    rows += [("b", "temperature_data", t, 10.0 - v) for t, v in G4]
    alerts = streaks.rising_streaks(readings_df(spark, rows), 3, slices=slices)
    got = sorted((r.device_id, r.start_ms, r.counts) for r in alerts.collect())
    assert [g for g in got if g[0] == "a"] == [("a", 0, 3), ("a", 3, 3), ("a", 3, 4)]
    table = sorted((r.device_id, r.start_ms, r.counts) for r in streaks.streak_table(alerts).collect()
                   if r.device_id == "a")
    assert table == [("a", 0, 3), ("a", 3, 4)]
    latest = serving.latest_streak(streaks.streak_table(alerts).where("device_id = 'a'")).first()
    assert (latest.start_ms, latest.counts) == (3, 4)


@settings(max_examples=15, deadline=None)
@given(
    data=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.integers(0, 5)), min_size=1, max_size=60),
    slices=st.sampled_from([1, 3, 7, 16]),
    limit=st.integers(1, 4),
)
def test_streaks_match_brute_force(spark, data, slices, limit):
    rows = [(f"d{d}", "temperature_data", t, float(v), i) for i, (d, t, v) in enumerate(data)]
    got = sorted(tuple(r) for r in streaks.rising_streaks(readings_df(spark, rows), limit, slices=slices)
                 .select("device_id", "start_ms", "counts", "ts_ms").collect())
    want = brute_streaks([(d, t, s, v) for d, _, t, v, s in rows], limit)
    assert got == want


@pytest.mark.parametrize("slices", [1, 4, 16])
def test_histogram_changelog_matches_brute_force(spark, slices):
    rnd = random.Random(7)
    rows = [("d", "temperature_data", rnd.randint(0, 30), rnd.uniform(24, 37)) for _ in range(200)]
    df = readings_df(spark, rows)
    got = sorted((r.seq, r.bin, r.cnt) for r in histogram.histogram_changelog(df, slices=slices).collect())
    want = brute_changelog([(i, t, v) for i, (_, _, t, v) in enumerate(rows)], 25.5, 0.5, 20)
    assert got == want
    final = {r.bin: r.cnt for r in histogram.histogram(df).collect()}
    last = {}
    for _, b, c in want:
        last[b] = max(last.get(b, 0), c)
    assert final == last


def test_drop_repeated_polls_keeps_first_arrival(spark):
    rows = [
        ("d", "humidity_data", 1000, 42.0, 5), ("d", "humidity_data", 1000, 42.0, 9),
        ("d", "temperature_data", 1000, 30.1, 6),   # same ts, other dataset: kept
        ("d", "humidity_data", 2000, 41.0, 7), ("d", "humidity_data", 2000, 43.0, 3),
    ]
    df = readings_df(spark, rows)
    got = sorted((r.dataset_id, r.ts_ms, r.value, r.seq) for r in dedup.drop_repeated_polls(df).collect())
    assert got == [("humidity_data", 1000, 42.0, 5), ("humidity_data", 2000, 43.0, 3),
                   ("temperature_data", 1000, 30.1, 6)]
    assert dedup.distinct_readings(df).count() == 3


def test_salted_equals_unsalted(spark):
    rnd = random.Random(3)
    rows = [("d", rnd.choice(["a", "b"]), rnd.randint(0, 600_000), rnd.uniform(-5, 5)) for _ in range(500)]
    df = readings_df(spark, rows)
    a = sorted(tuple(r) for r in windows.sliding_extremes(df).collect())
    # independent of the pane code: the direct F.window form
    assert sorted(tuple(r) for r in windows.sliding_extremes(df, panes=False).collect()) == a
    for n in (1, 3, 16):
        assert sorted(tuple(r) for r in windows.salted_extremes(df, n).collect()) == a


def test_sliding_windows_count_and_bounds(spark):
    df = readings_df(spark, [("d", "x", 65_000, -3.0), ("d", "x", 66_000, -1.0)])
    out = windows.sliding_extremes(df).orderBy("win_start").collect()
    assert len(out) == 6
    for r in out:
        assert r.win_start.timestamp() * 1000 <= 65_000 < r.win_end.timestamp() * 1000
    # true max of negative values (no positive floor)
    assert all(r.max_value == -1.0 and r.min_value == -3.0 and r.n == 2 for r in out)


def test_g6_decode(spark):
    body = ('{"code":"0","desc":"ok","deviceStatusList":[{"value":"42.0","timestamp":"1648607463508",'
            '"datasetId":"humidity_data"}]}')
    rows = [("dev-1", 200, "HTTP 200 body=" + body), ("dev-1", 200, "HTTP 200 nothing"),
            ("dev-1", 500, "HTTP 500 body=" + body)]
    df = spark.createDataFrame(rows, "device_id string, status_code int, resp string")
    got = [(r.device_id, r.dataset_id, r.ts_ms, r.value) for r in responses.decode_responses(df).collect()]
    assert got == [("dev-1", "humidity_data", 1648607463508, 42.0)]
    q = responses.response_quarantine(df).collect()
    assert [r.resp for r in q] == ["HTTP 200 nothing"]


def test_to_lines_round_trip(spark):
    r = cleaning.lines_to_readings(lines(spark, G1))
    back = cleaning.lines_to_readings(cleaning.to_lines(r))
    assert sorted(tuple(x) for x in back.drop("seq").collect()) == sorted(tuple(x) for x in r.drop("seq").collect())


def test_tag_header(spark):
    r = cleaning.lines_to_readings(lines(spark, G1))
    h = cleaning.tag_dataset_header(r).select(F.col("headers")[0]["key"].alias("k"),
                                              F.col("headers")[0]["value"].cast("string").alias("v")).collect()
    assert {(x.k, x.v) for x in h} == {("datasetId", "humidity_data"), ("datasetId", "temperature_data")}


def test_serving_queries(spark):
    rnd = random.Random(11)
    rows = [("d", rnd.choice(["temperature_data", "humidity_data"]), rnd.randint(0, 300_000), rnd.uniform(25, 36))
            for _ in range(300)]
    df = readings_df(spark, rows)
    ext = windows.sliding_extremes(df)
    lw = serving.latest_windows(ext, 5).collect()
    for ds in ("temperature_data", "humidity_data"):
        mine = sorted([r for r in lw if r.dataset_id == ds], key=lambda r: r.rn)
        all_ds = sorted([r for r in ext.collect() if r.dataset_id == ds], key=lambda r: r.win_start, reverse=True)[:5]
        assert [r.win_start for r in mine] == [r.win_start for r in all_ds]
    hist = histogram.histogram(cleaning.only_dataset(df, "temperature_data"))
    oh = serving.ordered_histogram(hist).collect()
    assert [r.bin for r in oh] == sorted(r.bin for r in hist.collect())
    assert [r.pos for r in oh] == list(range(1, len(oh) + 1))
    al = streaks.streak_table(streaks.rising_streaks(cleaning.only_dataset(df, "temperature_data"), 2))
    snap = serving.dashboard_snapshot(hist, ext, al).first()
    assert snap.tempinterval == [r.bin for r in oh]
    assert len(snap.tempwinstart) == 5 and len(snap.humivalues) == 5
    payload = serving.dashboard_json(serving.dashboard_snapshot(hist, ext, al)).first().payload
    assert '"tempinterval"' in payload and '"humiwinstart"' in payload
    side = serving.temp_humi_by_window(ext).collect()
    assert len(side) == ext.select("win_start").distinct().count()


@settings(max_examples=6, deadline=None)
@given(
    data=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-200_000, 200_000), st.integers(-5, 5)),
                  min_size=1, max_size=40),
    size_slide=st.sampled_from([(60, 10), (25, 10), (30, 30), (7, 3), (3600, 600)]),
    ntz=st.booleans(),
)
def test_pane_windows_equal_direct_windows(spark, data, size_slide, ntz):
    size, slide = (f"{size_slide[0]} seconds", f"{size_slide[1]} seconds")
    rows = [("d", ds, t, float(v), i) for i, (ds, t, v) in enumerate(data)]
    df = readings_df(spark, [(d, ds, t * 37, v) for d, ds, t, v, _ in rows])
    if ntz:
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    pane = windows.sliding_extremes(df, size, slide, panes=True)
    direct = windows.sliding_extremes(df, size, slide, panes=False)
    assert [(f.name, f.dataType) for f in pane.schema] == [(f.name, f.dataType) for f in direct.schema]
    assert sorted(tuple(r) for r in pane.collect()) == sorted(tuple(r) for r in direct.collect())


def test_with_device_id_and_with_bin(spark):
    df = spark.createDataFrame([("humidity_data", 30.1), ("humidity_data", None)], "dataset_id string, value double")
    out = histogram.with_bin(cleaning.with_device_id(df, "dev-1")).collect()
    assert [(r.device_id, r.bin) for r in out] == [("dev-1", 30.5), ("dev-1", None)]
    from_col = cleaning.with_device_id(df, F.concat(F.lit("d-"), F.col("dataset_id"))).first()
    assert from_col.device_id == "d-humidity_data"
