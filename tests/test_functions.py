import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import brute_bin

from tidewatch.functions import (assign_bin, bin_edges, contains_any, contains_none, format_winstart,
                                 route_topic, substring_after, to_line)
from tidewatch.functions.noise import hash_gaussian, hash_uniform


def test_bin_edges_default():
    e = bin_edges()
    assert len(e) == 20 and e[0] == 25.5 and e[-1] == 35.0 and e[1] - e[0] == 0.5


def test_assign_bin_golden(spark):
    # FIXTURES G3
    vals = [-1e9, 25.5, 25.500000001, 30.1, 35.0, 35.01, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "value double")
    got = [r.b for r in df.select(assign_bin("value").alias("b")).collect()]
    assert got == [25.5, 25.5, 26.0, 30.5, 35.0, 35.0, 35.0, None]


def test_assign_bin_custom_params(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.01,), (195.0,), (1e6,)], "value double")
    got = [r.b for r in df.select(assign_bin("value", 10.0, 10.0, 20).alias("b")).collect()]
    assert got == [10.0, 10.0, 20.0, 200.0, 200.0]


def test_substring_after(spark):
    rows = [("HTTP 200 body={\"a\":1}",), ("no marker here",), (None,), ("body=",), ("x body=1 body=2",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.s for r in df.select(substring_after("t", "body=").alias("s")).collect()]
    assert got == ['{"a":1}', "", None, "", "1 body=2"]


def test_to_line_prints_null(spark):
    df = spark.createDataFrame([("d", None, 5, 1.5)], "a string, b string, c long, d double")
    assert df.select(to_line("a", "b", "c", "d").alias("l")).first().l == "d,null,5,1.5"


def test_contains_filters(spark):
    df = spark.createDataFrame([("x,AQQA",), ("temperature_data",), ("humidity_data,AAIA",), ("other",)], "v string")
    keep = df.where(contains_none("v", ["AAIA", "AQQA"]) & contains_any("v", ["temperature_data", "humidity_data"]))
    assert [r.v for r in keep.collect()] == ["temperature_data"]


def test_route_topic(spark):
    df = spark.createDataFrame([("app start",), ("event",)], "b string")
    assert [r.t for r in df.select(route_topic("b").alias("t")).collect()] == ["topic_start", "topic_event"]


def test_format_winstart(spark):
    df = spark.createDataFrame([(1648607410000,)], "ms long")
    out = df.select(format_winstart(F.timestamp_millis("ms")).alias("f")).first().f
    assert out == "2022-03-30:02:30:10"


def test_hashed_noise_is_reproducible_and_distributed(spark):
    df = spark.range(20000).select(F.col("id"))
    a = df.select("id", hash_uniform("id").alias("u"), hash_gaussian("id").alias("g"))
    b = df.select("id", hash_uniform("id").alias("u"), hash_gaussian("id").alias("g")).repartition(7)
    ra = {r.id: (r.u, r.g) for r in a.collect()}
    rb = {r.id: (r.u, r.g) for r in b.collect()}
    assert ra == rb
    us = [v[0] for v in ra.values()]
    gs = [v[1] for v in ra.values()]
    assert 0.0 <= min(us) and max(us) < 1.0
    assert abs(sum(us) / len(us) - 0.5) < 0.02
    mean = sum(gs) / len(gs)
    sd = math.sqrt(sum((g - mean) ** 2 for g in gs) / len(gs))
    assert abs(mean) < 0.05 and abs(sd - 1.0) < 0.05


@settings(max_examples=25, deadline=None)
@given(
    values=st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=True, width=64),
                              st.integers(-40, 60).map(lambda i: 25.5 + i * 0.1),
                              st.integers(-5, 25).map(lambda i: 25.5 + i * 0.5)), min_size=1, max_size=30),
    params=st.sampled_from([(25.5, 0.5, 20), (10.0, 10.0, 20), (25.5, 0.1, 37), (-3.0, 0.3, 11), (0.0, 1e-3, 5)]),
)
def test_assign_bin_is_smallest_edge_at_or_above(spark, values, params):
    start, step, count = params
    df = spark.createDataFrame([(float(v),) for v in values], "value double")
    got = [r.b for r in df.select(assign_bin("value", start, step, count).alias("b")).collect()]
    assert got == [brute_bin(v, start, step, count) for v in values]
