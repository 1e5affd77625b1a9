import random

import pytest
from conftest import at, same_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysieve.fixtures import with_busy_user
from paysieve.operators.velocity import Placement, crowded_cells, per_second, with_velocity

SCHEMA = "id string, user_id string, event_ts timestamp"
METHODS = ("auto", "bucketed", "linear")
# Nothing hot, some keys hot, every key hot.
SPREADS = (
    {},
    {"hot_rows": 3},
    {"hot_rows": 3, "cells": 8},
    {"hot_rows": 0},
    {"hot_rows": 1, "cells": 1},
)


def frame(spark, rows):
    return spark.createDataFrame([(i, u, at(s)) for i, u, s in rows], SCHEMA)


def counts(df, seconds=60, **options):
    return {r["id"]: r["tx_count_window"] for r in with_velocity(df, seconds, **options).collect()}


def brute_force(rows, seconds):
    def floor(s):
        return None if s is None else s // 1

    def seen(own, other):
        if own is None or other is None:
            return own is other
        return own - seconds <= other <= own

    return {i: sum(u == v and seen(floor(s), floor(t)) for _, v, t in rows) for i, u, s in rows}


def over_raw_rows(df, seconds):
    """The window over the raw rows, one task per user."""
    frame = f"PARTITION BY user_id ORDER BY unix_seconds(event_ts) RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW"
    return df.selectExpr("*", f"count(1) OVER ({frame}) AS tx_count_window")


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("spread", SPREADS)
def test_frame_semantics(spark, method, spread):
    rows = [
        ("a", "u1", 0),
        ("b", "u1", 60),
        ("c", "u1", 60.9),
        ("d", "u1", 61),
        ("e", "u1", None),
        ("f", "u1", None),
        ("g", None, 0),
        ("h", None, 5),
    ]
    expected = {"a": 1, "b": 3, "c": 3, "d": 3, "e": 2, "f": 2, "g": 1, "h": 2}
    assert counts(frame(spark, rows), method=method, **spread) == expected
    assert brute_force(rows, 60) == expected


@pytest.mark.parametrize("method", METHODS)
def test_bucket_edges_and_times_before_the_epoch(spark, method):
    seconds = [-7201, -7200, -3661, -3660, -3601, -3600, -3541, -61, -60, -1, 0, 59, 3539, 3540, 3599, 3600, 3660, 3661]
    rows = [(str(i), "u", s) for i, s in enumerate(seconds)]
    for width in (0, 1, 60, 3600, 5000):
        assert counts(frame(spark, rows), width, method=method) == brute_force(rows, width)


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("seconds", (0, 60, 900, 7200))
@pytest.mark.parametrize("spread", SPREADS)
def test_agrees_with_window_over_raw_rows(spark, payments, method, seconds, spread):
    busy = with_busy_user(payments)
    assert same_rows(with_velocity(busy, seconds, method=method, **spread), over_raw_rows(busy, seconds))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["u", "v", None]),
            st.one_of(st.none(), st.floats(-5000, 5000).map(lambda x: round(x, 3))),
        ),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([0, 1, 60, 4000]),
)
def test_random_rows(spark, pairs, seconds):
    rows = [(str(i), u, s) for i, (u, s) in enumerate(pairs)]
    df = frame(spark, rows)
    for method in METHODS:
        assert counts(df, seconds, method=method, hot_rows=1) == brute_force(rows, seconds)


@pytest.mark.parametrize("method", METHODS)
def test_exact_copies_are_all_kept(spark, method):
    row = ("same", "u", 10)
    df = frame(spark, [row] * 500 + [("other", "u", 11)]).repartition(8)
    result = with_velocity(df, method=method, hot_rows=100)
    got = result.groupBy("id", "tx_count_window").count().collect()
    assert {tuple(r) for r in got} == {("same", 500, 500), ("other", 501, 1)}


def test_hot_rows_are_spread_over_tasks(spark):
    """Copies of one row must not meet in one partition of the window."""
    rows = spark.range(0, 8000, 1, 8).select(
        F.lit("x").alias("id"), F.lit("u").alias("user_id"), F.timestamp_seconds(F.lit(7)).alias("event_ts")
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        result = with_velocity(rows, hot_rows=1000)
        sizes = [r["count"] for r in result.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and len(sizes) >= 3 and max(sizes) < 8000 / 2
        assert result.select("tx_count_window").distinct().collect()[0][0] == 8000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def placed(rows, seconds, hot_rows):
    narrow = rows.select("user_id", F.col("event_ts").cast("long").alias("__second"))
    limit, crowded = crowded_cells(narrow, "user_id", hot_rows=hot_rows)
    return Placement(narrow, "user_id", seconds, limit, 1 << 16, crowded), rows.withColumn("__second", F.col("event_ts").cast("long"))


def test_no_group_is_above_its_bound(spark):
    """A third of the rows in one second, the busy user's rows in one input partition, in order of time."""
    rows = spark.range(0, 30_000, 1, 1).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 20_000, F.lit("busy")).otherwise(F.concat(F.lit("u"), F.col("id") % 100)).alias("user_id"),
        F.timestamp_seconds(F.when(F.col("id") < 10_000, 5000).otherwise(F.col("id") % 7000)).alias("event_ts"),
    )
    place, rows = placed(rows, 60, hot_rows=1000)
    assert len(place.crowded) == 1 and place.limit == 1000
    key = ["user_id", "__bucket", "__piece", "__salt"]
    own = place.own(rows, rows.columns).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    assert own.agg(F.sum("n")).first()[0] == 30_000
    assert own.agg(F.max("n")).first()[0] <= 2000
    # a piece's own seconds and the 60 before it
    assert place.numbers().groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] <= 3600 + 60


def test_without_a_busy_user_it_is_the_plain_window(spark, payments):
    plan = with_velocity(payments)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan


def test_columns_and_rows_are_kept(spark, payments):
    result = with_velocity(payments)
    assert result.columns == [*payments.columns, "tx_count_window"]
    assert result.count() == payments.count()
    assert dict(result.dtypes)["tx_count_window"] == "bigint"
    again = with_velocity(result, 600)
    assert again.columns == result.columns


def test_per_second_is_one_row_per_key(spark):
    random.seed(3)
    rows = [(str(i), random.choice("ab"), random.randrange(5)) for i in range(200)]
    table = per_second(frame(spark, rows))
    assert table.count() == table.select("user", "second").distinct().count() == 10
    assert table.agg(F.sum("n")).first()[0] == 200


def test_bad_arguments(spark, payments):
    with pytest.raises(ValueError):
        with_velocity(payments, method="other")
    with pytest.raises(ValueError):
        with_velocity(payments, -1)
