from datetime import datetime, timezone

import pytest
from conftest import at
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.config import RuleSettings
from paysieve.functions.rules import Rule, fraud_reason, high_amount, is_fraud, velocity
from paysieve.operators.blacklist import bloom_words, split_by_list, with_blacklist
from paysieve.operators.gold import serving_view, to_gold
from paysieve.operators.quality import silver_report

NAN = float("nan")


@pytest.mark.parametrize(
    "amount,count,reason",
    [
        (5000.0, 3, "NONE"),
        (5000.01, 3, "HIGH_AMOUNT"),
        (5000.0, 4, "VELOCITY"),
        (5000.01, 4, "HIGH_AMOUNT"),
        (None, 1, "NONE"),
        (None, 4, "VELOCITY"),
        (NAN, 1, "HIGH_AMOUNT"),
        (-1.0, 0, "NONE"),
    ],
)
def test_reason_and_flag(spark, amount, count, reason):
    df = spark.createDataFrame([(amount, count)], "amount double, tx_count_window bigint")
    row = df.withColumn("fraud_reason", fraud_reason()).withColumn("is_fraud", is_fraud()).first()
    assert (row["fraud_reason"], row["is_fraud"]) == (reason, reason != "NONE")


def test_predicates_with_other_limits(spark):
    df = spark.createDataFrame([(10.0, 2)], "amount double, tx_count_window bigint")
    got = df.select(high_amount(9.99), high_amount(10), velocity(1), velocity(2)).first()
    assert tuple(got) == (True, False, True, False)


def test_rule_list_order_decides(spark):
    df = spark.createDataFrame([("failed", 9000.0)], "status string, amount double")
    failed = Rule("FAILED", F.col("status") == "failed")
    high = Rule("HIGH_AMOUNT", high_amount())
    got = df.select(fraud_reason([failed, high]), fraud_reason([high, failed]), fraud_reason([])).first()
    assert tuple(got) == ("FAILED", "HIGH_AMOUNT", "NONE")


def test_gold_layer(spark, payments):
    batch = datetime(2024, 5, 1, tzinfo=timezone.utc)
    silver = payments.withColumn("ingest_ts", F.lit(batch))
    gold = to_gold(silver, batch_ts=batch)
    assert [(f.name, f.dataType) for f in gold.schema] == [(f.name, f.dataType) for f in schemas.GOLD]
    counted = {r[0]: r[1] for r in gold.groupBy("fraud_reason").count().collect()}
    assert counted == {"HIGH_AMOUNT": 389, "VELOCITY": 250, "NONE": 361}
    assert gold.select("gold_ts").distinct().count() == 1
    assert serving_view(gold).columns == schemas.GOLD_SERVING_COLUMNS


def test_gold_with_other_settings(spark, payments):
    gold = to_gold(payments, RuleSettings(amount_limit=1e9, velocity_limit=0, velocity_seconds=0))
    assert {r[0] for r in gold.select("fraud_reason").distinct().collect()} == {"VELOCITY"}


BLACKLIST = [
    ("u1", "old", "LOW", at(1)),
    ("u1", "new", "HIGH", at(2)),
    ("u3", "other", "LOW", None),
    (None, "nobody", "LOW", at(1)),
]


@pytest.mark.parametrize("options", [{}, {"max_broadcast_bytes": 1}])
def test_blacklist(spark, options):
    users = ["u1"] * 5 + ["u2"] * 5 + ["u3"] + [None] * 4
    df = spark.createDataFrame([(str(i), u) for i, u in enumerate(users)], "event_id string, user_id string")
    listed = spark.createDataFrame(BLACKLIST, schemas.BLACKLIST)
    result = with_blacklist(df, listed, **options)
    assert result.columns == ["event_id", "user_id", "blacklist_reason", "blacklist_severity", "is_blacklisted"]
    got = {}
    for r in result.collect():
        got.setdefault(r["user_id"], []).append((r["blacklist_reason"], r["blacklist_severity"], r["is_blacklisted"]))
    assert got == {
        "u1": [("new", "HIGH", True)] * 5,
        "u2": [(None, None, False)] * 5,
        "u3": [("other", "LOW", True)],
        None: [(None, None, False)] * 4,
    }


def test_a_long_list_lets_few_rows_through(spark):
    """What is shuffled: the rows of listed users, and few of the others'."""
    payments = spark.range(20_000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 50 != 7, F.concat(F.lit("u"), F.col("id") % 10_000)).alias("user_id"))
    listed = spark.range(0, 10_000, 20).select(F.concat(F.lit("u"), F.col("id")).alias("__user"))
    maybe, ruled_out = split_by_list(payments, listed, 500)
    wanted = payments.join(listed, F.col("user_id") == F.col("__user"), "left_semi")
    assert maybe.count() + ruled_out.count() == 20_000 and wanted.join(ruled_out, "event_id").isEmpty()
    assert wanted.count() == 1000 <= maybe.count() < 1000 + 200
    assert ruled_out.where("user_id IS NULL").count() == 400
    # a filter that is far too small lets all rows through, and loses none
    assert wanted.join(split_by_list(payments, listed, 1)[1], "event_id").isEmpty()


def test_filters_are_bounded():
    assert [bloom_words(n) for n in (0, 1, 4, 5, 1000, 10**9)] == [1, 1, 1, 2, 256, 1 << 20]


def test_quality_report(spark):
    rows = [
        ("1", "u", at(1), 5.0, "captured"),
        ("1", "u", at(1), 5.0, "captured"),
        ("1", None, None, -5.0, "failed"),
        (None, "u", at(1), None, "lost"),
        (None, "u", at(1), NAN, None),
        ("2", "u", at(1), 0.0, "refunded"),
    ]
    df = spark.createDataFrame(
        rows, "event_id string, user_id string, event_ts timestamp, amount double, status string"
    )
    assert silver_report(df).first().asDict() == {
        "n_rows": 6,
        "null_event_id": 2,
        "repeated_event_id": 2,
        "null_user_id": 1,
        "null_event_ts": 1,
        "null_amount": 2,
        "negative_amount": 1,
        "zero_amount": 1,
        "unknown_status": 2,
    }
    assert set(silver_report(df.limit(0)).first()) == {0}
