import json
from datetime import datetime, timezone

import pytest
from conftest import at
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paysieve import schemas
from paysieve.config import PipelineConfig
from paysieve.operators.cleaning import accepted, dedup, rejected, to_silver
from paysieve.plans import run_ingest
from paysieve.sources import read_landing, read_layer

GOOD = {
    "event_id": "1",
    "event_ts": "2024-01-01T00:00:07.179575",
    "payment_id": "p1",
    "user_id": "user_1",
    "merchant_id": "amazon",
    "amount": 12.5,
    "currency": "USD",
    "payment_method": "card",
    "ip_address": "192.168.1.1",
    "device_id": "device_1",
    "status": "captured",
}


def line(**changes):
    return json.dumps({**GOOD, **changes})


LINES = [
    line(extra="dropped"),
    line(),
    "not json",
    '{"event_id": "broken"',
    "",
    line(event_id="2", amount="abc"),
    line(event_id="3", amount="12.5"),
    line(event_id=4),
    line(event_id="5", event_ts="garbage"),
    json.dumps({"event_id": "6"}),
    line(event_id=None, payment_id="p7"),
]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "batch.json").write_text("\n".join(LINES) + "\n")
    return str(folder)


def test_scan(spark, landing):
    rows = read_landing(spark, landing)
    assert rows.schema == schemas.LANDING
    got = rows.collect()
    assert len(got) == 10
    assert sum(all(v is None for v in r) for r in got) == 2
    by_id = {r["event_id"]: r for r in got}
    assert by_id["1"]["amount"] == 12.5 and by_id["1"]["event_ts"] == GOOD["event_ts"]
    assert by_id["2"]["amount"] is None and by_id["2"]["user_id"] == "user_1"
    assert by_id["3"]["amount"] is None
    assert by_id["4"]["payment_id"] == "p1"
    assert by_id["5"]["event_ts"] == "garbage"
    assert by_id["6"]["amount"] is None


def test_scan_with_raw_text(spark, landing, tmp_path):
    rows = read_landing(spark, landing, keep_corrupt=True)
    assert rows.schema == schemas.LANDING_WITH_CORRUPT
    path = str(tmp_path / "bronze")
    rows.write.parquet(path)
    raw = {r[0] for r in read_layer(spark, path).select("_corrupt_record").collect() if r[0]}
    assert {"not json", '{"event_id": "broken"'} <= raw


def test_empty_and_missing_directories(spark, tmp_path):
    assert read_landing(spark, str(tmp_path)).count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_landing(spark, str(tmp_path / "absent"))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_silver(spark, landing, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        batch = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
        silver = to_silver(read_landing(spark, landing), batch_ts=batch)
        assert silver.schema.simpleString() == schemas.SILVER.simpleString()
        rows = {r["event_id"]: r for r in silver.withColumn("us", F.unix_micros("event_ts")).collect()}
        assert set(rows) == {"1", "2", "3", "4", "5", "6", None}
        assert rows["5"]["event_ts"] is None and rows["5"]["amount"] == 12.5
        assert rows["1"]["us"] == 1704067207179575
        assert silver.select(F.unix_seconds("ingest_ts")).distinct().first()[0] == batch.timestamp()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_silver_without_batch_time(spark, landing):
    assert to_silver(read_landing(spark, landing)).where("ingest_ts IS NULL").isEmpty()


ARRIVALS = [
    ("a", 5, "x"),
    ("a", 9, "late"),
    ("a", None, "no time"),
    ("b", 3, "z"),
    ("b", 3, "y"),
    (None, 1, "n1"),
    (None, 2, "n2"),
]


def arrivals(spark):
    return spark.createDataFrame([(k, at(s), v) for k, s, v in ARRIVALS], "event_id string, event_ts timestamp, v string")


def test_dedup_latest(spark):
    kept = {r["event_id"]: r["v"] for r in dedup(arrivals(spark)).collect()}
    assert kept == {"a": "late", "b": "y", None: "n2"}
    shuffled = {r["event_id"]: r["v"] for r in dedup(arrivals(spark).orderBy(F.rand(7)).repartition(5)).collect()}
    assert shuffled == kept


def test_dedup_any(spark):
    rows = dedup(arrivals(spark), keep="any").collect()
    assert sorted(str(r["event_id"]) for r in rows) == ["None", "a", "b"]
    assert {(r["event_id"], r["v"]) for r in rows} <= {(k, v) for k, _, v in ARRIVALS}
    with pytest.raises(ValueError):
        dedup(arrivals(spark), keep="first")


def test_dedup_cuts_copies_down_before_the_shuffle(spark):
    plan = dedup(arrivals(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    plan = dedup(arrivals(spark), keep="any")._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan


def test_quarantine_split(spark, landing, tmp_path):
    path = str(tmp_path / "bronze")
    read_landing(spark, landing, keep_corrupt=True).write.parquet(path)
    bronze = read_layer(spark, path)
    good, bad = accepted(bronze), rejected(bronze)
    assert good.count() + bad.count() == bronze.count()
    reasons = {r[0]: r[1] for r in bad.groupBy("reject_reason").count().collect()}
    # Two unreadable lines and two with a wrongly typed amount; one without id.
    assert reasons == {"MALFORMED": 4, "NO_EVENT_ID": 1}
    assert {r[0] for r in good.select("event_id").collect()} == {"1", "4", "5", "6"}


def ingest_config(tmp_path, landing, **extra):
    return PipelineConfig(landing=landing, bronze=str(tmp_path / "b"), silver=str(tmp_path / "s"), **extra)


def test_ingest_job(spark, landing, tmp_path):
    cfg = ingest_config(tmp_path, landing)
    assert run_ingest(spark, cfg)
    bronze = read_layer(spark, cfg.bronze)
    assert bronze.schema == schemas.LANDING and bronze.count() == 10
    silver = read_layer(spark, cfg.silver)
    assert silver.schema == schemas.SILVER and silver.count() == 7
    assert silver.select("ingest_ts").distinct().count() == 1


def test_ingest_job_with_quarantine(spark, landing, tmp_path):
    cfg = ingest_config(tmp_path, landing, bad_records="quarantine", quarantine=str(tmp_path / "q"))
    assert run_ingest(spark, cfg)
    silver = read_layer(spark, cfg.silver)
    assert silver.schema == schemas.SILVER and silver.count() == 4
    assert read_layer(spark, cfg.quarantine).count() == 5


@pytest.mark.parametrize("content", [None, "\n\n\n"])
def test_ingest_job_without_rows_writes_nothing(spark, tmp_path, content):
    folder = tmp_path / "landing"
    folder.mkdir()
    if content:
        (folder / "blank.json").write_text(content)
    cfg = ingest_config(tmp_path, str(folder))
    assert run_ingest(spark, cfg) is False
    assert not (tmp_path / "b").exists() and not (tmp_path / "s").exists()
