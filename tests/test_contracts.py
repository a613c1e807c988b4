from pyspark.sql import functions as F

from tests.helpers import REFERENCE, message, messages, relay_event, relays
from tidemark.operators import contracts
from tidemark.operators.aggregates import message_aggregates
from tidemark.streaming.touched import with_dependents


def violations(df):
    return {r.check: r.violations for r in df.collect()}


def test_violations_are_counted(spark):
    rows = messages(spark, [message("d", "m", s, 1) for s in (0, 200, 400)])
    good = message_aggregates(rows, "3m", REFERENCE)
    assert set(violations(contracts.aggregate_checks(good, "3m")).values()) == {0}
    bad = good.unionByName(good.withColumn("status", F.lit("late")))
    found = violations(contracts.aggregate_checks(bad, "15m"))
    assert found == {
        "status_domain": 3, "bucket_width": 6, "not_null": 0, "unique_topic_key": 3, "unique_series_key": 3,
    }


def test_relay_domain(spark):
    events = relays(spark, [relay_event("d", 0, "on"), relay_event("d", 1, "ajar"), relay_event("d", 2, "off", -1)])
    assert violations(contracts.relay_checks(events)) == {
        "state_domain": 1, "relay_index_domain": 1, "not_null": 0,
    }


def test_reject_rows_have_one_source(spark):
    rows = spark.createDataFrame([(1, None), (None, 2), (1, 2), (None, None)], "staged_message_id long, staged_topic_id long")
    assert violations(contracts.reject_checks(rows)) == {"one_source": 2}


def test_dependents_stop_at_the_nearest_sampled_bucket(spark):
    known = spark.createDataFrame(
        [("d", b, s) for b, s in ((1, True), (2, True), (3, False), (4, True), (5, False), (6, True), (7, True))],
        "k string, bucket_us long, sampled boolean",
    )
    touched = spark.createDataFrame([("d", 4)], "k string, bucket_us long")
    got = sorted(r.bucket_us for r in with_dependents(touched, known, ("k",)).collect())
    assert got == [2, 3, 4, 5, 6]
    touched = spark.createDataFrame([("d", 5)], "k string, bucket_us long")
    got = sorted(r.bucket_us for r in with_dependents(touched, known, ("k",)).collect())
    assert got == [4, 5, 6]


def test_batch_status_domain(spark):
    rows = spark.createDataFrame([("loaded",), ("lost",)], "status string")
    assert violations(contracts.batch_checks(rows)) == {"status_domain": 1}
