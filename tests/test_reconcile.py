from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixture as fx
from tests.helpers import REFERENCE, message, messages, one, relay_event, relays
from tests.test_aggregates import same
from tidemark import schemas
from tidemark.operators.aggregates import RefreshWindow
from tidemark.operators.reconcile import (
    outside_context,
    power_energy_reconciliation,
    reconciliation_by_width,
    signal_rows,
)

POWER = [(s, 10) for s in (-60, 0, 60, 120, 180)]
ENERGY = [(0, 0), (60, 600), (180, 1800)]


def run(spark, power=POWER, energy=ENERGY, events=(), topic=None, device="d"):
    rows = [message(device, "power", s, v, topic=topic) for s, v in power]
    rows += [message(device, "energy", s, v) for s, v in energy]
    return power_energy_reconciliation(
        messages(spark, rows), relays(spark, [relay_event("d", *e) for e in events]), "3m", REFERENCE
    )


def test_balanced(spark):
    r = one(run(spark))
    assert (r.power_locf_integral_ws, r.energy_locf_delta_ws) == (1800.0, 1800.0)
    assert (r.drift_locf_signed_ws, r.drift_locf_pct, r.drift_linear_pct) == (0.0, 0.0, 0.0)
    assert (r.relay_on_seconds, r.relay_on_pct, r.relay_event_count, r.relay_state_known) == (180.0, 100.0, 0, True)


def test_flat_counter_has_no_relative_drift(spark):
    r = one(run(spark, energy=[(0, 5), (60, 5), (180, 5)]))
    assert (r.drift_locf_signed_ws, r.drift_locf_pct) == (1800.0, None)


def test_power_only(spark):
    r = one(run(spark, energy=[(-500, 1), (900, 2)]))
    assert r.energy_numeric_count is None and r.energy_locf_value_at_bucket_start is None
    assert r.drift_locf_signed_ws is None and r.power_numeric_count == 3


@pytest.mark.parametrize(
    "events, on, count",
    [
        ([(60, "off"), (120, "on")], 120.0, 2),
        ([(0, "off")], 0.0, 1),
        ([(180, "off")], 180.0, 0),
        ([(-1000, "off")], 0.0, 0),
        ([(60, "off", 1)], 180.0, 0),
        ([(60, "on", 0, 0), (60, "off", 0, 5)], 60.0, 2),
    ],
)
def test_relay_coverage(spark, events, on, count):
    r = one(run(spark, events=events))
    assert (r.relay_on_seconds, r.relay_event_count) == (on, count)
    assert r.relay_on_seconds + r.relay_off_seconds == 180.0


def test_mixed_topics_are_one_series(spark):
    rows = [
        message("d", "power", 0, 1), message("d", "power", 60, 2, topic="shellies/d/relay/0/power"),
    ]
    r = one(power_energy_reconciliation(messages(spark, rows), relays(spark, []), "3m", REFERENCE))
    assert (r.power_topic, r.power_numeric_count) == ("sensors/d/power", 2)


def test_other_topics_open_no_bucket(spark):
    assert run(spark, energy=[], topic="other/d/power").count() == 0


def test_widths_from_one_pass_equal_each_alone(spark, sf):
    stored, relay, now = fx.messages(spark, sf), fx.relay(spark, sf), "2024-01-20 11:31:00"
    windows = {w: RefreshWindow.resolve(w, now) for w in schemas.WIDTHS}
    day = windows["24h"]
    rows = signal_rows(stored.where(day.inside("received_at")), relay.where(day.inside("event_at")))
    contexts = [
        outside_context(
            signal_rows(stored.where(x.outside("received_at")), relay.where(x.outside("event_at"))), x
        ).withColumn("width_us", F.lit(x.width_us))
        for x in windows.values()
    ]
    found = reconciliation_by_width(rows, windows, reduce(DataFrame.unionByName, contexts)).cache()
    for width, window in windows.items():
        alone = power_energy_reconciliation(stored, relay, width, now)
        same(alone, found.where(F.col("width_us") == window.width_us), ["bucket_start", "device_id"])


def test_daily_integral_is_the_sum_of_its_parts(spark):
    power = [(s, (s // 37) % 11) for s in range(-120, 86400 + 240, 97)]
    rows = messages(spark, [message("d", "power", s - 12 * 3600, v) for s, v in power])
    none = relays(spark, [])
    day, parts = (
        power_energy_reconciliation(rows, none, w, "2024-03-05 00:00:00").collect() for w in ("24h", "3m")
    )
    whole = [r for r in day if r.bucket_start.day == 1][0]
    inside = [r for r in parts if r.bucket_start.day == 1]
    assert len(inside) == 480
    for column in ("power_locf_integral_ws", "power_linear_integral_ws"):
        assert whole[column] == pytest.approx(sum(r[column] for r in inside), rel=1e-9)
