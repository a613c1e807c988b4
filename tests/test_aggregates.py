from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixture as fx
from tests.helpers import REFERENCE, at, message, messages, one
from tidemark import schemas
from tidemark.functions import scores
from tidemark.operators import percentiles
from tidemark.operators.aggregates import (
    RefreshWindow,
    bucket_rows,
    fold,
    message_aggregates,
    message_aggregates_by_width,
    outside_context,
    series_rows,
)

FIXTURES = {
    "constant": [(-60, 5), (0, 5), (60, 5), (120, 5), (180, 5)],
    "ramp": [(-90, 0), (90, 180), (270, 360)],
    "exact_hits": [(0, 1), (180, 9)],
    "no_before": [(30, 1), (90, 2), (200, 3)],
    "no_after": [(-30, 1), (30, 2)],
    "single": [(-30, 1), (60, 2), (240, 3)],
    "text_only": [(-30, 1), (60, None), (240, 3)],
    "duplicates": [(-30, 0), (60, 1), (60, 3), (240, 0)],
}


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        message(name, "m", s, v, committed=i)
        for name, samples in FIXTURES.items()
        for i, (s, v) in enumerate(samples)
    ]
    out = message_aggregates(messages(spark, data), "3m", REFERENCE).cache()
    return {name: one(out, device_id=name) for name in FIXTURES}


def test_constant(rows):
    r = rows["constant"]
    for c in (
        "numeric_avg locf_value_at_bucket_start locf_value_at_bucket_end locf_time_weighted_avg "
        "linear_value_at_bucket_start linear_value_at_bucket_end linear_time_weighted_avg"
    ).split():
        assert r[c] == 5.0, c
    assert (r.interval_gap_count, r.interval_gap_avg_seconds, r.interval_gap_cv) == (3, 60.0, 0.0)
    assert r.quality_interval_score == 10.0 and r.quality_boundary_score == 10.0


def test_ramp(rows):
    r = rows["ramp"]
    assert (r.linear_value_at_bucket_start, r.linear_value_at_bucket_end) == (90.0, 270.0)
    assert (r.linear_time_weighted_avg, r.locf_time_weighted_avg) == (180.0, 90.0)


def test_exact_hits(rows):
    r = rows["exact_hits"]
    assert (r.locf_time_weighted_avg, r.locf_value_at_bucket_end, r.linear_time_weighted_avg) == (1.0, 9.0, 5.0)


def test_missing_support(rows):
    r = rows["no_before"]
    assert r.locf_time_weighted_avg is None and r.linear_time_weighted_avg is None
    assert r.quality_flags[:2] == ["missing_locf_start", "missing_linear_start"]
    r = rows["no_after"]
    assert r.locf_value_at_bucket_end is None and r.locf_time_weighted_avg is None
    assert r.quality_flags[:2] == ["missing_locf_end", "missing_linear_end"]


def test_single(rows):
    r = rows["single"]
    assert r.numeric_count == 1 and r.numeric_variance_samp is None and r.numeric_ci95_lower is None
    assert r.quality_stats_score == 1.0
    assert r.quality_flags[:2] == ["low_numeric_count", "single_numeric_sample"]


def test_text_only(rows):
    r = rows["text_only"]
    assert (r.sample_count, r.numeric_count) == (1, 0)
    assert r.linear_value_at_bucket_start is not None and r.locf_time_weighted_avg is None
    assert (r.interval_gap_count, r.interval_gap_avg_seconds, r.interval_gap_cv) == (1, 180.0, None)


def test_duplicates(rows):
    r = rows["duplicates"]
    # Both count; the first committed one is weighted.
    assert (r.numeric_count, r.numeric_avg, r.locf_time_weighted_avg) == (2, 2.0, 120 / 180)
    assert r.interval_gap_count == 2


def test_open_bucket(spark):
    data = [message("d", "m", s, 5) for s in (-60, 0, 60)]
    r = one(message_aggregates(messages(spark, data), "3m", at(100)))
    assert (r.status, r.quality_status, r.quality_score, r.quality_flags) == ("tba", "provisional", None, None)


def test_cut_inside_a_bucket(spark):
    """Without an upper bound rows after the next minute are not counted, but
    still weigh in."""
    data = [message("d", "m", s, v) for s, v in ((0, 1), (30, 2), (170, 7), (200, 9))]
    r = one(message_aggregates(messages(spark, data), "3m", at(70)))
    assert (r.sample_count, r.numeric_max, r.locf_value_at_bucket_end) == (2, 2.0, 7.0)


@pytest.mark.parametrize(
    "sql, column, steps, below",
    [
        (scores.count_score(), "numeric_count", scores.COUNT_STEPS, True),
        (scores.interval_score(), "interval_gap_cv", scores.GAP_CV_STEPS, False),
    ],
)
def test_score_edges(spark, sql, column, steps, below):
    for i, (bound, points) in enumerate(steps):
        step = 1 if below else 1e-6
        beyond = bound - step if below else bound + step
        worse = steps[i + 1][1] if i + 1 < len(steps) else (0.0 if below else scores.BEYOND_STEPS)
        df = spark.createDataFrame([(bound,), (beyond,)], f"{column} {'int' if below else 'double'}")
        got = [r.s for r in df.selectExpr(f"{sql} AS s").collect()]
        assert got[0] == points
        assert got[1] == worse or (below and beyond > (steps[i + 1][0] if i + 1 < len(steps) else -1))


def same(a, b, keys):
    """Equal rows; doubles to nine digits."""
    left, right = (sorted(df.collect(), key=lambda r: tuple(str(r[k]) for k in keys)) for df in (a, b))
    assert len(left) == len(right) > 0
    for x, y in zip(left, right):
        for c in a.columns:
            if isinstance(x[c], float) and isinstance(y[c], float):
                assert x[c] == pytest.approx(y[c], rel=1e-9, abs=1e-9), (c, x, y)
            else:
                assert x[c] == y[c], (c, x, y)


@pytest.mark.parametrize("bounds", [(None, None), ("2024-01-10 05:30:00", "2024-01-12 17:45:00")])
def test_widths_from_one_pass_equal_each_alone(spark, sf, bounds):
    """Folded from three minutes upwards, counts cut inside the last buckets."""
    stored, now = fx.messages(spark, sf), "2024-01-20 11:31:00"
    windows = {w: RefreshWindow.resolve(w, now, *bounds) for w in schemas.WIDTHS}
    rows = series_rows(stored.where(windows["24h"].inside("received_at")))
    contexts = [
        outside_context(series_rows(stored.where(x.outside("received_at"))), x).withColumn("width_us", F.lit(x.width_us))
        for x in windows.values()
    ]
    found = message_aggregates_by_width(rows, windows, reduce(DataFrame.unionByName, contexts)).cache()
    for width, window in windows.items():
        alone = message_aggregates(stored, width, now, *bounds)
        ours = found.where(F.col("width_us") == window.width_us)
        same(alone, ours, ["bucket_start", "device_id", "metric_name"])


def test_folded_percentiles(spark):
    """Ranks picked in three-minute buckets and taken over by wider ones."""
    values = spark.range(20_000).selectExpr(
        "concat('d', id % 2) AS device_id",
        "pmod(hash(id), 86400) * 1000000L AS t_us",
        """CASE WHEN id % 3 = 0 THEN 7.25D WHEN id % 3 = 1 THEN pow(id % 977, 5) / 1e6
           ELSE -1e-7 * id END AS v""",
    )
    odd = [("n", float(x)) for x in ("inf", "-inf", "nan", "1", "2")] + [("one", 4.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    odd = spark.createDataFrame([(g, 7_000_000 * i, v) for i, (g, v) in enumerate(odd)], values.schema)
    rows = values.unionByName(odd).selectExpr("*", "'m' AS metric_name", "'t' AS topic", "t_us AS tie_us")
    hour, day = 3600 * 10**6, 86400 * 10**6
    narrow = bucket_rows(rows, [180 * 10**6, hour, day])
    for width_us, wide in ((hour, fold(narrow, hour, [hour, day])), (day, fold(fold(narrow, hour, [hour, day]), day, [day]))):
        shown = percentiles.blended("numeric_count")
        got = wide.select("*", *percentiles.named(width_us)).selectExpr("device_id", "bucket_us", f"array({', '.join(shown.values())}) AS p").collect()
        at = f"t_us - pmod(t_us, {width_us}L) AS bucket_us"
        exact = F.percentile("v", F.array(*[F.lit(f) for f in percentiles.FRACTIONS])).alias("p")
        want = {(r.device_id, r.bucket_us): r.p for r in rows.selectExpr("*", at).groupBy("device_id", "bucket_us").agg(exact).collect()}
        assert len(got) == len(want) > 4
        for r in got:
            p = want[r.device_id, r.bucket_us]
            assert r.p == (pytest.approx(p, rel=1e-12, nan_ok=True) if p else [None] * 3), r


def test_range_equals_full(spark, sf):
    stored = fx.messages(spark, sf)
    lo, hi = "2024-01-10 00:00:00", "2024-01-12 00:00:00"
    part = message_aggregates(stored, "24h", fx.REFERENCE_TIME, lo, hi)
    whole = message_aggregates(stored, "24h", fx.REFERENCE_TIME).where(
        "bucket_start BETWEEN '2024-01-10' AND '2024-01-12'"
    )
    same(part, whole, ["bucket_start", "device_id", "metric_name"])


def test_one_exchange_of_raw_rows(spark, sf):
    plan = message_aggregates(fx.messages(spark, sf), "24h", fx.REFERENCE_TIME)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # Raw rows once by (series, bucket); bucket rows once by series; the context
    # outside the range once, after combining.
    assert text.count("Exchange hashpartitioning") == 3
    assert "PythonUDF" not in text and "CartesianProduct" not in text


def test_kept_sample_of_the_last_instant_is_not_nan(spark):
    from tidemark.operators import timeweight as tw

    rows = spark.createDataFrame(
        [("a", 5, 1, float("nan")), ("a", 5, 1, 2.0), ("a", 4, 1, 7.0)], "g string, t_us long, tie_us long, v double"
    )
    row = tw.nearest_samples(rows, ["g"]).first()
    assert (row.first_us, row.first_v, row.last_us, row.last_v) == (4, 7.0, 5, 2.0)
