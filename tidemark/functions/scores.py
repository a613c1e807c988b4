"""Quality scores and flags of an aggregate row (fixed thresholds).

Each function returns a SQL expression over the aggregate columns.
"""

from __future__ import annotations

# Fixed values: (threshold, score) pairs, read top to bottom.
COUNT_STEPS = ((50, 10.0), (20, 8.5), (10, 7.0), (5, 5.0), (2, 3.0), (1, 1.0))
UNCERTAINTY_STEPS = ((0.10, 10.0), (0.25, 8.0), (0.50, 6.0), (1.00, 4.0))
GAP_CV_STEPS = ((0.05, 10.0), (0.10, 9.0), (0.20, 8.0), (0.35, 6.0), (0.50, 4.0))
BEYOND_STEPS = 2.0
BOUNDARY_PENALTIES = (
    ("locf_value_at_bucket_start", 3.0),
    ("linear_value_at_bucket_start", 3.0),
    ("locf_value_at_bucket_end", 2.0),
    ("linear_value_at_bucket_end", 2.0),
)
Z95 = 1.96

# Guidance bands, as (lower bound inclusive, name).
QUALITY_BANDS = ((8.0, "strong"), (5.0, "usable"), (2.0, "weak"), (0.0, "very_poor"))


def _steps(value: str, compare: str, steps, otherwise: str) -> str:
    cases = " ".join(
        f"WHEN {value} {compare} {bound}{'D' if isinstance(bound, float) else ''} THEN {points}D"
        for bound, points in steps
    )
    return f"CASE {cases} ELSE {otherwise} END"


def boundary_score() -> str:
    lost = " + ".join(f"IF({c} IS NULL, {p}D, 0.0D)" for c, p in BOUNDARY_PENALTIES)
    return f"greatest(0.0D, 10.0D - ({lost}))"


def count_score() -> str:
    return _steps("numeric_count", ">=", COUNT_STEPS, "0.0D")


def relative_uncertainty() -> str:
    """Width of the 95 % interval relative to the bucket's own scale."""
    return """
        (numeric_ci95_upper - numeric_ci95_lower) / greatest(
            abs(coalesce(numeric_avg, 0.0D)),
            abs(coalesce(numeric_median, 0.0D)),
            abs(coalesce(numeric_p75, 0.0D) - coalesce(numeric_p25, 0.0D)),
            abs(coalesce(numeric_max, 0.0D) - coalesce(numeric_min, 0.0D)),
            1.0D)"""


def stats_score(uncertainty: str) -> str:
    rated = _steps(uncertainty, "<=", UNCERTAINTY_STEPS, f"{BEYOND_STEPS}D")
    return f"""CASE WHEN numeric_count = 0 THEN 0.0D
        WHEN numeric_count = 1 OR {uncertainty} IS NULL THEN 1.0D ELSE {rated} END"""


def interval_score() -> str:
    rated = _steps("interval_gap_cv", "<=", GAP_CV_STEPS, f"{BEYOND_STEPS}D")
    return f"IF(interval_gap_cv IS NULL, 1.0D, {rated})"


def flags(uncertainty: str) -> str:
    """Names of the conditions that hold, in this order."""
    named = (
        ("missing_locf_start", "locf_value_at_bucket_start IS NULL"),
        ("missing_linear_start", "linear_value_at_bucket_start IS NULL"),
        ("missing_locf_end", "locf_value_at_bucket_end IS NULL"),
        ("missing_linear_end", "linear_value_at_bucket_end IS NULL"),
        ("low_numeric_count", "numeric_count < 5"),
        ("single_numeric_sample", "numeric_count = 1"),
        ("high_mean_uncertainty", f"{uncertainty} > 0.50D"),
        ("insufficient_interval_support", "coalesce(interval_gap_count, 0) < 2"),
        ("irregular_measurement_intervals", "interval_gap_cv > 0.35D"),
    )
    return f"array_compact(array({', '.join(f'IF({c}, {n!r}, NULL)' for n, c in named)}))"


def quality_band(score: str = "quality_score") -> str:
    cases = " ".join(f"WHEN {score} >= {low}D THEN '{name}'" for low, name in QUALITY_BANDS)
    return f"CASE {cases} END"
