"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Instants are rendered and truncated in UTC; payloads that repeat a JSON key
# keep the last value.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Generated methods beyond this many bytes are never compiled by the JVM; an operator that would
# need one runs as several smaller ones. Results are the same.
COMPILED_METHOD = ("spark.sql.codegen.hugeMethodLimit", "65535", "8000")

# Percentiles make the bucket aggregation an object aggregation. Its input is
# already sorted on the grouping keys by the preceding window, so a sort
# aggregation streams through it without a second sort or hash map.
ADVISED_CONF = {
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session; the advised ones are its owner's choice.

    The limit of generated methods is lowered where it is the engine's default.
    """
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    key, default, value = COMPILED_METHOD
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tidemark", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        # Skips recording a Python stack per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**ADVISED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
