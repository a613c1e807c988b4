"""Small inputs written as (device, metric, offset seconds, value) rows."""

from datetime import datetime, timedelta, timezone

from tidemark import schemas

START = datetime(2024, 3, 1, 12, 0, tzinfo=timezone.utc)
REFERENCE = "2024-03-02 00:00:00"


def at(seconds):
    return START + timedelta(seconds=seconds)


def message(device, metric, seconds, value, committed=0, topic=None):
    row = dict.fromkeys(schemas.MESSAGE.fieldNames())
    row.update(
        received_at=at(seconds),
        topic=topic or f"sensors/{device}/{metric}",
        device_id=device,
        metric_name=metric,
        payload="x" if value is None else str(value),
        numeric_value=None if value is None else float(value),
        metadata="{}",
        committed_at=at(seconds + 1 + committed),
    )
    return tuple(row.values())


def relay_event(device, seconds, state, index=0, committed=0):
    return (
        at(seconds), f"shellies/{device}/relay/{index}", device, index, state, state == "on",
        state, "{}", at(seconds + 1 + committed),
    )


def messages(spark, rows):
    return spark.createDataFrame(rows, schemas.MESSAGE)


def relays(spark, rows):
    return spark.createDataFrame(rows, schemas.RELAY_EVENT)


def one(df, start=START, **keys):
    """The single row of a bucket."""
    naive = start.replace(tzinfo=None)
    rows = [
        r for r in df.collect()
        if r.bucket_start.replace(tzinfo=None) == naive and all(r[k] == v for k, v in keys.items())
    ]
    assert len(rows) == 1, rows
    return rows[0]
