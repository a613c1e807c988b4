from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from tidemark import schemas
from tidemark.functions import clock, parse
from tidemark.operators import normalize

AT = datetime(2024, 3, 1, tzinfo=timezone.utc)
DEMO = "sensors/demo/temperature"

CASES = [
    # topic, payload, metadata, device, metric, number, extra
    (DEMO, '{"value":"21.5","event_id":"e1"}', "{}", "demo", "temperature", 21.5, {"event_id": "e1"}),
    (DEMO, "21.5", '{"event_id":"m1"}', "demo", "temperature", 21.5, {"event_id": "m1"}),
    (DEMO, '"21.5"', "{}", "demo", "temperature", None, {}),
    (DEMO, "{bad", "{}", "demo", "temperature", None, {}),
    (DEMO, '{"value":null}', "{}", "demo", "temperature", None, {}),
    (DEMO, '{"value":true}', "{}", "demo", "temperature", None, {}),
    (DEMO, '{"value":1,"value":2}', "{}", "demo", "temperature", 2.0, {}),
    (DEMO, '{"value":1} {"value":2}', "{}", "demo", "temperature", None, {}),
    (DEMO, '{"value":1,"sequence":"x"}', '{"sequence":"7"}', "demo", "temperature", 1.0, {"sequence": 7}),
    (DEMO, "1d", "{}", "demo", "temperature", None, {}),
    (DEMO, "1e400", "{}", "demo", "temperature", None, {}),
    (DEMO, '{"value":1e400}', "{}", "demo", "temperature", None, {}),
    (DEMO, " +.5e1 ", "{}", "demo", "temperature", 5.0, {}),
    (DEMO, "-Infinity", "{}", "demo", "temperature", float("-inf"), {}),
    ("sensors//temperature", "1", "{}", None, None, 1.0, {}),
    ("sensors/a/b/c", "1", "{}", None, None, 1.0, {}),
    ("shellies/plug1/relay/0/power", "12.5", "{}", "plug1", "power", 12.5, {}),
    ("shellies/plug1/relay/0/energy", "900", "{}", "plug1", "energy", 900.0, {}),
    ("shellies/plug1/relay/1/power", "12.5", "{}", None, None, 12.5, {}),
    ("shellies/plug1/relay/0", " ON ", '{"topic_kind":" Status "}', "plug1", "relay_state", None, {"topic_kind": "status"}),
]


@pytest.fixture(scope="module")
def typed(spark):
    rows = [(c[0], c[1], AT, c[2], AT) for c in CASES]
    raw = spark.createDataFrame(rows, schemas.RAW_MESSAGE)
    out = normalize.normalize_messages(raw, ("topic_kind", "value_text"))
    return {(r.topic, r.payload): r for r in out.collect()}


@pytest.mark.parametrize("case", CASES, ids=[f"{c[0]}|{c[1]}" for c in CASES])
def test_payload_cases(typed, case):
    row = typed[case[0], case[1]]
    assert (row.device_id, row.metric_name, row.numeric_value) == case[3:6]
    for name, value in case[6].items():
        assert row[name] == value


def test_nan_is_kept(spark):
    value = spark.range(1).select(parse.lenient_double(F.lit("NaN"))).first()[0]
    assert value != value


def test_strict_numbers(spark):
    cases = {" 1.5 ": 1.5, "+.5e3": 500.0, "NaN": None, "1d": None, "0x10": None, "12\n": None, "1e999": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.v for r in df.select("t", parse.strict_double(F.col("t")).alias("v")).collect()}
    assert got == cases


def test_malformed_metadata_is_quarantined(spark):
    raw = spark.createDataFrame(
        [(DEMO, "5", AT, '{"sequence":"x"}', AT), (DEMO, '{"value":5,"sequence":1}', AT, '{"sequence":"x"}', AT)],
        schemas.RAW_MESSAGE,
    )
    assert normalize.normalize_messages(raw).count() == 1
    assert [r.payload for r in normalize.quarantined_messages(raw).collect()] == ["5"]


def test_broken_metadata_is_quarantined_everywhere(spark):
    texts = ["not json", "", '{"a":1} x', "[1,2]", '"text"', "null", '{"sequence":"x"}', '{"sequence":"4"}', None]
    raw = spark.createDataFrame([(DEMO, f"{i}", AT, m, AT) for i, m in enumerate(texts)], schemas.RAW_MESSAGE)
    kept = {r.payload for r in normalize.normalize_messages(raw).collect()}
    turned_down = {r.payload: r.reject_reason for r in normalize.quarantined_messages(raw).collect()}
    assert kept == {"3", "4", "5", "7", "8"}
    assert turned_down == {**dict.fromkeys("012", "malformed metadata"), "6": "malformed metadata sequence"}
    assert normalize.topic_inventory(raw).first().message_count == 5
    assert {r.payload: r.reject_reason for r in normalize.quarantined_topics(raw).collect()} == turned_down


MOMENTS = {
    "2024-01-02": "2024-01-02 00:00:00",
    "2024-01-02T10:00:00Z": "2024-01-02 10:00:00",
    " 2024-1-2 3:04:05.25+02:00 ": "2024-01-02 01:04:05.250000",
    "2024/01/02 10:00:00": "2024-01-02 10:00:00",
    "20240102": "2024-01-02 00:00:00",
    "20240102T100000Z": "2024-01-02 10:00:00",
    "20240102 100000+02": "2024-01-02 08:00:00",
    "2024-01-02 10:00:00 -0330": "2024-01-02 13:30:00",
    "01/02/2024 10:00": "2024-01-02 10:00:00",
    "1-2-2024": "2024-01-02 00:00:00",
    "2 January 2024 10:00:00": "2024-01-02 10:00:00",
    "Jan 2, 2024": "2024-01-02 00:00:00",
    "2024-Jan-02 10:00": "2024-01-02 10:00:00",
    "2024-13-02": None,
    "Foo 2, 2024": None,
    "yesterday noon": None,
    "10:00": None,
    "": None,
}


def test_moments(spark):
    texts = spark.createDataFrame([(t,) for t in MOMENTS], "t string")
    moment = parse.moment(F.col("t")).cast("string")
    got = {r.t: r.m for r in texts.select("t", moment.alias("m")).collect()}
    assert got == {t: m and m.rstrip("0").rstrip(".") if m and "." in m else m for t, m in MOMENTS.items()}


def test_relay_events_need_a_bare_state(spark):
    topic = "shellies/plug1/relay/0"
    payloads = [" ON ", "off", "overpower", '"on"', '{"value":"Off"}']
    raw = spark.createDataFrame([(topic, p, AT, "{}", AT) for p in payloads], schemas.RAW_MESSAGE)
    events = normalize.relay_events(normalize.normalize_messages(raw, ("value_text",)))
    assert sorted((r.payload, r.state, r.is_on) for r in events.collect()) == [
        (" ON ", "on", True), ("off", "off", False), ('{"value":"Off"}', "off", False),
    ]


def test_stored_form_of_the_fixture_is_its_normalised_form(spark, sf):
    columns = ["received_at", "topic", "device_id", "metric_name", "numeric_value", "committed_at"]
    typed = normalize.normalize_messages(fx.raw_messages(spark, sf)).select(*columns)
    stored = fx.messages(spark, sf).select(*columns)
    assert typed.exceptAll(stored).count() == 0 and stored.exceptAll(typed).count() == 0


def test_inventory_last_seen_follows_arrival(spark):
    def raw(*rows):
        return spark.createDataFrame(
            [("t", p, AT.replace(hour=h), "{}", AT.replace(hour=c)) for p, h, c in rows], schemas.RAW_MESSAGE
        )

    now = clock.instant_lit(0)
    first = normalize.topic_inventory(raw(("a", 5, 6), ("b", 4, 7)), now)
    row = normalize.merge_topic_inventory(first, normalize.topic_inventory(raw(("c", 1, 9)), now)).first()
    assert (row.first_seen_at.hour, row.last_seen_at.hour, row.message_count, row.last_payload) == (5, 1, 3, "c")


@pytest.mark.parametrize(
    "wall, expected",
    [
        ("2025-10-26 02:30:00", "2025-10-26 01:30:00"),  # twice: the later one
        ("2025-10-26 01:30:00", "2025-10-25 23:30:00"),
        ("2025-10-26 03:30:00", "2025-10-26 02:30:00"),
        ("2025-03-30 02:30:00", "2025-03-30 01:30:00"),  # never shown
        ("2025-07-01 12:00:00", "2025-07-01 10:00:00"),
    ],
)
def test_wall_clock(spark, wall, expected):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{wall}' AS w")
    got = df.select(clock.wall_clock_to_instant(F.col("w"), F.lit("Europe/Berlin")).cast("string")).first()[0]
    assert got == expected


def test_only_whole_json_values_are_read(spark):
    from tidemark.functions import parse

    texts = ["1", '{"a":1}', " [1, 2] ", "null", '"x"', "", " ", "1]", "1] x", "1,2", '1,"2"', '{"a":1}}', '{"a":1}, 5', "{bad", '"x" y', "[1", "]", "1,2]", '{"a":1},5]'] 
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("m", parse.json_marked(F.col("t")))
    got = [r.t for r in df.where(parse.json_value(F.col("m"), F.col("t")).isNotNull()).collect()]
    assert got == texts[:5]
    # The hash of a text, brought by another one, closes nothing.
    (h,) = spark.range(1).select(F.xxhash64(F.lit("1"))).first()
    forged = spark.createDataFrame([(f"1,{h}]",), (f"1,{h}",)], "t string").withColumn("m", parse.json_marked(F.col("t")))
    assert forged.where(parse.json_value(F.col("m"), F.col("t")).isNotNull()).count() == 0


def test_inventory_parses_metadata_once(spark, sf):
    raw = fx.raw_messages(spark, sf)
    for rows in (normalize.topic_inventory(raw, clock.instant_lit(0)), normalize.quarantined_topics(raw)):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_fields_are_read_however_their_key_is_spelled(spark):
    rows = [
        ('{"value":"1","event_id":"e1"}', "{}"),
        ('{"v\\u0061lue":"2"}', '{"tr\\u0061ce_id":"t2"}'),
        ('{"other":"value"}', '{"other":"trace_id"}'),
    ]
    raw = spark.createDataFrame(rows, "payload string, metadata string").selectExpr(
        "'sensors/d/power' AS topic", "payload", "TIMESTAMP'2024-03-01 00:00:00Z' AS received_at", "metadata"
    )
    got = normalize.normalize_messages(raw, ("value_text",)).select("value_text", "event_id", "trace_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("1", "e1", None), ("2", None, "t2"), (None, None, None)], key=str)


def test_methods_stay_within_what_the_jvm_compiles(spark):
    from tidemark.session import prepare

    limit = "spark.sql.codegen.hugeMethodLimit"
    was = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "65535")
        assert prepare(spark).conf.get(limit) == "8000"
        spark.conf.set(limit, "20000")
        assert prepare(spark).conf.get(limit) == "20000"
    finally:
        spark.conf.set(limit, was)
