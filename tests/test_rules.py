import pytest

from tidemark import schemas
from tidemark.operators import migration, rules

DEVICES = [
    ("shellyplus1pm-aabbcc", "BV.LR.SY.PLG.TV", None, None, "x", 2),
    ("shellyplug-F43A50", "BV.SR.SY.PLG.Server", "shellies/BV.LR.SY.PLG.Server", "", "x", 3),
    ("shellyplus1pm-unused", "BV.XX.SY.PLG.Old", "", "x", "", 4),
]
COLUMNS = (
    "`<new-mqtt-device-name>` string, `<old-mqtt-device-name>` string, "
    "`<very-old-mqtt-device-name>` string, `<not-in-use>` string, notes string, row_number int"
)


@pytest.fixture(scope="module")
def devices(spark):
    return spark.createDataFrame(DEVICES, COLUMNS)


def test_device_rules(devices):
    assert rules.device_rules(devices).count() == 28
    assert rules.device_rules(devices, include_not_in_use=True).count() == 37


def test_missing_column(devices):
    with pytest.raises(ValueError, match="has no"):
        rules.device_rules(devices.drop(rules.OLD_NAME))


def test_aliases_are_not_repeated(spark, devices):
    generated = rules.device_rules(devices)
    aliases = spark.createDataFrame(
        [("BV.SR.SY.PLG.Server", "shellyplug-F43A50", "known"), ("one/off/", "shellyplug-F43A50", "new")],
        "old string, new string, notes string",
    )
    out = rules.alias_rules(generated, aliases)
    assert out.count() == 28 + 9 and out.where("priority = 90").count() == 9


def test_csv_round_trip(spark, devices, tmp_path):
    generated = rules.device_rules(devices).unionByName(rules.skip_rules(spark))
    rules.write_rules_csv(generated, str(tmp_path / "rules"))
    back = rules.read_rules_csv(spark, str(tmp_path / "rules")).drop("position")
    generated = generated.drop("position")
    assert back.exceptAll(generated).count() == 0 and generated.exceptAll(back).count() == 0


MATCHING = [
    (1, 10, True, None, "prefix", "a_c/", "X/", "measurement", None),
    (2, 20, True, None, "regex", "(b+)(.*)$", r"<\2|$\1>", "measurement", None),
    (3, 30, True, None, "regex", "[0-9]", "#", "status", None),
    (4, 40, True, None, "exact", "x", "y", "status", None),
    (5, 1, False, None, "prefix", "", "no", "status", None),
    (6, 50, True, "t2", "prefix", "", "all/", "status", None),
    (7, 5, True, None, "regex", "^deep/a?b/(.*)$", r"to/\1", "status", None),
    (8, 5, True, None, "regex", "^deep/|^flat/", "either/", "status", None),
    (9, 7, True, None, "exact", "gone", None, "skip", None),
]
EXPECTED = {
    ("t1", "a_c/1"): (1, "X/1"),
    ("t1", "abc/zz"): (1, "X/zz"),
    ("t1", "zbbq/5b"): (2, "z<q/5b|$bb>"),
    ("t1", "t1/23"): (3, "t#/23"),
    ("t1", "x"): (4, "y"),
    ("t1", "nope\n"): None,
    ("t1", "k9\n"): (3, "k#\n"),
    ("t2", "nope"): (6, "all/nope"),
    ("t1", "deep/b/q"): (7, "to/q"),
    ("t1", "deep/x/q"): (8, "either/x/q"),
    ("t1", "flat/x"): (8, "either/x"),
    ("t1", "gone"): (9, None),
}


def test_first_matching_rule(spark):
    topics = spark.createDataFrame(list(EXPECTED), "source_table string, source_topic string")
    found = rules.first_matching_rules(topics, spark.createDataFrame(MATCHING, schemas.TOPIC_RULE))
    got = {(r.source_table, r.source_topic): (r.mapping_id, r.mapped_topic) for r in found.collect()}
    assert got == {k: v for k, v in EXPECTED.items() if v}


def test_rules_are_not_broadcast(spark, tmp_path):
    # The size of a stored table is estimated without the copies for the salts.
    spark.createDataFrame(MATCHING, schemas.TOPIC_RULE).write.parquet(str(tmp_path / "rules"))
    topics = spark.createDataFrame(list(EXPECTED), "source_table string, source_topic string")
    found = rules.first_matching_rules(topics, spark.read.parquet(str(tmp_path / "rules")))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_strict_prefix(spark):
    topics = spark.createDataFrame([("t1", "abc/1"), ("t1", "a_c/1")], "source_table string, source_topic string")
    rule = spark.createDataFrame(MATCHING[:1], schemas.TOPIC_RULE)
    assert [r.source_topic for r in rules.first_matching_rules(topics, rule, True).collect()] == ["a_c/1"]


def test_own_metadata_wins_over_provenance(spark):
    import json

    from pyspark.sql import functions as F

    row = spark.sql(
        """SELECT 3L AS batch_id, 't' AS source_table, 's' AS source_topic, CAST(NULL AS STRING) AS source_unit,
           TIMESTAMP_NTZ'2024-01-01 00:00:00' AS source_created_at, 'status' AS mapped_kind,
           '{"source_table":"mine","extra":"1"}' AS metadata"""
    ).select(migration.provenance(F.lit("2024-01-02").cast("timestamp"))).first()[0]
    out = json.loads(row)
    assert (out["source_table"], out["extra"], out["source_unit"], out["migration_batch_id"]) == ("mine", "1", None, "3")


def test_device_table_from_csv(spark, tmp_path):
    path = tmp_path / "devices.csv"
    path.write_text(
        "<new-mqtt-device-name>,<old-mqtt-device-name>,<very-old-mqtt-device-name>,<not-in-use>,notes\n"
        'new-1,old-1,,,"one, quoted"\nnew-2,/old-2/,shellies/older-2,,\nnew-3,old-3,,x,\n'
    )
    out = rules.device_rules(rules.read_device_table(spark, str(path)))
    assert out.count() == 1 + 9 + 18
    assert out.where(r"source_pattern = '^shellies/shellies/older\\-2/(.*)$'").count() == 9


def test_rows_of_a_device_table_keep_their_file_order(spark, tmp_path):
    path = tmp_path / "devices.csv"
    names = ["zeta", "alpha", "mid"]
    path.write_text("<new-mqtt-device-name>,<old-mqtt-device-name>\n" + "".join(f"{n},old\n" for n in names))
    generated = rules.device_rules(rules.read_device_table(spark, str(path)))
    none = spark.createDataFrame([], schemas.TOPIC_RULE)
    imported = rules.import_rules(none, generated)
    topics = spark.createDataFrame([("public.mqtt_power", "shellies/old/relay/0/power")], "source_table string, source_topic string")
    found = rules.first_matching_rules(topics, imported).first()
    assert found.mapped_topic == "shellies/zeta/relay/0/power"
    ids = sorted((r.mapping_id, r.notes) for r in imported.collect())
    assert [i for i, _ in ids] == list(range(1, 29))
    assert ids[1][1] == "Imported from devices row 2" and ids[-1][1] == "Imported from devices row 4"
    # The order survives a CSV file.
    rules.write_rules_csv(generated, str(tmp_path / "rules"))
    again = rules.import_rules(none, rules.read_rules_csv(spark, str(tmp_path / "rules")))
    assert sorted((r.mapping_id, r.notes) for r in again.collect()) == ids


@pytest.mark.parametrize(
    ("pattern", "target", "topic", "mapped"),
    [
        ("^a(.*)$", r"x\&y", "ab", "xaby"),
        ("a(.)", r"<\&|\1>", "-ab-ab", "-<ab|b>-ab"),
        ("^(a.)(c)$", r"$\2\1\&", "a$c", "$ca$a$c"),
        (r"^a\\\\$", "end", "a\\\\", "end"),
    ],
)
def test_references_in_targets(spark, pattern, target, topic, mapped):
    rule = [(1, True, 1, None, "regex", pattern, target, "status", None)]
    columns = "mapping_id long, enabled boolean, priority int, source_table string, rule_type string, source_pattern string, target_topic string, target_kind string, notes string"
    topics = spark.createDataFrame([("t", topic)], "source_table string, source_topic string")
    assert rules.first_matching_rules(topics, spark.createDataFrame(rule, columns)).first().mapped_topic == mapped
