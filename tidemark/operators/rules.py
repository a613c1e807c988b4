"""Topic-mapping rules: generating them, and finding the first that matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.ranking import ranked

# Kind given to a device's topics, per source table.
SOURCE_TABLE_KINDS = (
    ("public.mqtt_power", "measurement"),
    ("public.mqtt_energy", "measurement"),
    ("public.mqtt_status", "status"),
    ("public.mqtt_switch", "measurement"),
    ("public.mqtt_online", "status"),
    ("public.mqtt_infos", "status"),
    ("public.mqtt_announcements", "status"),
    ("public.mqtt_dump", "status"),
    ("public.mqtt_topics", "topic_inventory"),
)

# The default broker rule, as (priority, pattern and target, notes).
DEFAULT_RULE = (20, "$SYS/", "Default broker topic inventory mapping")
DEVICE_PRIORITY = 100
ALIAS_PRIORITY = 90
RULE_PRIORITY = 1000

# Columns of a device table.
NEW_NAME = "<new-mqtt-device-name>"
OLD_NAME = "<old-mqtt-device-name>"
VERY_OLD_NAME = "<very-old-mqtt-device-name>"
NOT_IN_USE = "<not-in-use>"

# Legacy topics that are skipped on purpose, as (table, topic, notes).
SKIPPED_TOPICS = (
    ("public.mqtt_online", "shellies/BV.LR.SY/ProjectorScreen/online", "Ignored legacy ProjectorScreen online topic"),
    ("public.mqtt_online", "shellies/living_room/shelly/switch/lw/online", "Ignored legacy living room switch online topic"),
    ("public.mqtt_topics", "shellies/BV.LR.SY/ProjectorScreen/online", "Ignored retained legacy ProjectorScreen online topic"),
    ("public.mqtt_topics", "shellies/living_room/shelly/switch/lw/online", "Ignored retained legacy living room switch online topic"),
)
SKIP_PRIORITY = 10

# Where a rule stands in the file it came from: groups of rules in turn, then the row and, within
# it, which of the row's names and tables. Of equal priorities the earlier rule wins.
_POSITION = "struct<part:int,line:bigint,turn:int,place:int>"
_DEFAULT, _DEVICES, _ALIASES, _SKIPPED = range(4)

_RULE_KEY = ["source_table", "source_pattern", "target_topic", "target_kind"]

# The characters a literal device name has escaped in a pattern.
_SPECIAL = r"([()\[\]{}?*+\-|^$\\.&~# \t\n\r\x0B\f])"


def read_device_table(spark, path: str) -> DataFrame:
    """A device table exported as CSV with a header line, with the ``row_number`` of each row.

    Rows count from 2 in file order, as the header is row 1.
    """
    return _in_file_order(spark.read.csv(path, header=True, quote='"', escape='"'), "row_number", 2)


def _in_file_order(rows: DataFrame, name: str, first: int) -> DataFrame:
    """Number rows just read by file, block and line; partitions alone may be in another order."""
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return ranked(placed, name, first, "_file", "_block", "_row").drop("_file", "_block", "_row")


def _clean(name: str) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(F.col(name), F.lit(""))), r"^/+|/+\z", "")


def _renames_to_rules(renames: DataFrame, priority: int) -> DataFrame:
    """Rules for rows (old, new, notes): one per supported source table.

    Renames with an empty side are dropped; of equal rules the first by
    ``position`` stays.
    """
    escaped = F.regexp_replace("old", _SPECIAL, r"\\$1")
    kinds = F.array(
        *[
            F.struct(F.lit(t).alias("source_table"), F.lit(k).alias("target_kind"), F.lit(i).alias("place"))
            for i, (t, k) in enumerate(SOURCE_TABLE_KINDS)
        ]
    )
    rules = (
        renames.where((F.col("old") != "") & (F.col("new") != ""))
        .select("old", "new", "notes", "position", F.explode(kinds).alias("kind"))
        .select(
            F.struct("position.part", "position.line", "position.turn", "kind.place").alias("position"),
            F.lit(priority).alias("priority"),
            F.col("kind.source_table").alias("source_table"),
            F.lit("regex").alias("rule_type"),
            F.concat(F.lit("^shellies/"), escaped, F.lit("/(.*)$")).alias("source_pattern"),
            F.concat(F.lit("shellies/"), F.col("new"), F.lit(r"/\1")).alias("target_topic"),
            F.col("kind.target_kind").alias("target_kind"),
            "notes",
        )
    )
    others = ["priority", "rule_type", "notes"]
    return rules.groupBy(*_RULE_KEY).agg(
        *[F.min_by(c, "position").alias(c) for c in others], F.min("position").alias("position")
    ).select(*schemas.RULE_FILE_COLUMNS, "position")


def default_rules(spark) -> DataFrame:
    priority, pattern, notes = DEFAULT_RULE
    row = (priority, schemas.LEGACY_TOPICS, "prefix", pattern, pattern, "topic_inventory", notes)
    return _rule_frame(spark, [row], _DEFAULT)


_FILE_TYPES = """priority int, source_table string, rule_type string, source_pattern string,
    target_topic string, target_kind string, notes string"""


def _rule_frame(spark, rows, part: int) -> DataFrame:
    placed = [(*row, (part, i, 0, 0)) for i, row in enumerate(rows)]
    return spark.createDataFrame(placed, f"{_FILE_TYPES}, position {_POSITION}")


def device_rules(
    devices: DataFrame, include_not_in_use: bool = False, sheet: str = "devices"
) -> DataFrame:
    """Rename rules of a device table, with the default rule.

    The optional ``row_number`` column orders the rows and names them in notes. ``position``
    keeps the order of the rules until they are imported or written.
    """
    have = set(devices.columns)
    missing = [c for c in (NEW_NAME, OLD_NAME) if c not in have]
    if missing:
        raise ValueError(f"the device table has no {' and no '.join(missing)}")
    used = devices
    if NOT_IN_USE in have and not include_not_in_use:
        used = used.where(F.trim(F.coalesce(F.col(NOT_IN_USE), F.lit(""))) == "")
    row = F.col("row_number").cast("bigint") if "row_number" in have else F.lit(0).cast("bigint")
    where = F.concat(F.lit(" row "), row) if "row_number" in have else F.lit("")
    olds = [F.struct(_clean(OLD_NAME).alias("old"), F.lit(0).alias("turn"))]
    if VERY_OLD_NAME in have:
        olds.append(F.struct(_clean(VERY_OLD_NAME).alias("old"), F.lit(1).alias("turn")))
    renames = used.select(
        _clean(NEW_NAME).alias("new"),
        F.concat(F.lit(f"Imported from {sheet}"), where).alias("notes"),
        row.alias("row"),
        F.explode(F.array(*olds)).alias("alias"),
    ).select(
        "new", "notes", F.col("alias.old").alias("old"), _place(_DEVICES, F.col("row"), F.col("alias.turn"))
    )
    return default_rules(devices.sparkSession).unionByName(_renames_to_rules(renames, DEVICE_PRIORITY))


def _place(part: int, line: Column, turn: Column) -> Column:
    return F.struct(F.lit(part).alias("part"), line.alias("line"), turn.alias("turn")).alias("position")


def alias_rules(rules: DataFrame, aliases: DataFrame) -> DataFrame:
    """Add rules for one-off renames (old, new, notes) not yet among ``rules``.

    The optional ``row_number`` column orders them.
    """
    line = F.col("row_number").cast("bigint") if "row_number" in aliases.columns else F.lit(0).cast("bigint")
    renames = aliases.select(
        _clean("old").alias("old"),
        _clean("new").alias("new"),
        "notes",
        _place(_ALIASES, line, F.lit(0)),
    )
    added = _renames_to_rules(renames, ALIAS_PRIORITY)
    return rules.unionByName(added.join(rules.select(*_RULE_KEY), _RULE_KEY, "left_anti"))


def skip_rules(spark) -> DataFrame:
    rows = [
        (SKIP_PRIORITY, table, "exact", topic, None, "skip", notes) for table, topic, notes in SKIPPED_TOPICS
    ]
    return _rule_frame(spark, rows, _SKIPPED)


def write_rules_csv(rules: DataFrame, path: str) -> None:
    """Write rules as CSV, in their order where they have one."""
    ordered = rules.orderBy("position") if "position" in rules.columns else rules
    ordered.select(*schemas.RULE_FILE_COLUMNS).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"'
    )


def read_rules_csv(spark, path: str) -> DataFrame:
    """Rules of a CSV file, with their ``position`` in it."""
    rows = spark.read.csv(path, header=True, schema=_FILE_TYPES, quote='"', escape='"')
    line = _in_file_order(rows, "_at", 0)
    place = F.struct(
        F.lit(_DEVICES).alias("part"), F.col("_at").alias("line"), F.lit(0).alias("turn"), F.lit(0).alias("place")
    )
    return line.withColumn("position", place).drop("_at")


def import_rules(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``existing`` (``schemas.TOPIC_RULE``) plus the new rules it lacks.

    A NULL source table or target never compares equal, so such rules are added
    every time. New ids follow the existing ones without gaps, in the order of
    ``position``, or by content for rules that have none.
    """
    key = ["source_table", "rule_type", "source_pattern", "target_topic", "target_kind"]
    fresh = new.join(existing.select(*key), key, "left_anti")
    last_id = existing.agg(F.max("mapping_id")).first()[0] or 0
    content = ["priority", "source_pattern", "source_table", "target_topic", "target_kind"]
    order = ["position", *content] if "position" in new.columns else content
    added = ranked(fresh, "mapping_id", last_id + 1, *order).withColumns(
        {"enabled": F.lit(True), "priority": F.coalesce(F.col("priority"), F.lit(RULE_PRIORITY))}
    )
    return existing.unionByName(schemas.conform(added, schemas.TOPIC_RULE))


# --- matching ---------------------------------------------------------------

# A literal pattern character, not followed by a quantifier that would make it
# optional.
_LITERAL_RUN = r"^\^((?:(?:[A-Za-z0-9/_ <>=:;,@%&~!#'\"-]|\\[^A-Za-z0-9])(?![*?+{]))*)"


def _anchor() -> Column:
    """Leading topic segments every topic matched by the rule must have.

    Empty when the pattern fixes none; such rules are tried on every topic.
    """
    pattern = F.col("source_pattern")
    like_head = F.regexp_extract(pattern, r"^([^%_\\]*)", 1)
    run = F.regexp_replace(F.regexp_extract(pattern, _LITERAL_RUN, 1), r"\\(.)", "$1")
    regex_head = F.when(pattern.contains("|"), F.lit("")).otherwise(run)
    head = F.when(F.col("rule_type") == "prefix", like_head).otherwise(regex_head)
    whole_segments = F.regexp_extract(head, r"(?s)^(.*)/", 1)
    return F.when(F.col("rule_type") == "exact", pattern).otherwise(whole_segments)


def _java_pattern(pattern: Column, end: str) -> Column:
    """End anchors mean the very end of the text, ``.`` matches any character."""
    ends = F.regexp_replace(pattern, r"(?<!\\)((?:\\\\)*)\$(?=\)|\||\z)", "$1" + end)
    return F.concat(F.lit("(?s)"), ends)


def _matches(strict_prefix: bool) -> Column:
    topic, pattern, kind = F.col("source_topic"), F.col("source_pattern"), F.col("rule_type")
    # Unescaped wildcards in a prefix act as wildcards, unless asked otherwise.
    wild = F.concat(F.regexp_replace(pattern, r"\\([^%_\\])", "$1"), F.lit("%"))
    starts = F.startswith(topic, pattern) if strict_prefix else F.like(topic, wild)
    return (
        ((kind == "exact") & (topic == pattern))
        | ((kind == "prefix") & starts)
        | ((kind == "regex") & F.rlike(topic, _java_pattern(pattern, r"\\z")))
    )


def mapped_topic() -> Column:
    """Target topic of a matched rule (columns of the rule and ``source_topic``).

    Behind the topic stand a NUL and the text of its first match. The pattern's tail consumes
    them, so the replacement fires once, and a reference to the whole match can be answered.
    """
    topic, pattern, target = F.col("source_topic"), F.col("source_pattern"), F.col("target_topic")
    whole = F.call_function("regexp_extract", topic, _java_pattern(pattern, r"\\z"), F.lit(0))
    once = F.concat(
        F.lit("(?s)(?:"), _java_pattern(pattern, r"(?=\\x00)"), F.lit(r")(?<rest>[^\x00]*)\x00(?<whole>.*)\z")
    )
    escaped = F.regexp_replace(target, r"\$", r"\\\$")
    unescaped = r"(?<!\\)((?:\\\\)*)\\"
    numbered = F.regexp_replace(escaped, unescaped + "([1-9])", r"$1\$$2")
    replacement = F.concat(F.regexp_replace(numbered, unescaped + "&", r"$1\${whole}"), F.lit("${rest}"))
    replaced = F.regexp_replace(F.concat(topic, F.lit("\0"), whole), once, replacement)
    kind = F.col("rule_type")
    return (
        F.when(kind == "exact", target)
        .when(kind == "prefix", F.concat(target, F.substring(topic, F.length(pattern) + 1, F.length(topic))))
        .when(kind == "regex", F.regexp_replace(replaced, r"(?s)\x00.*\z", ""))
    )


# Topics that share an anchor are spread over this many groups, as a rule without leading
# segments is a candidate for every topic.
_ANCHOR_SALTS = 16


def first_matching_rules(
    topics: DataFrame, rules: DataFrame, strict_prefix: bool = False
) -> DataFrame:
    """For each (source_table, source_topic) the enabled rule with the lowest
    (priority, mapping_id), as ``mapping_id``, ``mapped_topic``, ``mapped_kind``.

    Runs on distinct topics. A rule is joined by equality on the leading segments
    its pattern fixes, salted; only those candidates are tested against the pattern. The join is
    always dealt by key: sizes are estimated without the copies for the salts, so a table of rules
    that looks small enough to broadcast need not fit the driver.
    """
    distinct = topics.select("source_table", "source_topic").distinct()
    parts = F.split("source_topic", "/", -1)
    heads = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )
    salt = F.pmod(F.xxhash64("source_table", "source_topic"), F.lit(_ANCHOR_SALTS)).cast("int")
    placed = distinct.withColumn("salt", salt).withColumn("anchor", F.explode(F.array_distinct(heads)))
    usable = (
        rules.where("enabled")
        .withColumnRenamed("source_table", "rule_table")
        .withColumn("anchor", _anchor())
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_ANCHOR_SALTS - 1))))
        .drop("notes")
    )
    candidates = placed.join(usable.hint("merge"), ["anchor", "salt"]).where(
        (F.col("rule_table").isNull() | (F.col("rule_table") == F.col("source_table")))
        & _matches(strict_prefix)
    )
    rule = F.struct("mapping_id", "rule_type", "source_pattern", "target_topic", "target_kind")
    best = candidates.groupBy("source_table", "source_topic").agg(
        F.min(F.struct("priority", "mapping_id", rule.alias("rule"))).alias("best")
    )
    return best.select("source_table", "source_topic", "best.rule.*").select(
        "source_table",
        "source_topic",
        "mapping_id",
        F.when(F.col("target_kind") != "skip", mapped_topic()).alias("mapped_topic"),
        F.col("target_kind").alias("mapped_kind"),
    )
