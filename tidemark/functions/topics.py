"""Topic grammar: which topics name a series, and which series they name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three shapes ``sensors/<device>/<metric>``,
# ``shellies/<device>/relay/0/<power or energy>`` and ``shellies/<device>/relay/0``.
SENSOR = r"sensors/([^/]+)/([^/]+)"
RELAY = r"shellies/([^/]+)/relay/0"
SHAPES = rf"^(?:{SENSOR}|{RELAY}(?:/(power|energy))?)\z"
STATE = rf"^{RELAY}\z"


def device_id(topic: Column) -> Column:
    # At most one of the two device groups matches; the other is empty.
    name = F.concat(F.regexp_extract(topic, SHAPES, 1), F.regexp_extract(topic, SHAPES, 3))
    return F.nullif(name, F.lit(""))


def metric_name(topic: Column) -> Column:
    name = F.concat(F.regexp_extract(topic, SHAPES, 2), F.regexp_extract(topic, SHAPES, 4))
    return F.when(topic.rlike(STATE), F.lit("relay_state")).otherwise(F.nullif(name, F.lit("")))
