"""Events whose JSON properties are parsed once, when they land.

The landed table holds ``properties`` as a Variant, the text of rows that are no
JSON in ``properties_malformed``, and the one path that the models read as a column
of its own, ``properties_sr_id``. So a fact reads (and prunes to) a plain string
column and parses nothing, other paths stay open through the Variant, and no text is
lost.

Defined cases: text that Spark's JSON parser refuses (cut off, empty, keys that
repeat, single quotes) is malformed: its Variant and its ``properties_sr_id`` are
null, and it is counted, never dropped. Null properties are null in all three
columns. A missing key, JSON null, and JSON that is no object have no ``sr_id``;
numbers and nested values are given as their JSON text. Extra columns of the events
are ignored; an empty table lands as an empty table. Full builds and nightly runs
take events in this form or as text; deliveries and the stream compare whole rows,
which a Variant does not allow, and take text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from ..functions.json import variant_text
from ..schemas import RAW_SCHEMAS

MALFORMED, SR_ID = "properties_malformed", "properties_sr_id"


def _parsed_schema() -> StructType:
    fields = []
    for f in RAW_SCHEMAS["raw_events"].fields:
        if f.name == "properties":
            fields += [StructField("properties", VariantType(), True), StructField(MALFORMED, StringType(), True),
                       StructField(SR_ID, StringType(), True)]
        else:
            fields.append(f)
    return StructType(fields)


PARSED_EVENTS = _parsed_schema()


def parsed_events(raw_events: DataFrame) -> DataFrame:
    """Events in the landed form (``PARSED_EVENTS``), each text parsed once."""
    rows = raw_events.withColumn("_text", F.col("properties")).withColumn("properties", F.try_parse_json("properties"))
    return rows.withColumns({
        MALFORMED: F.when(F.col("properties").isNull(), F.col("_text")),
        SR_ID: variant_text("properties", "sr_id")}).select(*PARSED_EVENTS.fieldNames())


def properties_report(events: DataFrame) -> DataFrame:
    """Per event type of landed events: rows, rows without properties, rows that are
    no JSON, rows with an ``sr_id``, and what share of those with text is no JSON."""
    malformed, absent = F.col(MALFORMED).isNotNull(), F.col(MALFORMED).isNull() & F.col("properties").isNull()
    count = lambda c: F.count(F.when(c, 1))
    return events.groupBy("event_type").agg(
        F.count("*").alias("n_events"), count(absent).alias("n_absent"), count(malformed).alias("n_malformed"),
        F.count(SR_ID).alias("n_sr_id"),
        F.round(F.try_divide(count(malformed), count(~absent)), 9).alias("malformed_share"))
