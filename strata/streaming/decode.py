"""Clickstream message decoding (STR-1..STR-3, PRJ-2): works on batch and streaming DataFrames alike.

``strict`` reproduces the reference: a fixed schema where a field whose JSON type drifts (an
int sent as ``"102"`` or ``2.0``, a price sent as ``"$149.99"``) becomes NULL while the other
fields survive, and epoch-millisecond times give NULL (ledger L12, L13).  ``lenient`` reads
the drifting fields as text and repairs them with ``try_cast`` (NULL only when truly
unreadable) and also reads epoch-millisecond times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.time import parse_event_time

# The event schema of the stream (14 fields).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("device", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("search_term", T.StringType()),
        T.StructField("cart_value", T.DoubleType()),
    ]
)
# Fixed value: the ``_source_system`` tag of clickstream rows in Bronze.
SOURCE_SYSTEM = "eventhub_clickstream"
_DRIFTING_INTS = ("customer_id", "product_id", "quantity")


def _lenient_int(c):
    # "102" -> 102, "2.0" -> 2, 2.5 -> NULL, "null" -> NULL
    d = F.trim(F.col(c)).try_cast("double")
    return F.when(d == F.floor(d), d.try_cast("int"))


def decode_events(
    raw: DataFrame,
    mode: str = "strict",
    value_col: str = "value",
    broker_time_col: str = "timestamp",
    with_metadata: bool = True,
    keep_message: bool = False,
) -> DataFrame:
    """Broker rows (``value`` bytes/string, ``timestamp``) -> one typed row per event.

    Narrow projections only (no shuffle, no state), so each micro-batch is a map-only job.  ``keep_message`` keeps the
    message's text as ``json_value``.
    """
    msgs = raw.select(
        F.col(value_col).cast("string").alias("json_value"),
        F.col(broker_time_col).cast("timestamp").alias("kafka_timestamp"),
    )
    if mode == "strict":
        parsed = msgs.select(F.from_json("json_value", EVENT_SCHEMA).alias("data"), "kafka_timestamp", "json_value")
        flat = parsed.select("data.*", "kafka_timestamp", *(["json_value"] if keep_message else []))
    elif mode == "lenient":
        text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_SCHEMA.fields])
        parsed = msgs.select(F.from_json("json_value", text_schema).alias("data"), "kafka_timestamp", "json_value")
        flat = parsed.select("data.*", "kafka_timestamp", "json_value")
        repaired = {c: _lenient_int(c) for c in _DRIFTING_INTS}
        repaired["cart_value"] = F.regexp_replace(F.trim("cart_value"), r"^\$", "").try_cast("double")
        flat = flat.withColumns(repaired)
        flat = flat.withColumn(
            "_corrupt_record", F.when(F.col("event_id").isNull() & F.col("event_type").isNull(), F.col("json_value"))
        )
        flat = flat if keep_message else flat.drop("json_value")
    else:
        raise ValueError(f"unknown decode mode {mode!r}")
    out = flat.withColumn("event_time", parse_event_time("event_time", mode))
    if with_metadata:
        out = out.withColumns({"_ingested_at": F.current_timestamp(), "_source_system": F.lit(SOURCE_SYSTEM)})
    return out


NOT_JSON, NOT_AN_OBJECT, NO_ID = "not json", "not an object", "no event_id"


def decode_all(raw: DataFrame, mode: str = "strict") -> DataFrame:
    """``decode_events`` that loses nothing of a message (STR-2, PRJ-2).

    ``_unknown`` is a VARIANT object of the keys that the event schema does not have (NULL if there are none), with
    their values and types as sent.  ``_reason`` is NULL for an event and tells of every other message, whose text is in
    ``json_value``, why it is none: ``not json``, ``not an object`` or ``no event_id``.
    """
    flat = decode_events(raw, mode, keep_message=True)
    whole = F.try_parse_json("json_value")
    fields = F.try_variant_get(whole, "$", "map<string,variant>")
    unknown = F.map_filter(fields, lambda k, _: ~k.isin(*[f.name for f in EVENT_SCHEMA.fields]))
    reason = F.when(whole.isNull(), F.lit(NOT_JSON)).when(fields.isNull(), F.lit(NOT_AN_OBJECT)).otherwise(F.lit(NO_ID))
    return flat.withColumns(
        {
            "_unknown": F.when(F.size(unknown) > 0, F.to_variant_object(unknown)),
            "_reason": F.when(F.col("event_id").isNull(), reason),
        }
    )


def drift_report(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Per field: values present in the message that ``strict`` loses, that ``lenient`` repairs,
    and that stay unreadable; plus malformed messages.  One pass, one global aggregate.

    A field is *present* when the message carries a non-null JSON value for it.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_SCHEMA.fields])
    msgs = raw.select(F.col(value_col).cast("string").alias("v"))
    parsed = msgs.select(
        F.from_json("v", EVENT_SCHEMA).alias("s"),
        F.from_json("v", text_schema).alias("t"),
    )
    lenient = {c: _lenient_int(c) for c in _DRIFTING_INTS}
    lenient["cart_value"] = F.regexp_replace(F.trim("cart_value"), r"^\$", "").try_cast("double")
    lenient["event_time"] = parse_event_time("event_time", "lenient")
    strict_time = parse_event_time(F.col("s.event_time"), "strict")
    aggs = [F.count_if(F.col("t").isNull() | F.col("t.event_id").isNull() & F.col("t.event_type").isNull()).alias("_malformed")]
    fields = ["event_time", *_DRIFTING_INTS, "cart_value"]
    for c in fields:
        present = F.col(f"t.{c}").isNotNull() & (F.lower(F.trim(F.col(f"t.{c}"))) != "null")
        strict_val = strict_time if c == "event_time" else F.col(f"s.{c}")
        lenient_val = lenient[c]
        aggs += [
            F.count_if(present & strict_val.isNull()).alias(f"{c}__lost_strict"),
            F.count_if(present & strict_val.isNull() & lenient_val.isNotNull()).alias(f"{c}__repaired"),
            F.count_if(present & lenient_val.isNull()).alias(f"{c}__unreadable"),
        ]
    # the lenient expressions read top-level text columns: expose the text struct's fields
    flat = parsed.select("s", "t", *[F.col(f"t.{c}").alias(c) for c in fields])
    one = flat.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__lost_strict`, `{c}__repaired`, `{c}__unreadable`" for c in fields)
    per_field = one.selectExpr(f"stack({len(fields)}, {stack}) as (field, lost_strict, repaired, unreadable)")
    malformed = one.selectExpr("'<message>' as field", "_malformed as lost_strict", "0L as repaired", "_malformed as unreadable")
    return per_field.unionByName(malformed)
