"""Decode JSON order messages, and the producer-side encoding of order events.

Decoding is ``from_json`` in PERMISSIVE mode with a corrupt-record column: a message is kept
only when it parsed into a struct *and* no field failed (a bad field value fails the whole
message, as in the original decoder). Text fields take any scalar, but an object or array in one
fails the message too; an empty text for an amount or the time is null. Unknown fields (such as the producer's ``totalValue``) are
ignored, missing fields stay null. Outcomes are counted by an aggregate or ``observe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.columns import PURCHASE_TS_FORMAT, event_value
from cartwheel.schemas import ORDER_EVENT, ORDER_EVENT_COLUMNS

CORRUPT = "_corrupt_record"
DECODE_SCHEMA = T.StructType(ORDER_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
DECODE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "timestampFormat": PURCHASE_TS_FORMAT,
}

TEXT_FIELDS = [f.name for f in ORDER_EVENT.fields if f.dataType == T.StringType()]
# "price": "" and the like; inside a JSON string the quotes around the name would be escaped
_EMPTY = r'("(?:' + "|".join(c for c in ORDER_EVENT_COLUMNS if c not in TEXT_FIELDS) + r')"\s*:\s*)"\s*"'

# Decode outcomes.
VALID, MALFORMED, EMPTY = "valid", "malformed", "empty"


def holds_structure(message: Column, parsed: Column) -> Column:
    """Whether a text field was given an object or array. Only texts that begin like one are looked at again."""
    out = F.lit(False)
    for c in TEXT_FIELDS:
        kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(message), f"$.{c}", "variant"))
        looks = F.coalesce(parsed[c].rlike(r"^[{\[]"), F.lit(False))
        out = out | F.when(looks, F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.lit(False))).otherwise(F.lit(False))
    return out


def decode_outcome(message: Column, parsed: Column) -> Column:
    text = F.trim(message.cast("string"))
    return (F.when(message.isNull() | (F.coalesce(text, F.lit("")) == ""), F.lit(EMPTY))
             .when(parsed.isNull() | parsed[CORRUPT].isNotNull(), F.lit(MALFORMED))
             .when(holds_structure(message.cast("string"), parsed), F.lit(MALFORMED))
             .otherwise(F.lit(VALID)))


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``event`` (parsed struct) and ``outcome`` (valid / malformed / empty).

    The parsed struct is produced as generator output (``inline`` of a one-element array):
    a filter on the outcome cannot be pushed below a generator, so the optimizer does not
    substitute ``from_json`` into the filter and every field reference (which would parse
    each message several times)."""
    text = F.regexp_replace(F.col(value_col).cast("string"), _EMPTY, "$1null")
    parsed = F.from_json(text, DECODE_SCHEMA, DECODE_OPTIONS)
    others = [c for c in messages.columns if c != value_col]
    row = F.struct(*[F.col(c) for c in others], F.col(value_col), parsed.alias("event"))
    once = messages.select(F.inline(F.array(row)))
    return once.withColumn("outcome", decode_outcome(F.col(value_col), F.col("event")))


def decode_order_messages(messages: DataFrame, value_col: str = "value", observe: bool = False) -> DataFrame:
    """Valid messages as order events; the rest is dropped (count them with ``decode_outcomes``,
    or with ``observe=True`` as the ``deserializationErrors`` metric of a stream, M6)."""
    p = parse_messages(messages, value_col)
    if observe:
        p = p.observe("decoder", F.count_if(F.col("outcome") != VALID).alias("deserializationErrors"))
    return p.where(F.col("outcome") == VALID).select(*[F.col(f"event.{c}").alias(c) for c in ORDER_EVENT_COLUMNS])


def decode_outcomes(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """outcome, messages: how many messages were kept or dropped, and why."""
    return (parse_messages(messages, value_col).groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("messages")))


def encode_order_events(events: DataFrame, time_text: Column | None = None, more: list[str] | None = None) -> DataFrame:
    """Producer format: snake_case fields, purchase time as ``yyyy-MM-dd HH:mm:ss`` text, nulls
    written, and the derived ``totalValue`` field appended. Output: key (order_id), value.
    ``time_text`` replaces the purchase-time text (to produce messages with a bad field); ``more``
    names further columns to write. Amounts have two digits, more only where they are not zero."""
    ts_text = F.date_format("order_purchase_timestamp", PURCHASE_TS_FORMAT) if time_text is None else time_text
    fields = [ts_text.alias(c) if c == "order_purchase_timestamp" else F.col(c) for c in ORDER_EVENT_COLUMNS]
    fields += [event_value().alias("totalValue"), *[F.col(c) for c in more or ()]]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # the zeros after the second digit; inside a JSON string the quotes around a name would be escaped
    body = F.regexp_replace(body, r'("(?:price|freight_value|totalValue)":-?\d+\.\d{2}\d*?)0+(?=[,}])', "$1")
    return events.select(F.col("order_id").alias("key"), body.alias("value"))
