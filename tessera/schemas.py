"""Explicit schemas for every layer.  Nothing is ever inferred.

Schema inference on the raw layer fails on an empty folder, fails on a nested
field absent from one batch, and silently widens mixed int/ISO values to
strings, so every read in the engine passes one of these.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    MapType, StringType, StructField, StructType, TimestampType, VariantType,
)

S = StringType()
L = LongType()

# Raw change record as delivered by the key-value table's change stream.
# Images stay undecoded (tagged attribute maps) until decode_attributes runs.
# Fixed values (the stream's record format): top-level keys eventName,
# eventTime, dynamodb; inside dynamodb: SequenceNumber, Keys, NewImage, OldImage.
CHANGE_RECORD = StructType([
    StructField("eventName", S),
    StructField("eventTime", TimestampType()),
    StructField("dynamodb", StructType([
        StructField("SequenceNumber", S),
        StructField("Keys", VariantType()),
        StructField("NewImage", VariantType()),
        StructField("OldImage", VariantType()),
    ])),
    # the whole line, where it is no JSON record
    StructField("_corrupt_record", S),
])

INDEX_KEYS = ["GSI1PK", "GSI1SK", "GSI2PK", "GSI2SK", "GSI3PK", "GSI3SK", "GSI4PK", "GSI4SK"]

# Decoded item: the attributes the silver and gold layers read.  Epoch times
# are seconds (long); due_date and last_login are ISO strings as stored.
ITEM = StructType(
    [StructField("PK", S), StructField("SK", S)]
    + [StructField(k, S) for k in INDEX_KEYS]
    + [
        StructField("title", S),
        StructField("description", S),
        StructField("status", S),
        StructField("priority", S),
        StructField("category", S),
        StructField("due_date", S),
        StructField("created_at", L),
        StructField("updated_at", L),
        StructField("completed_at", L),
        StructField("email", S),
        StructField("name", S),
        StructField("last_login", S),
        StructField("verification_status", S),
    ]
)

# Bronze record (one JSON line per change).
CDC_ENVELOPE = StructType([
    StructField("event_name", S),
    StructField("event_time", TimestampType()),
    StructField("sequence_number", S),
    StructField("table_name", S),
    StructField("processed_at", TimestampType()),
    StructField("partition_key", S),
    StructField("data", ITEM),
    # text of the numbers that don't parse, by attribute
    StructField("raw", MapType(S, S)),
])

SILVER_USERS = StructType([
    StructField("user_id", S), StructField("email", S), StructField("name", S),
    StructField("created_at", L), StructField("updated_at", L),
    StructField("event_count", L), StructField("event_types", L),
    StructField("created_date", DateType()),
    StructField("year", IntegerType()), StructField("month", IntegerType()),
    StructField("day", IntegerType()),
])

SILVER_TASKS = StructType([
    StructField("task_id", S), StructField("user_id", S), StructField("title", S),
    StructField("description", S), StructField("status", S), StructField("priority", S),
    StructField("category", S), StructField("created_at", L), StructField("updated_at", L),
    StructField("event_count", L), StructField("event_types", L),
    StructField("created_date", DateType()),
    StructField("year", IntegerType()), StructField("month", IntegerType()),
    StructField("day", IntegerType()),
])

# What silver keeps of each entity between deliveries (operators/silver.entity_partials).
_HELD = StructType([
    StructField("at", StructType([StructField("t", TimestampType()), StructField("s", DecimalType(38, 0))])),
    StructField("attrs", StructType([StructField(c, S) for c in (
        "user_id", "email", "name", "title", "description", "status", "priority", "category")])),
])
PARTIALS = StructType([
    StructField("entity_type", S), StructField("entity_id", S),
    StructField("earliest", _HELD), StructField("latest", _HELD),
    StructField("created_at", L), StructField("updated_at", L), StructField("event_count", L),
    StructField("event_names", ArrayType(S)),
])

IDEMPOTENCY = StructType([
    StructField("request_id", S),
    StructField("response_data", S),
    StructField("target_task_pk", S),
    StructField("target_task_sk", S),
    StructField("http_status_code", IntegerType()),
    StructField("expiration_timestamp", L),
    StructField("created_at", L),
])

METRIC = StructType([
    StructField("namespace", S),
    StructField("metric", S),
    StructField("value", DoubleType()),
    StructField("unit", S),
    StructField("ts", TimestampType()),
])

APP_LOG = StructType([
    StructField("timestamp", TimestampType()),
    StructField("level", S),
    StructField("request_id", S),
    StructField("user_id", S),
    StructField("component", S),
    StructField("operation", S),
    StructField("duration_ms", L),
    StructField("status", S),
    StructField("message", S),
    StructField("metadata", MapType(S, S)),
])

# Request events as seen by the HTTP layer: headers plus the authorizer
# claims, both kept as semi-structured values.
REQUEST_EVENT = StructType([
    StructField("ts", TimestampType()),
    StructField("routeKey", S),
    StructField("headers", MapType(S, S)),
    StructField("requestContext", VariantType()),
    StructField("body", S),
])

QUALITY_RULES = StructType([
    StructField("required_fields", ArrayType(S)),
    StructField("data_types", MapType(S, S)),
    StructField("constraints", MapType(S, StructType([
        StructField("min", DoubleType()), StructField("max", DoubleType()),
        StructField("pattern", S)]))),
])

BOOL = BooleanType()
