"""Table schemas: raw transactions, the stream payload, alerts and rejects."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw transaction file layout (16 columns).  Spark's CSV/JSON readers do not
# enforce nullable=False, so required-ness is checked by the validity filter.
RAW_TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("account_id", T.StringType(), False),
        T.StructField("transaction_date", T.DateType(), False),
        T.StructField("transaction_time", T.StringType(), False),
        T.StructField("amount", T.DecimalType(18, 2), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("transaction_type", T.StringType(), False),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("merchant_name", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("country_code", T.StringType(), True),
        T.StructField("device_id", T.StringType(), True),
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("updated_at", T.TimestampType(), False),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_TRANSACTION_SCHEMA.fields]

CORRUPT_COLUMN = "_corrupt_record"

RAW_WITH_CORRUPT_SCHEMA = T.StructType(
    RAW_TRANSACTION_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Columns of the conformed fact table, in warehouse order (26 columns).
FACT_COLUMNS = [
    "transaction_id",
    "account_id",
    "transaction_date",
    "transaction_time",
    "amount",
    "amount_usd",
    "currency",
    "exchange_rate",
    "transaction_type",
    "merchant_id",
    "merchant_name",
    "category",
    "status",
    "country_code",
    "device_id",
    "ip_address",
    "day_of_week",
    "is_weekend",
    "transaction_hour",
    "is_international",
    "is_high_value",
    "ingestion_timestamp",
    "source_file",
    "ingestion_date",
    "created_at",
    "updated_at",
]

FACT_TYPES: dict[str, T.DataType] = {
    "transaction_id": T.StringType(),
    "account_id": T.StringType(),
    "transaction_date": T.DateType(),
    "transaction_time": T.StringType(),
    "amount": T.DecimalType(18, 2),
    "amount_usd": T.DecimalType(18, 2),
    "currency": T.StringType(),
    "exchange_rate": T.DecimalType(10, 6),
    "transaction_type": T.StringType(),
    "merchant_id": T.StringType(),
    "merchant_name": T.StringType(),
    "category": T.StringType(),
    "status": T.StringType(),
    "country_code": T.StringType(),
    "device_id": T.StringType(),
    "ip_address": T.StringType(),
    "day_of_week": T.ShortType(),
    "is_weekend": T.BooleanType(),
    "transaction_hour": T.ShortType(),
    "is_international": T.BooleanType(),
    "is_high_value": T.BooleanType(),
    "ingestion_timestamp": T.TimestampType(),
    "source_file": T.StringType(),
    "ingestion_date": T.DateType(),
    "created_at": T.TimestampType(),
    "updated_at": T.TimestampType(),
}

# Columns the upsert overwrites on a match.
UPSERT_UPDATE_COLUMNS = ("amount", "amount_usd", "status", "updated_at", "exchange_rate", "is_high_value")

# Stream record as delivered by the broker: base64 payload plus a sequence number.
STREAM_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("sequence_number", T.StringType(), True),
        T.StructField("data", T.StringType(), True),
        T.StructField("arrival_ts", T.TimestampType(), True),
    ]
)

# JSON transaction inside a stream payload (silver-shaped, dynamic in source).
STREAM_TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("account_id", T.StringType(), True),
        T.StructField("amount_usd", T.DecimalType(18, 2), True),
        T.StructField("transaction_type", T.StringType(), True),
        T.StructField("transaction_hour", T.IntegerType(), True),
        T.StructField("is_international", T.BooleanType(), True),
        T.StructField("country_code", T.StringType(), True),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("device_id", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
        T.StructField(CORRUPT_COLUMN, T.StringType(), True),
    ]
)

SIGNAL_TYPE = T.StructType(
    [
        T.StructField("rule", T.StringType(), False),
        T.StructField("triggered", T.BooleanType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("reason", T.StringType(), False),
    ]
)
