"""Canonical schemas of the three sources and the column lists derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw e-commerce transactions as they arrive in CSV: everything but the ids
# and label is text until ``correct_data_types`` casts it.
ECOM_RAW = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("signup_time", T.StringType()),
    T.StructField("purchase_time", T.StringType()),
    T.StructField("purchase_value", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("age", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("class", T.IntegerType()),
])

BANK_FEATURES = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]

BANK_RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in BANK_FEATURES]
    + [T.StructField("Class", T.IntegerType())]
)

IP_RANGES_RAW = T.StructType([
    T.StructField("lower_bound_ip_address", T.StringType()),
    T.StructField("upper_bound_ip_address", T.StringType()),
    T.StructField("country", T.StringType()),
])

# Columns whose values are identifiers or labels: never imputed, never scaled.
PROTECTED = ("user_id", "device_id", "ip_address", "class", "Class")

ECOM_DATETIME = ("signup_time", "purchase_time")
ECOM_NUMERIC = ("purchase_value", "age")
BANK_NUMERIC = tuple(BANK_FEATURES)

# Columns dropped before the e-commerce split: keys, raw times and the label.
ECOM_NON_FEATURES = ("class", "user_id", "device_id", "signup_time", "purchase_time",
                     "ip_address")

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df, exclude=()) -> list[str]:
    """Names of numeric columns, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df, exclude=()) -> list[str]:
    """Names of string columns, in schema order."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def datetime_columns(df) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))]
