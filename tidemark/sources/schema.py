"""Canonical input schemas (customers, transactions); ids are text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("signup_date", T.DateType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("industry", T.StringType(), True),
        T.StructField("subscription_type", T.StringType(), True),
        T.StructField("monthly_fee", T.DoubleType(), True),
    ]
)

# amount is read as text by the raw loader and coerced by ``clean_transactions``.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("transaction_date", T.DateType(), True),
        T.StructField("amount", T.StringType(), True),
        T.StructField("payment_method", T.StringType(), True),
        T.StructField("transaction_status", T.StringType(), True),
    ]
)


def require_columns(df: DataFrame, schema: T.StructType, name: str) -> None:
    """Fail fast when a required input column is absent."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing required columns {missing}")
