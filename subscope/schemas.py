"""Column names and schemas of the usage tables."""

from pyspark.sql import types as T

# The schema of the raw customer table, in file order.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("account_length", T.IntegerType()),
        T.StructField("area_code", T.StringType()),
        T.StructField("international_plan", T.StringType()),
        T.StructField("voice_mail_plan", T.StringType()),
        T.StructField("number_vmail_messages", T.IntegerType()),
        T.StructField("total_day_minutes", T.DoubleType()),
        T.StructField("total_day_calls", T.IntegerType()),
        T.StructField("total_day_charge", T.DoubleType()),
        T.StructField("total_eve_minutes", T.DoubleType()),
        T.StructField("total_eve_calls", T.IntegerType()),
        T.StructField("total_eve_charge", T.DoubleType()),
        T.StructField("total_night_minutes", T.DoubleType()),
        T.StructField("total_night_calls", T.IntegerType()),
        T.StructField("total_night_charge", T.DoubleType()),
        T.StructField("total_intl_minutes", T.DoubleType()),
        T.StructField("total_intl_calls", T.IntegerType()),
        T.StructField("total_intl_charge", T.DoubleType()),
        T.StructField("customer_service_calls", T.IntegerType()),
        T.StructField("churn", T.StringType()),
    ]
)

# The schema of one usage event, as carried in the JSON payload.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("call_duration", T.DoubleType()),
        T.StructField("call_type", T.StringType()),
        T.StructField("call_direction", T.StringType()),
        T.StructField("call_successful", T.IntegerType()),
        T.StructField("data_usage_mb", T.DoubleType()),
        T.StructField("sms_count", T.IntegerType()),
        T.StructField("roaming", T.IntegerType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("network_type", T.StringType()),
        T.StructField("location_lat", T.DoubleType()),
        T.StructField("location_lon", T.DoubleType()),
    ]
)

ID = "customer_id"
LABEL = "churn"
FLAGS = ("churn", "international_plan", "voice_mail_plan")

# Columns that never take part in cleaning statistics or in per-class profiles.
ID_COLUMNS = (ID,)

# The model's feature list; its order is the order of the vector.
FEATURES = (
    "account_length",
    "international_plan",
    "voice_mail_plan",
    "number_vmail_messages",
    "total_day_minutes",
    "total_day_calls",
    "total_day_charge",
    "total_eve_minutes",
    "total_eve_calls",
    "total_eve_charge",
    "total_night_minutes",
    "total_night_calls",
    "total_night_charge",
    "total_intl_minutes",
    "total_intl_calls",
    "total_intl_charge",
    "customer_service_calls",
    "total_minutes",
    "total_calls",
    "total_charge",
    "avg_minutes_per_call",
    "daytime_ratio",
)
