"""Usage tables derived from the test tables.

The projections are written in the common subset of Spark SQL and DuckDB SQL, so the
same text gives the input of a query here and of its check there.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_SCHEMA

# Raw customer rows, from lineitem: NULL flags and minutes, outliers beyond three sigma,
# rows without any minutes or calls, and one flag that is set on fewer than a tenth.
USAGE_COLUMNS = {
    "customer_id": "concat('c', cast(l_orderkey as string), '-', "
    "cast(l_linenumber as string), '-', cast(l_partkey as string), '-', "
    "cast(l_suppkey as string))",
    "account_length": "cast(l_orderkey % 243 as int)",
    "area_code": "cast(408 + l_suppkey % 3 as string)",
    "international_plan": "case when l_partkey % 12 = 0 then 'yes' else 'no' end",
    "voice_mail_plan": "case when l_returnflag = 'A' then 'yes' "
    "when l_returnflag = 'R' then 'no' end",
    "number_vmail_messages": "cast(case when l_returnflag = 'A' then l_quantity "
    "else 0 end as int)",
    "total_day_minutes": "case when l_linenumber = 7 then null "
    "when l_partkey % 97 = 0 then 0.0e0 "
    "when l_partkey % 89 = 0 then l_quantity * 100 else l_quantity * 7 end",
    "total_day_calls": "cast(case when l_partkey % 97 = 0 then 0 "
    "else l_suppkey % 160 end as int)",
    "total_day_charge": "l_quantity * 7 * 0.17e0",
    "total_eve_minutes": "case when l_partkey % 97 = 0 then 0.0e0 "
    "else l_extendedprice / 300 end",
    "total_eve_calls": "cast(case when l_partkey % 97 = 0 then 0 "
    "else l_partkey % 170 end as int)",
    "total_eve_charge": "l_extendedprice / 300 * 0.085e0",
    "total_night_minutes": "case when l_partkey % 97 = 0 then 0.0e0 "
    "else l_tax * 4000 end",
    "total_night_calls": "cast(case when l_partkey % 97 = 0 then 0 "
    "else l_orderkey % 175 end as int)",
    "total_night_charge": "l_tax * 4000 * 0.045e0",
    "total_intl_minutes": "l_discount * 200",
    "total_intl_calls": "cast(l_linenumber as int)",
    "total_intl_charge": "l_discount * 200 * 0.27e0",
    "customer_service_calls": "cast(l_suppkey % 9 as int)",
    "churn": "case when l_returnflag = 'R' and l_discount >= 0.05e0 then 'yes' "
    "else 'no' end",
}

# Usage events before encoding, from events; event_ts becomes the field "timestamp".
EVENT_COLUMNS = {
    "event_id": "event_id",
    "customer_id": "concat('cust_', cast(user_id as string))",
    "event_ts": "ts",
    "call_duration": "value",
    "call_type": "case event_id % 3 when 0 then 'local' when 1 then 'international' "
    "else 'roaming' end",
    "call_direction": "case event_id % 2 when 0 then 'incoming' else 'outgoing' end",
    "call_successful": "cast(case when event_type = 'error' then 0 else 1 end as int)",
    "data_usage_mb": "value / 8",
    "sms_count": "cast(event_id % 11 as int)",
    "roaming": "cast(case when event_id % 20 = 3 then null "
    "when event_id % 10 = 1 then 1 else 0 end as int)",
    "device_type": "case event_id % 4 when 0 then 'smartphone' when 1 then 'tablet' "
    "when 2 then 'feature_phone' else 'iot' end",
    "network_type": "case event_id % 4 when 0 then '4G' when 1 then '5G' "
    "when 2 then 'LTE' else '3G' end",
    "location_lat": "37.7749e0 + (event_id % 1000) * 0.001e0 - 0.5e0",
    "location_lon": "-122.4194e0 + (user_id % 1000) * 0.001e0 - 0.5e0",
}


def _select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]


def usage_raw_sql() -> str:
    return f"select {', '.join(_select_list(USAGE_COLUMNS))} from lineitem"


def event_rows_sql() -> str:
    return f"select {', '.join(_select_list(EVENT_COLUMNS))} from events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def usage_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr(*_select_list(USAGE_COLUMNS))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr(*_select_list(EVENT_COLUMNS))


def encoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text in ``value``; every fiftieth is malformed."""
    stamp = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    fields: list[Column] = [
        (stamp if f.name == "timestamp" else F.col(f.name)).alias(f.name)
        for f in EVENT_SCHEMA.fields
    ]
    value = F.when(F.col("event_id") % 50 == 0, F.lit("{bad")).otherwise(
        F.to_json(F.struct(*fields))
    )
    return event_rows(spark, sf_dir).select(value.alias("value"))
