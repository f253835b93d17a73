"""Ingest path: decode -> flatten -> coerce -> validate -> split.

The same functions serve a batch DataFrame and a streaming one (they are
stateless projections and filters), so a topic can be drained in batch or
consumed continuously with identical semantics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import vocab as V

# The transaction event as published on the topic (17 fields).
EVENT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("location", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("device_info", T.MapType(T.StringType(), T.StringType())),
    T.StructField("status", T.StringType()),
    T.StructField("commission_type", T.StringType()),
    T.StructField("commission_amount", T.LongType()),
    T.StructField("vat_amount", T.LongType()),
    T.StructField("total_amount", T.LongType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("risk_level", T.IntegerType()),
    T.StructField("failure_reason", T.StringType()),
])

# Flattened transaction (20 scalar columns).
FLAT_COLUMNS = [
    "transaction_id", "event_time", "customer_id", "merchant_id", "merchant_category",
    "payment_method", "amount", "status", "commission_type", "commission_amount",
    "vat_amount", "total_amount", "customer_type", "risk_level", "failure_reason",
    "location_lat", "location_lng", "device_os", "device_app_version", "device_model",
]

def parse_ts(col: Column, fmt: str | None = None) -> Column:
    """Parse text to a timestamp; a malformed value becomes NULL (not an error).

    Without a pattern any ISO time is read: with or without a zone, with no
    or up to six digits of a second.
    """
    return col.try_cast("timestamp") if fmt is None else F.try_to_timestamp(col, F.lit(fmt))


def parse_date(col: Column, fmt: str) -> Column:
    """B3 for dates, e.g. ``dd-MM-yyyy``; malformed -> NULL."""
    return F.to_date(F.try_to_timestamp(col, F.lit(fmt)))


def decode(df: DataFrame, schema: T.StructType = EVENT_SCHEMA, value_col: str = "value",
           keep: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """B1: parse the message value (bytes or text) by a fixed schema into ``data``.

    Columns named in ``keep`` (e.g. the record timestamp = ingestion time) are
    carried along, renamed with an ``record_`` prefix.

    The parse is emitted through ``inline`` (a Generate node): filters on the
    decoded fields -- validation -- then stay above it, so each message is
    parsed once. Without it Catalyst pushes such filters below the parse and
    rewrites every referenced field into its own ``from_json`` call.
    """
    extra = [F.col(c).alias(f"record_{c}") for c in keep if c in df.columns]
    parsed = F.struct(F.from_json(F.col(value_col).cast("string"), schema).alias("data"), *extra)
    return df.select(F.inline(F.array(parsed)))


def flatten(decoded: DataFrame) -> DataFrame:
    """B2: struct and maps to the 20 flat columns; the ISO time is parsed in UTC."""
    d = lambda c: F.col(f"data.{c}")
    extra = [c for c in decoded.columns if c.startswith("record_")]
    return decoded.select(
        d("transaction_id").alias("transaction_id"),
        parse_ts(d("timestamp")).alias("event_time"),
        *[d(c).alias(c) for c in FLAT_COLUMNS[2:15]],
        F.try_element_at(d("location"), F.lit("lat")).alias("location_lat"),
        F.try_element_at(d("location"), F.lit("lng")).alias("location_lng"),
        F.try_element_at(d("device_info"), F.lit("os")).alias("device_os"),
        F.try_element_at(d("device_info"), F.lit("app_version")).alias("device_app_version"),
        F.try_element_at(d("device_info"), F.lit("device_model")).alias("device_model"),
        *[F.col(c) for c in extra],
    )


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to the given types; a value that does not convert is NULL."""
    return df.select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def validate(
    df: DataFrame,
    as_of: Column | None = None,
    max_age: str = "1 day",
    amount_includes_commission: bool = False,
    known_os: list[str] = V.KNOWN_OS,
) -> DataFrame:
    """Add ``error_code``: the first failing rule wins, NULL when valid.

    Rules in order: device (a mobile payment needs a known os), amount
    (amount + vat [+ commission] = total), time (not after ``as_of`` and not
    older than ``max_age`` before it). ``as_of`` defaults to the record's
    ingestion time column ``record_timestamp`` when present, else the current
    time. The reference's amount rule includes the commission, which the
    producer never adds (quirk Q3); ``amount_includes_commission=True``
    restores it.
    """
    if as_of is None:
        as_of = F.col("record_timestamp") if "record_timestamp" in df.columns else F.current_timestamp()
    expected = F.col("amount") + F.col("vat_amount")
    if amount_includes_commission:
        expected = expected + F.col("commission_amount")
    bad_device = (F.col("payment_method") == "mobile") & ~F.coalesce(F.col("device_os").isin(*known_os), F.lit(False))
    bad_amount = ~F.coalesce(expected == F.col("total_amount"), F.lit(False))
    bad_time = (F.col("event_time") > as_of) | (F.col("event_time") < as_of - F.expr(f"INTERVAL {max_age}"))
    code = (
        F.when(bad_device, "ERR_DEVICE")
        .when(bad_amount, "ERR_AMOUNT")
        .when(F.coalesce(bad_time, F.lit(True)), "ERR_TIME")
    )
    return df.withColumn("error_code", code)


def split_valid(validated: DataFrame, pass_codes: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by ``error_code``; codes in ``pass_codes`` are accepted.

    Both sides are filters over the same plan: persist ``validated`` (or use
    ``foreachBatch`` on a stream) when both are written.
    """
    ok = F.col("error_code").isNull()
    if pass_codes:
        ok = ok | F.col("error_code").isin(*pass_codes)
    return validated.filter(ok), validated.filter(~ok)


def to_error_log(rejected: DataFrame, original_cols: list[str] = FLAT_COLUMNS) -> DataFrame:
    """(key, value) error records: transaction_id, error_codes, original_data."""
    original = F.struct(*[F.col(c) for c in original_cols if c in rejected.columns])
    value = F.to_json(
        F.struct(
            F.coalesce(F.col("transaction_id"), F.lit("UNKNOWN")).alias("transaction_id"),
            F.col("error_code").alias("error_codes"),
            original.alias("original_data"),
        ),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    return rejected.select(F.coalesce(F.col("transaction_id"), F.lit("UNKNOWN")).alias("key"), value.alias("value"))


_FLAT_TYPES = {f.name: f.dataType for f in EVENT_SCHEMA.fields} | {
    "event_time": T.StringType(), "location_lat": T.DoubleType(), "location_lng": T.DoubleType(),
    "device_os": T.StringType(), "device_app_version": T.StringType(), "device_model": T.StringType()}
ERROR_LOG_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("error_codes", T.StringType()),
    T.StructField("original_data", T.StructType([T.StructField(c, _FLAT_TYPES[c]) for c in FLAT_COLUMNS])),
])


def decode_error_log(messages: DataFrame) -> DataFrame:
    """A10: parse error records, with every field of the original record;
    messages that do not decode to one are skipped."""
    parsed = messages.select(F.from_json(F.col("value").cast("string"), ERROR_LOG_SCHEMA).alias("e"))
    original = [F.col(f"e.original_data.{c}").alias(c) for c in FLAT_COLUMNS if c not in ("transaction_id", "event_time")]
    return parsed.filter(F.col("e.transaction_id").isNotNull() & F.col("e.error_codes").isNotNull()).select(
        F.col("e.transaction_id").alias("transaction_id"),
        F.col("e.error_codes").alias("error_codes"),
        F.col("e.original_data.event_time").try_cast("timestamp").alias("event_time"),
        *original,
    )


def to_alerts(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Alert records as (key, JSON value) for any sink (topic, files)."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def ingest(raw: DataFrame, **validate_kwargs) -> DataFrame:
    """decode -> flatten -> validate in one projection; stream or batch."""
    return validate(flatten(decode(raw)), **validate_kwargs)


def transactions_from_messages(raw: DataFrame, **validate_kwargs) -> DataFrame:
    """The accepted, flattened transactions of raw (key, value, timestamp) messages; stream or batch."""
    accepted, _ = split_valid(ingest(raw, **validate_kwargs))
    return accepted.select(*FLAT_COLUMNS)
