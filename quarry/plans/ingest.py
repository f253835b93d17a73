"""Registered ingest queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import ingest as I
from quarry.operators import reports as R
from quarry.plans.registry import query
from quarry.sources.fixtures import raw_messages, transactions
from quarry.sources.tables import load

RAW = ("transactions", "raw_flat")
VAL = ("transactions", "raw_flat", "validated")
SCALARS = [f.name for f in I.EVENT_SCHEMA.fields if not isinstance(f.dataType, T.MapType)]


@query("json_decode", """
SELECT transaction_id,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp,
       customer_id, merchant_id, merchant_category, payment_method, amount, status, commission_type,
       commission_amount, vat_amount, total_amount, customer_type, risk_level, failure_reason
FROM raw_flat""", RAW)
def q_json_decode(spark, sf):
    return I.decode(raw_messages(spark, sf)).select(*[F.col(f"data.{c}").alias(c) for c in SCALARS])


@query("flatten_transactions", """
SELECT * EXCLUDE (ingest_time) FROM raw_flat""", RAW)
def q_flatten(spark, sf):
    return I.flatten(I.decode(raw_messages(spark, sf), keep=()))


@query("parse_dates", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority ELSE strftime(o_orderdate, '%d-%m-%Y') END AS text,
  CAST(try_strptime(CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority ELSE strftime(o_orderdate, '%d-%m-%Y') END,
                    '%d-%m-%Y') AS DATE) AS parsed
FROM orders""")
def q_parse_dates(spark, sf):
    o = load(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "dd-MM-yyyy"))
    return o.select("o_orderkey", text.alias("text")).withColumn("parsed", I.parse_date(F.col("text"), "dd-MM-yyyy"))


_STRING_EVENT = T.StructType([
    T.StructField(f.name, T.StringType()) if not isinstance(f.dataType, T.MapType) else f
    for f in I.EVENT_SCHEMA.fields
])


@query("coerce_types", """
SELECT transaction_id, amount, commission_amount, vat_amount, total_amount, risk_level,
       CAST(NULL AS BIGINT) AS merchant_id
FROM raw_flat""", RAW)
def q_coerce(spark, sf):
    d = I.decode(raw_messages(spark, sf), schema=_STRING_EVENT, keep=())
    cols = ["transaction_id", "amount", "commission_amount", "vat_amount", "total_amount", "risk_level", "merchant_id"]
    flat = d.select(*[F.col(f"data.{c}").alias(c) for c in cols])
    return I.coerce(flat, {
        "amount": "bigint", "commission_amount": "bigint", "vat_amount": "bigint",
        "total_amount": "bigint", "risk_level": "int", "merchant_id": "bigint",
    })


@query("validate_transactions", """
SELECT transaction_id, error_code FROM validated""", VAL)
def q_validate(spark, sf):
    return I.ingest(raw_messages(spark, sf)).select("transaction_id", "error_code")


@query("ingest_valid", """
SELECT * EXCLUDE (ingest_time, error_code) FROM validated WHERE error_code IS NULL""", VAL)
def q_ingest_valid(spark, sf):
    ok, _ = I.split_valid(I.ingest(raw_messages(spark, sf)))
    return ok.select(*I.FLAT_COLUMNS)


_ERR_SQL = """
SELECT * EXCLUDE (error_code, ingest_time), error_code AS error_codes FROM validated WHERE error_code IS NOT NULL"""


@query("ingest_errors", _ERR_SQL, VAL)
def q_ingest_errors(spark, sf):
    _, bad = I.split_valid(I.ingest(raw_messages(spark, sf)))
    return I.decode_error_log(I.to_error_log(bad))


@query("error_log_decode", _ERR_SQL, VAL)
def q_error_log_decode(spark, sf):
    raw = raw_messages(spark, sf)
    _, bad = I.split_valid(I.ingest(raw))
    # The error topic also receives messages that are not error records.
    mixed = I.to_error_log(bad).unionByName(raw.select("key", "value"))
    return I.decode_error_log(mixed)


@query("peek_summary", """
SELECT merchant_id, count(*) AS total_trxs, CAST(sum(total_amount) AS BIGINT) AS total_trx_value
FROM transactions GROUP BY merchant_id ORDER BY merchant_id LIMIT 5""", ("transactions",))
def q_peek(spark, sf):
    s = R.merchant_summary(transactions(spark, sf)).select("merchant_id", "total_trxs", "total_trx_value")
    return R.top_k(s, 5, [F.col("merchant_id")])


# The reference consumer's literal behaviour: its amount rule adds the
# commission (which the producer never includes, quirk Q3), and it lets
# ERR_AMOUNT through, so only device errors -- and time errors on rows that
# pass the amount rule -- are rejected.
@query("ingest_valid_reference_rules", """
WITH v AS (
  SELECT *, CASE WHEN payment_method = 'mobile' AND coalesce(device_os IN ('iOS', 'Android'), false) = false THEN 'ERR_DEVICE'
                 WHEN amount + vat_amount + commission_amount <> total_amount THEN 'ERR_AMOUNT'
                 WHEN event_time > ingest_time OR event_time < ingest_time - INTERVAL 1 DAY THEN 'ERR_TIME'
            END AS error_code
  FROM raw_flat)
SELECT * EXCLUDE (ingest_time) FROM v WHERE error_code IS NULL OR error_code = 'ERR_AMOUNT'""", RAW)
def q_ingest_valid_reference(spark, sf):
    ok, _ = I.split_valid(I.ingest(raw_messages(spark, sf), amount_includes_commission=True),
                          pass_codes=("ERR_AMOUNT",))
    return ok.select(*I.FLAT_COLUMNS, "error_code")
