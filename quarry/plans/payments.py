"""Registered transaction reports (C1-C21, T2, T3, W1, W4, W5) and their oracles."""

from __future__ import annotations

from quarry.operators import reports as R
from quarry.plans import sqlparts as S
from quarry.plans.registry import query
from quarry.sources.fixtures import transactions

TX = ("transactions",)
# Segment thresholds fitted to the driver tables (FIXTURES.md section 3); the
# reference's own thresholds remain the operator's defaults.
SEG = dict(as_of="2024-01-31", min_transactions=70, min_spend=350_000_000, max_recency_days=1)


@query("merchant_category_summary", f"""
SELECT merchant_category,
  {S.category_measures()}
FROM transactions GROUP BY merchant_category""", TX)
def q_merchant_category_summary(spark, sf):
    return R.merchant_category_summary(transactions(spark, sf))


@query("customer_type_summary", f"""
SELECT customer_type,
  {S.category_measures(with_count=True)}
FROM transactions GROUP BY customer_type""", TX)
def q_customer_type_summary(spark, sf):
    return R.customer_type_summary(transactions(spark, sf))


@query("daily_summary", f"""
SELECT CAST(event_time AS DATE) AS date,
  {S.daily_measures()}
FROM transactions GROUP BY 1 ORDER BY 1 DESC""", TX)
def q_daily_summary(spark, sf):
    return R.daily_summary(transactions(spark, sf))


@query("customer_summary", f"""
SELECT customer_id,
  {S.party_measures()}
FROM transactions GROUP BY customer_id""", TX)
def q_customer_summary(spark, sf):
    return R.customer_summary(transactions(spark, sf))


@query("merchant_summary", f"""
SELECT merchant_id,
  {S.party_measures()}
FROM transactions GROUP BY merchant_id""", TX)
def q_merchant_summary(spark, sf):
    return R.merchant_summary(transactions(spark, sf))


@query("commission_performance", """
SELECT commission_type,
  CAST(sum(commission_amount) AS BIGINT) AS total_commissions,
  avg(commission_amount) AS avg_commission_per_trx,
  CAST(sum(total_amount) AS BIGINT) AS total_trx_amount,
  sum(commission_amount) / nullif(sum(total_amount), 0) AS commission_to_trx_ratio
FROM transactions GROUP BY commission_type""", TX)
def q_commission_performance(spark, sf):
    return R.commission_performance(transactions(spark, sf))


@query("hourly_transactions", f"""
SELECT {S.hour()} AS hour_of_day, {S.volume_measures()}
FROM transactions GROUP BY 1""", TX)
def q_hourly(spark, sf):
    return R.hourly_transactions(transactions(spark, sf))


@query("weekday_transactions", f"""
SELECT CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week, {S.volume_measures()}
FROM transactions GROUP BY 1""", TX)
def q_weekday(spark, sf):
    return R.weekday_transactions(transactions(spark, sf))


@query("monthly_transactions", f"""
SELECT CAST(month(event_time) AS INTEGER) AS month, {S.volume_measures()}
FROM transactions GROUP BY 1""", TX)
def q_monthly(spark, sf):
    return R.monthly_transactions(transactions(spark, sf))


@query("customer_segments", f"""
WITH a AS (
  SELECT customer_id, count(transaction_id) AS num_transactions,
         CAST(sum(total_amount) AS BIGINT) AS total_spending,
         max(event_time) AS last_transaction_time
  FROM transactions GROUP BY customer_id),
b AS (
  SELECT *, CAST(date_diff('day', CAST(last_transaction_time AS DATE), DATE '{SEG["as_of"]}') AS INTEGER) AS recency_days FROM a),
c AS (
  SELECT *,
    CASE WHEN num_transactions >= {SEG["min_transactions"]} THEN 'High Frequency' ELSE 'Low Frequency' END AS segment,
    CASE WHEN total_spending >= {SEG["min_spend"]} THEN 'High Spending' ELSE 'Low Spending' END AS spending_segment,
    CASE WHEN recency_days <= {SEG["max_recency_days"]} THEN 'Recent' ELSE 'Inactive' END AS recency_segment
  FROM b)
SELECT *, segment || '_' || spending_segment || '_' || recency_segment AS final_segment FROM c""", TX)
def q_customer_segments(spark, sf):
    return R.customer_segments(transactions(spark, sf), **SEG)


@query("merchant_comparison", """
WITH a AS (
  SELECT merchant_category,
    CAST(sum(total_amount) AS BIGINT) AS total_transaction_amount,
    avg(total_amount) AS avg_transaction_amount,
    count(transaction_id) AS num_transactions,
    CAST(sum(commission_amount) AS BIGINT) AS total_commission,
    avg(commission_amount) AS avg_commission_per_transaction,
    sum(commission_amount) / nullif(sum(total_amount), 0) AS commission_to_transaction_ratio,
    sum(CASE WHEN status = 'approved' THEN 1 ELSE 0 END) / nullif(count(transaction_id), 0) AS success_rate,
    avg(risk_level) AS avg_risk_level
  FROM transactions GROUP BY merchant_category)
SELECT *,
  CAST(row_number() OVER (ORDER BY total_transaction_amount DESC, merchant_category) AS INTEGER) AS rank_by_value,
  CAST(row_number() OVER (ORDER BY success_rate DESC, merchant_category) AS INTEGER) AS rank_by_success_rate,
  CAST(row_number() OVER (ORDER BY commission_to_transaction_ratio DESC, merchant_category) AS INTEGER) AS rank_by_ratio
FROM a""", TX)
def q_merchant_comparison(spark, sf):
    return R.merchant_comparison(transactions(spark, sf))


@query("time_of_day_summary", f"""
SELECT CASE WHEN hour(event_time) >= 6 AND hour(event_time) < 12 THEN 'Morning'
            WHEN hour(event_time) >= 12 AND hour(event_time) < 18 THEN 'Afternoon'
            WHEN hour(event_time) >= 18 AND hour(event_time) < 24 THEN 'Evening'
            ELSE 'Night' END AS time_of_day,
       {S.volume_measures()}
FROM transactions GROUP BY 1""", TX)
def q_time_of_day(spark, sf):
    return R.time_of_day_summary(transactions(spark, sf))


@query("weekly_change", """
WITH w AS (
  SELECT CAST(year(event_time) AS INTEGER) AS year, CAST(weekofyear(event_time) AS INTEGER) AS week_of_year,
         CAST(sum(total_amount) AS BIGINT) AS total_spending
  FROM transactions GROUP BY 1, 2)
SELECT year, week_of_year, total_spending,
  (total_spending - lag(total_spending) OVER (PARTITION BY year ORDER BY week_of_year))
   / nullif(lag(total_spending) OVER (PARTITION BY year ORDER BY week_of_year), 0) * 100 AS percentage_change
FROM w""", TX)
def q_weekly_change(spark, sf):
    return R.weekly_change(transactions(spark, sf))


@query("risk_by_hour", f"""
SELECT {S.hour()} AS hour, avg(risk_level) AS avg_risk_level FROM transactions GROUP BY 1""", TX)
def q_risk_by_hour(spark, sf):
    return R.risk_by_hour(transactions(spark, sf))


@query("failure_reason_by_hour", f"""
SELECT {S.hour()} AS hour, failure_reason, count(*) AS failures
FROM transactions WHERE failure_reason IS NOT NULL GROUP BY 1, 2""", TX)
def q_failure_reason_by_hour(spark, sf):
    return R.failure_reason_by_hour(transactions(spark, sf))


@query("payment_by_hour", f"""
SELECT {S.hour()} AS hour, payment_method, count(*) AS transaction_count
FROM transactions GROUP BY 1, 2""", TX)
def q_payment_by_hour(spark, sf):
    return R.payment_by_hour(transactions(spark, sf))


@query("status_by_hour", f"""
SELECT {S.hour()} AS hour,
  count(*) FILTER (WHERE status = 'approved') AS approved,
  count(*) FILTER (WHERE status = 'declined') AS declined,
  count(*) FILTER (WHERE status = 'approved')
    / nullif(count(*) FILTER (WHERE status IN ('approved', 'declined')), 0) * 100 AS approval_rate
FROM transactions GROUP BY 1""", TX)
def q_status_by_hour(spark, sf):
    return R.status_by_hour(transactions(spark, sf))


@query("payment_preference", """
WITH c AS (
  SELECT g.merchant_category, g.payment_method, count(t.transaction_id) AS n
  FROM (SELECT DISTINCT merchant_category, unnest(['online', 'pos', 'mobile', 'nfc']) AS payment_method FROM transactions
        UNION SELECT DISTINCT merchant_category, payment_method FROM transactions) g
  LEFT JOIN transactions t ON t.merchant_category IS NOT DISTINCT FROM g.merchant_category
                          AND t.payment_method IS NOT DISTINCT FROM g.payment_method
  GROUP BY 1, 2)
SELECT merchant_category, payment_method, n,
  n / sum(n) OVER (PARTITION BY merchant_category) AS share,
  row_number() OVER (PARTITION BY merchant_category ORDER BY n DESC, payment_method) = 1 AS is_top_method
FROM c""", TX)
def q_payment_preference(spark, sf):
    return R.payment_preference(transactions(spark, sf))


@query("riskiest_customer_type", """
SELECT customer_type, avg(risk_level) AS avg_risk_level FROM transactions
GROUP BY customer_type ORDER BY avg_risk_level DESC, customer_type LIMIT 1""", TX)
def q_riskiest_customer_type(spark, sf):
    return R.riskiest_customer_type(R.customer_type_summary(transactions(spark, sf)))


@query("category_rank_flags", """
WITH a AS (
  SELECT merchant_category,
    sum(commission_amount) / nullif(sum(total_amount), 0) AS commission_to_transaction_ratio,
    CAST(sum(total_amount) AS BIGINT) AS total_transaction_value,
    sum(total_amount) / nullif(sum(CASE WHEN status = 'approved' THEN 1 ELSE 0 END), 0) AS avg_transaction_value
  FROM transactions GROUP BY merchant_category),
r AS (
  SELECT *,
    CAST(row_number() OVER (ORDER BY commission_to_transaction_ratio DESC, merchant_category) AS INTEGER) AS r1,
    CAST(row_number() OVER (ORDER BY avg_transaction_value DESC, merchant_category) AS INTEGER) AS r2,
    CAST(row_number() OVER (ORDER BY total_transaction_value DESC, merchant_category) AS INTEGER) AS r3
  FROM a)
SELECT merchant_category, commission_to_transaction_ratio, total_transaction_value, avg_transaction_value,
  CASE WHEN r1 <= 2 THEN r1 END AS rank_by_ratio,
  CASE WHEN r2 <= 2 THEN r2 END AS rank_by_avg_value,
  CASE WHEN r3 <= 2 THEN r3 END AS rank_by_total_value
FROM r""", TX)
def q_category_rank_flags(spark, sf):
    return R.category_rank_flags(R.merchant_category_summary(transactions(spark, sf)))


@query("expensive_categories", """
SELECT merchant_category,
  sum(total_amount) / nullif(sum(CASE WHEN status = 'approved' THEN 1 ELSE 0 END), 0) AS avg_transaction_value
FROM transactions GROUP BY merchant_category ORDER BY avg_transaction_value DESC, merchant_category LIMIT 2""", TX)
def q_expensive_categories(spark, sf):
    return R.expensive_categories(R.merchant_category_summary(transactions(spark, sf)))


@query("most_declined", """
WITH a AS (
  SELECT customer_id, count(*) AS total_trxs,
    CAST(sum(CASE WHEN status = 'declined' THEN 1 ELSE 0 END) AS BIGINT) AS declined_trxs
  FROM transactions GROUP BY customer_id),
t AS (SELECT *, declined_trxs / nullif(total_trxs, 0) AS declined_ratio FROM a
      ORDER BY declined_ratio DESC, customer_id LIMIT 10)
SELECT *, CAST(row_number() OVER (ORDER BY declined_ratio DESC, customer_id) AS INTEGER) AS rank,
  row_number() OVER (ORDER BY declined_ratio DESC, customer_id) <= 3 AS flagged
FROM t""", TX)
def q_most_declined(spark, sf):
    return R.most_declined(R.customer_summary(transactions(spark, sf)))


_TOP_SQL = """
WITH a AS (SELECT {key}, count(*) AS total_trxs FROM transactions GROUP BY {key}),
t AS (SELECT * FROM a ORDER BY total_trxs DESC, {key} LIMIT 10)
SELECT *, CAST(row_number() OVER (ORDER BY total_trxs DESC, {key}) AS INTEGER) AS rank,
  row_number() OVER (ORDER BY total_trxs DESC, {key}) <= 3 AS flagged
FROM t"""


@query("top_merchants", _TOP_SQL.format(key="merchant_id"), TX)
def q_top_merchants(spark, sf):
    return R.top_by_count(R.merchant_summary(transactions(spark, sf)), "merchant_id")


@query("top_customers", _TOP_SQL.format(key="customer_id"), TX)
def q_top_customers(spark, sf):
    return R.top_by_count(R.customer_summary(transactions(spark, sf)), "customer_id")
