"""SQL fragments of the shared measure sets (mirror of quarry.operators.measures)."""

OK = "status = 'approved'"
NO = "status = 'declined'"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def count_if(cond: str) -> str:
    return big(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)")


def sum_if(cond: str, col: str) -> str:
    return big(f"sum(CASE WHEN {cond} THEN {col} ELSE 0 END)")


def category_measures(with_count: bool = False) -> str:
    parts = [
        f"{big('sum(commission_amount)')} AS total_commissions",
        "avg(commission_amount) AS avg_commission_per_transaction",
        "sum(commission_amount) / nullif(sum(total_amount), 0) AS commission_to_transaction_ratio",
        f"{count_if(OK)} AS total_successful_txns",
        f"{count_if(NO)} AS total_failed_txns",
        f"{big('sum(total_amount)')} AS total_transaction_value",
        f"{sum_if(OK, 'total_amount')} AS total_value_approved",
        f"{sum_if(NO, 'total_amount')} AS total_value_declined",
        f"{sum_if(OK, 'commission_amount')} AS total_commission_approved",
        f"{sum_if(NO, 'commission_amount')} AS total_commission_declined",
    ]
    if with_count:
        parts.append("count(*) AS total_count")
    parts.append("avg(risk_level) AS avg_risk_level")
    return ",\n  ".join(parts)


def daily_measures() -> str:
    return ",\n  ".join([
        "count(*) AS total_transactions",
        f"{count_if(OK)} AS approved_transactions",
        f"{count_if(NO)} AS declined_transactions",
        "avg(risk_level) AS avg_risk_level",
        f"{big('sum(total_amount)')} AS total_transaction_value",
        f"{big('sum(commission_amount)')} AS total_commissions",
    ])


def party_measures() -> str:
    return ",\n  ".join([
        "count(*) AS total_trxs",
        f"{big('sum(total_amount)')} AS total_trx_value",
        f"{big('sum(commission_amount)')} AS total_commissions",
        "avg(commission_amount) AS avg_commission",
        "avg(total_amount) AS avg_trx_value",
        f"{count_if(OK)} AS approved_trxs",
        f"{count_if(NO)} AS declined_trxs",
    ])


def volume_measures() -> str:
    return f"count(transaction_id) AS num_transactions, {big('sum(total_amount)')} AS total_transaction_amount"


def hour(col: str = "event_time") -> str:
    return f"CAST(hour({col}) AS INTEGER)"
