"""The SQL each registered query is checked against, for DuckDB over the same Parquet files."""

from __future__ import annotations

from cohortlift.schema import TABLES
from verification import contract
from verification.star_sql import CATS, CHANS, CTES, slot, with_star

SQL: dict[str, str] = {}
AS_OF = "DATE '2001-01-01'"
RESTATED = "DATE '1995-07-01'"
BUYS = f"txn_type = 'purchase' AND txn_date < {AS_OF}"
CENTS = "CAST(amount_gel * 100 AS BIGINT)"


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def _mean(expr: str, where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return f"({_d(f'sum({expr}){f}')} / NULLIF(count({expr}){f}, 0))"


STAR = {"fact_transaction": "txn", "fact_account_monthly": "snap", "fact_campaign_response": "resp", "dim_customer": "dimc",
        "dim_merchant": "dimm", "dim_date": "dimd", "dim_product": "dimp", "dim_campaign": "dimk"}
CTES["dimp"] = (("prod",), "SELECT product_sk, product_name, product_group, CAST(product_sk = 3 AS INTEGER) AS is_campaign_target FROM prod")
CTES["dimk"] = ((), """
    SELECT CAST(1 AS BIGINT) AS campaign_sk, 'Credit Card Cross-Sell' AS campaign_name, CAST(3 AS BIGINT) AS target_product_sk, DATE '2001-01-01' AS start_date,
           DATE '2001-01-11' AS end_date, DATE '2001-03-12' AS measurement_end_date, 'mobile_app' AS contact_channel,
           CAST(2.5 AS DECIMAL(8,2)) AS cost_per_contact_gel, CAST(0.7 AS DECIMAL(4,3)) AS treatment_share""")

SQL["dim_date"] = with_star("SELECT * FROM dimd", "dimd")
SQL["dim_customer"] = with_star("SELECT * FROM dimc", "dimc")
SQL["dim_merchant"] = with_star("SELECT * FROM dimm", "dimm")
SQL["table_counts"] = with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {c}" for t, c in STAR.items()), *STAR.values())



def _prints(table: str, source: str, part: str) -> str:
    """Rows and content of a table, summed from the MD5 of its rows in two parts of 32 bits."""
    row = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in TABLES[table].names)
    half = lambda at: f"coalesce(sum(('0x' || substr(d, {at}, 8))::BIGINT), 0)::VARCHAR"
    return (f"SELECT '{table}' AS table_name, part, count(*) AS rows, {half(1)} || '-' || {half(9)} AS fingerprint "
            f"FROM (SELECT {part} AS part, md5({row}) AS d FROM {source}) GROUP BY part")


_month = "CAST(date_trunc('month', txn_date) AS DATE)"
SQL["manifest"] = with_star(" UNION ALL ".join(
    _prints(t, c, _month if t == "fact_transaction" else "CAST(NULL AS DATE)") for t, c in STAR.items()), *STAR.values())
_members = {"dim_date": "(SELECT count(*) FROM dimd WHERE date_sk = 0)", "dim_merchant": "(SELECT count(*) FROM dimm WHERE merchant_sk = 0)"}
SQL["staged_load"] = with_star(" UNION ALL ".join(
    f"SELECT table_name, rows, fingerprint, {f'(SELECT count(DISTINCT {_month}) FROM txn)' if t == 'fact_transaction' else 0} AS months, "
    f"{_members.get(t, 0)} AS unknown_members FROM ({_prints(t, c, '1')})" for t, c in STAR.items()), *STAR.values())


def _extremes(table: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{f.name}' AS column_name, count(*) AS rows, count(*) - count({f.name}) AS nulls, "
        + ("NULL AS low, NULL AS high" if f.dataType.simpleString() == "string" else f"min({f.name})::VARCHAR AS low, max({f.name})::VARCHAR AS high")
        + f" FROM {source}" for f in TABLES[table])


SQL["catalog_statistics"] = with_star(" UNION ALL ".join(_extremes(t, STAR[t]) for t in (
    "dim_customer", "dim_merchant", "fact_account_monthly", "fact_campaign_response", "fact_transaction")), *STAR.values())

# ---- recency, frequency, monetary -------------------------------------------------------------


def _rfm(as_of: str) -> dict[str, str]:
    return {
        "base": f"""
            SELECT customer_sk, {as_of} - max(txn_date) AS recency_days, count(*) AS frequency, sum(amount_gel) AS monetary_gel,
                   {_mean('amount_gel')} AS avg_ticket_gel
            FROM txn WHERE txn_type = 'purchase' AND txn_date < {as_of} GROUP BY customer_sk""",
        "scored": """
            SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_sk) AS r_score,
                   ntile(5) OVER (ORDER BY frequency, customer_sk) AS f_score,
                   ntile(5) OVER (ORDER BY monetary_gel, customer_sk) AS m_score FROM base""",
        "rfm": """
            SELECT customer_sk, recency_days, frequency, CAST(monetary_gel AS DOUBLE) AS monetary_gel, avg_ticket_gel,
                   r_score, f_score, m_score, 100 * r_score + 10 * f_score + m_score AS rfm_cell,
                   CASE WHEN least(r_score, f_score, m_score) > 3 THEN 'Champions'
                        WHEN least(r_score, f_score) > 2 THEN 'Loyal'
                        WHEN r_score > 3 AND f_score < 3 THEN 'New / Promising'
                        WHEN r_score < 3 THEN CASE WHEN f_score > 2 THEN 'At Risk' ELSE 'Hibernating' END
                        ELSE 'Needs Attention' END AS rfm_segment FROM scored""",
    }


RFM = _rfm(AS_OF)
SQL["rfm_base"] = with_star(
    "SELECT customer_sk, recency_days, frequency, CAST(monetary_gel AS DOUBLE) AS monetary_gel, avg_ticket_gel FROM base",
    "txn", base=RFM["base"])
SQL["ntile_global"] = with_star("""
    SELECT customer_sk, ntile(5) OVER (ORDER BY monetary_gel, customer_sk) AS spend_tile,
           ntile(7) OVER (ORDER BY frequency DESC, customer_sk) AS frequency_tile FROM base""", "txn", base=RFM["base"])
SQL["rfm_score"] = with_star("SELECT customer_sk, r_score, f_score, m_score, rfm_cell FROM rfm", "txn", **RFM)
SQL["rfm_segment"] = with_star("SELECT * FROM rfm", "txn", **RFM)
_early = {f"early_{k}": v.replace("FROM base", "FROM early_base").replace("FROM scored", "FROM early_scored")
          for k, v in _rfm(RESTATED).items()}
_columns = "customer_sk, recency_days, frequency, monetary_gel, avg_ticket_gel, r_score, f_score, m_score, rfm_cell, rfm_segment"
SQL["rfm_snapshot_refresh"] = with_star(f"""
    SELECT {_columns}, {RESTATED} AS snapshot_date FROM early_rfm
    UNION ALL SELECT {_columns}, {AS_OF} FROM rfm WHERE customer_sk NOT IN (SELECT customer_sk FROM early_rfm)""",
    "txn", **RFM, **_early)
_bucket = slot("CAST(customer_sk AS VARCHAR)", slots=64)
SQL["rfm_bucketed_refresh"] = with_star(f"""
    SELECT *, CAST({_bucket} AS INTEGER) AS bucket, CASE WHEN {_bucket} IN (SELECT {_bucket} FROM restated) THEN 2 ELSE 1 END AS written FROM (
      SELECT {_columns}, {RESTATED} AS snapshot_date FROM restated
      UNION ALL SELECT {_columns}, {AS_OF} FROM rfm WHERE customer_sk NOT IN (SELECT customer_sk FROM restated))""",
    "txn", "dimc", **RFM, **_early, restated="SELECT * FROM early_rfm WHERE customer_sk IN (SELECT customer_sk FROM dimc WHERE income_band = 'low')")
SQL["rfm_segment_report"] = with_star(f"""
    SELECT rfm_segment, count(*) AS customers, {_d('count(*)')} / sum(count(*)) OVER () AS pct_of_base,
           {_mean('recency_days')} AS avg_recency_days, {_mean('frequency')} AS avg_purchases,
           {_d('sum(CAST(monetary_gel AS DECIMAL(24,2)))')} / count(*) AS avg_spend_gel,
           {_d('sum(CAST(monetary_gel AS DECIMAL(24,2)))')} AS total_spend_gel,
           {_d('sum(CAST(monetary_gel AS DECIMAL(24,2)))')} / {_d('sum(sum(CAST(monetary_gel AS DECIMAL(24,2)))) OVER ()')} AS pct_of_spend
    FROM rfm GROUP BY rfm_segment""", "txn", **RFM)

# ---- features ---------------------------------------------------------------------------------
_cents_of = lambda cond: f"COALESCE(sum({CENTS}) FILTER (WHERE {cond}), 0)"
_recent, _prior = "DATE '2000-10-01'", "DATE '2000-07-01'"
F_TXN = f"""
    SELECT customer_sk, {AS_OF} - max(txn_date) AS recency_days, count(*) AS purchase_count,
           {_d(f'sum({CENTS})')} / 100 AS total_spend_gel, {_d(f'sum({CENTS})')} / 100 / count(*) AS avg_ticket_gel,
           round(stddev_samp({_d('amount_gel')}), 4) AS ticket_volatility_gel,
           {_d('quantile_disc(amount_gel, 0.5)')} AS median_ticket_gel, {_d('max(amount_gel)')} AS max_ticket_gel,
           count(DISTINCT merchant_sk) AS distinct_merchants, count(DISTINCT date_trunc('month', txn_date)) AS active_months,
           {_d('count(*) FILTER (WHERE isodow(txn_date) > 5)')} / count(*) AS weekend_txn_share,
           {_d('count(*)')} / count(DISTINCT date_trunc('month', txn_date)) AS purchases_per_active_month
    FROM txn WHERE {BUYS} GROUP BY customer_sk"""
_cat_total = _cents_of("mcc_category IN (" + ", ".join(f"'{c}'" for c in CATS) + ")")
_category_in = "mcc_category = '{}'"
_channel_in = "channel = '{}'"
F_CAT = "SELECT customer_sk, " + ", ".join(
    f"CASE WHEN {_cat_total} > 0 THEN {_d(_cents_of(_category_in.format(c)))} / {_d(_cat_total)} ELSE 0 END AS sh_{c}" for c in CATS
) + f" FROM txn WHERE {BUYS} GROUP BY customer_sk"
_chan_total = _cents_of("channel IN (" + ", ".join(f"'{c}'" for c in CHANS) + ")")
_digital = _cents_of("channel IN ('mobile_app', 'internet_bank', 'ecommerce')")
_cash = "txn_type = 'cash_withdrawal'"


def _of_channels(amount: str) -> str:
    return f"CASE WHEN {_chan_total} > 0 THEN {_d(amount)} / {_d(_chan_total)} ELSE 0 END"


F_CHAN = "SELECT customer_sk, " + ", ".join(
    f"{_of_channels(_cents_of(_channel_in.format(c)))} AS ch_{c}" for c in CHANS
) + f""", {_of_channels(_digital)} AS digital_value_share, {_of_channels(_cents_of(_channel_in.format('atm')))} AS cash_value_share,
    count(*) FILTER (WHERE {_cash}) AS withdrawal_count,
    COALESCE({_d(f'sum({CENTS}) FILTER (WHERE {_cash})')} / 100 / NULLIF(count(*) FILTER (WHERE {_cash}), 0), 0) AS avg_withdrawal_gel
    FROM txn WHERE direction = 'debit' AND txn_date < {AS_OF} GROUP BY customer_sk"""
F_INC = f"""
    SELECT customer_sk, {_d('sum(m)')} / 100 / count(*) AS avg_monthly_inflow_gel,
           round(stddev_samp({_d('m')} / 100), 4) AS inflow_volatility_gel, count(*) AS months_with_inflow,
           {_d('min(m)')} / 100 AS min_monthly_inflow_gel,
           round(COALESCE(stddev_samp({_d('m')} / 100), 0) / greatest({_d('sum(m)')} / 100 / count(*), 1), 8) AS inflow_cv
    FROM (SELECT customer_sk, date_trunc('month', txn_date) AS mm, sum({CENTS}) AS m FROM txn
          WHERE txn_type = 'inflow' AND txn_date < {AS_OF} GROUP BY 1, 2) GROUP BY customer_sk"""
F_MOM = f"""
    SELECT customer_sk, {_d('l')} / 100 AS spend_last_3m, {_d('p')} / 100 AS spend_prior_3m, n AS txns_last_3m,
           {_d('l - p')} / 100 / greatest({_d('p')} / 100, 1) AS spend_momentum
    FROM (SELECT customer_sk, {_cents_of(f'txn_date >= {_recent}')} AS l,
                 {_cents_of(f'txn_date >= {_prior} AND txn_date < {_recent}')} AS p,
                 count(*) FILTER (WHERE txn_date >= {_recent}) AS n
          FROM txn WHERE {BUYS} GROUP BY customer_sk)"""


def _balance(cv: str) -> str:
    return f"""
    SELECT customer_sk, avg_balance_gel, round(sd, 4) AS balance_volatility_gel, min_balance_gel, max_balance_gel, months_negative,
           balance_trend_gel, round({cv}, 8) AS balance_cv
    FROM (SELECT customer_sk, {_mean('balance_gel')} AS avg_balance_gel, stddev_samp({_d('balance_gel')}) AS sd,
                 {_d('min(balance_gel)')} AS min_balance_gel, {_d('max(balance_gel)')} AS max_balance_gel,
                 count(*) FILTER (WHERE balance_gel < 0) AS months_negative,
                 {_d('arg_max(balance_gel, month_end_date) - arg_min(balance_gel, month_end_date)')} AS balance_trend_gel
          FROM snap JOIN prod USING (product_sk) WHERE product_name = 'Current Account' AND month_end_date < {AS_OF}
          GROUP BY customer_sk)"""


F_BAL = _balance("COALESCE(sd, 0) / greatest(abs(avg_balance_gel), 1)")
F_HOLD = f"""
    SELECT customer_sk, CAST(bool_or(product_name = 'Savings Account') AS INTEGER) AS has_savings,
           CAST(bool_or(product_name = 'Term Deposit') AS INTEGER) AS has_term_deposit,
           CAST(bool_or(product_name = 'Consumer Loan') AS INTEGER) AS has_loan,
           CAST(bool_or(product_name = 'Credit Card') AS INTEGER) AS has_credit_card, count(*) AS products_held,
           COALESCE({_d('sum(balance_gel) FILTER (WHERE balance_gel > 0)')}, 0) AS total_assets_gel,
           abs(COALESCE({_d('sum(balance_gel) FILTER (WHERE balance_gel < 0)')}, 0)) AS total_liabilities_gel
    FROM snap JOIN prod USING (product_sk)
    WHERE month_end_date = (SELECT max(month_end_date) FROM snap WHERE month_end_date < {AS_OF}) GROUP BY customer_sk"""


def _unrounded(sql: str) -> str:
    """The same feature SQL with its deviations as they are: the outer round(x, n) taken off."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, i, comma = 0, start + 5, -1
        while True:
            depth += (sql[i] == "(") - (sql[i] == ")")
            comma = i if sql[i] == "," and depth == 1 else comma
            if depth == 0:
                break
            i += 1
        out, at = out + sql[at:start] + "(" + sql[start + 6:comma] + ")", i + 1
    return out + sql[at:]


SQL["transaction_features"] = with_star(F_TXN, "txn")
SQL["category_shares"] = with_star(F_CAT, "txn")
SQL["channel_features"] = with_star(F_CHAN, "txn")
SQL["income_features"] = with_star(F_INC, "txn")
SQL["momentum_features"] = with_star(F_MOM, "txn")
SQL["balance_features"] = with_star(F_BAL, "snap", "prod")
SQL["holding_features"] = with_star(F_HOLD, "snap", "prod")
_matrix_columns = (
    ["recency_days", "purchase_count", "total_spend_gel", "avg_ticket_gel", "ticket_volatility_gel", "median_ticket_gel",
     "max_ticket_gel", "distinct_merchants", "active_months", "weekend_txn_share", "purchases_per_active_month"]
    + [f"sh_{c}" for c in CATS] + [f"ch_{c}" for c in CHANS]
    + ["digital_value_share", "cash_value_share", "withdrawal_count", "avg_withdrawal_gel", "avg_monthly_inflow_gel",
       "inflow_volatility_gel", "months_with_inflow", "min_monthly_inflow_gel", "inflow_cv", "spend_last_3m",
       "spend_prior_3m", "txns_last_3m", "spend_momentum", "avg_balance_gel", "balance_volatility_gel", "min_balance_gel",
       "max_balance_gel", "months_negative", "balance_trend_gel", "balance_cv", "has_savings", "has_term_deposit",
       "has_loan", "has_credit_card", "products_held", "total_assets_gel", "total_liabilities_gel"])
_matrix_sql = (
    "SELECT customer_sk, age, tenure_years, existing_product_count, income_band, employment, city, "
    + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _matrix_columns)
    + " FROM dimc " + " ".join(f"LEFT JOIN f{i} USING (customer_sk)" for i in range(7)))
_parts = (F_TXN, F_CAT, F_CHAN, F_INC, F_MOM, F_BAL, F_HOLD)
SQL["feature_matrix"] = with_star(_matrix_sql, "txn", "snap", "prod", "dimc", **{f"f{i}": q for i, q in enumerate(_parts)})
_dated = {"DATE '1998-03-20'": ("DATE '1997-12-20'", "DATE '1997-09-20'"), "DATE '1999-07-01'": ("DATE '1999-04-01'", "DATE '1999-01-01'"),
          AS_OF: (_recent, _prior)}


def _snapshots(dated: dict[str, tuple[str, str]]) -> tuple[str, dict[str, str]]:
    """The matrix at several dates, each with the starts of its last and its prior three months: the query and its parts."""
    whole = " UNION ALL ".join(
        f"SELECT {d} AS as_of, customer_sk, age, tenure_years, existing_product_count, income_band, employment, city, "
        + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _matrix_columns)
        + " FROM dimc " + " ".join(f"LEFT JOIN f{i}_{k} USING (customer_sk)" for i in range(len(_parts))) for k, d in enumerate(dated))
    return whole, {f"f{i}_{k}": q.replace(AS_OF, d).replace(_recent, r).replace(_prior, p)
                   for k, (d, (r, p)) in enumerate(dated.items()) for i, q in enumerate(_parts)}


_whole, _dated_parts = _snapshots(_dated)
SQL["monthly_feature_snapshots"] = with_star(_whole, "txn", "snap", "prod", "dimc", **_dated_parts)
_whole, _dated_parts = _snapshots({"DATE '1998-03-20'": ("DATE '1997-12-20'", "DATE '1997-09-20'"),
                                   "DATE '1996-11-01'": ("DATE '1996-08-01'", "DATE '1996-05-01'"), AS_OF: (_recent, _prior)})
SQL["features_by_campaign"] = with_star(
    f"SELECT * FROM ({_whole}) JOIN (SELECT campaign_sk, start_date AS as_of FROM camps) USING (as_of)", "txn", "snap", "prod", "dimc", "camps", **_dated_parts)

# ---- profiles ---------------------------------------------------------------------------------
P_SPEND = "SELECT customer_sk, " + ", ".join(
    f"{_d(f'''sum(amount_gel) FILTER (WHERE mcc_category = '{c}')''')} / {_d('sum(amount_gel)')} AS sh_{c}" for c in CATS
) + f" FROM txn WHERE {BUYS} GROUP BY customer_sk"
_digital_sum = "COALESCE(sum(amount_gel) FILTER (WHERE channel IN ('mobile_app', 'internet_bank', 'ecommerce')), 0)"
P_CHAN = f"""
    SELECT customer_sk, count(*) AS debit_txn_count, {_d('sum(amount_gel)')} AS total_outflow_gel,
           {_d(_digital_sum)} / {_d('sum(amount_gel)')} AS digital_value_share,
           {_d(f'COALESCE(sum(amount_gel) FILTER (WHERE {_cash}), 0)')} / {_d('sum(amount_gel)')} AS cash_value_share,
           {_d("count(*) FILTER (WHERE channel = 'branch')")} / count(*) AS branch_txn_share,
           count(DISTINCT channel) AS channels_used, {_mean('amount_gel', _cash)} AS avg_withdrawal_gel
    FROM txn WHERE direction = 'debit' AND txn_date < {AS_OF} GROUP BY customer_sk"""
P_BAL = _balance("sd / NULLIF(abs(avg_balance_gel), 0)")
SQL["spend_profile"] = with_star(P_SPEND, "txn")
SQL["channel_profile"] = with_star(P_CHAN, "txn")
SQL["balance_profile"] = with_star(P_BAL, "snap", "prod")
_separation = {"groceries": "sh_groceries", "dining": "sh_dining", "travel": "sh_travel", "healthcare": "sh_healthcare",
               "digital": "digital_value_share", "cash": "cash_value_share", "avg_balance": "avg_balance_gel"}
SQL["profile_separation_report"] = with_star(
    "SELECT income_band, count(*) AS customers, " + ", ".join(f"round(avg({c}), 6) AS {n}" for n, c in _separation.items())
    + " FROM dimc JOIN a USING (customer_sk) JOIN b USING (customer_sk) JOIN d USING (customer_sk) GROUP BY income_band",
    "dimc", "txn", "snap", "prod", a=P_SPEND, b=P_CHAN, d=P_BAL)
SQL["product_penetration"] = with_star(f"""
    SELECT month_end_date, product_name, product_group, count(*) AS holders,
           {_d('count(*)')} / (SELECT count(*) FROM dimc) AS penetration
    FROM snap JOIN prod USING (product_sk) GROUP BY 1, 2, 3""", "snap", "prod", "dimc")
SQL["penetration_by_persona"] = with_star(f"""
    SELECT persona, product_name, count(DISTINCT customer_sk) AS holders, {_d('count(DISTINCT customer_sk)')} / any_value(customers) AS penetration
    FROM snap JOIN prod USING (product_sk) JOIN persona USING (customer_sk)
    JOIN (SELECT persona, count(*) AS customers FROM persona GROUP BY 1) USING (persona) GROUP BY 1, 2""", "snap", "prod", "persona")

# ---- quality ----------------------------------------------------------------------------------
_line = "SELECT '{t}' AS table_name, '{k}' AS kind, '{r}' AS rule, count(*) AS violations FROM {q}"


def _null_checks(star: dict[str, str]) -> str:
    return " UNION ALL ".join(_line.format(t=t, k="not_null", r=f.name, q=f"{c} WHERE {f.name} IS NULL")
                              for t, c in star.items() for f in TABLES[t] if not f.nullable)


def _key_checks(star: dict[str, str]) -> str:
    return " UNION ALL ".join(_line.format(
        t=table, k=kind, r=columns,
        q=f"(SELECT 1 FROM {star[table]} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns.split(', '))} GROUP BY {columns} HAVING count(*) > 1)")
        for table, kind, columns in contract.keys() if table in star)


def _fk_checks(star: dict[str, str]) -> str:
    return " UNION ALL ".join(_line.format(
        t=table, k="foreign", r=f"{column} -> {parent}",
        q=f"{star[table]} x WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {star[parent]} p WHERE p.{parent_column} = x.{column})")
        for table, column, parent, parent_column in contract.references() if table in star)


def _rule_checks(star: dict[str, str]) -> str:
    return " UNION ALL ".join(_line.format(t=table, k="check", r=name, q=f"{star[table]} WHERE {condition}")
                              for table, name, condition in contract.violations() if table in star)


def _nulls_sql(table: str, source: str) -> str:
    names = TABLES[table].names
    lost = ", ".join(f"CASE WHEN k > {i} THEN {c} END AS {c}" for i, c in enumerate(names))
    return f"SELECT {lost} FROM {source} CROSS JOIN range(0, {len(names)}) r(k)"


def _bad_sql(table: str, source: str) -> str:
    value = {"string": "'bad'", "date": "DATE '1900-01-01'"}
    bad = ", ".join(f"CASE WHEN k = {i} THEN {value.get(f.dataType.simpleString(), '-1')} ELSE {f.name} END AS {f.name}"
                    for i, f in enumerate(TABLES[table]))
    return f"SELECT {bad} FROM {source} CROSS JOIN range(0, {len(TABLES[table])}) r(k)"


def _doubled_sql(table: str, source: str) -> str:
    key = TABLES[table].names[0]
    return f"SELECT * REPLACE ({key} * 2 AS {key}) FROM {source}" if table.startswith("dim_") else f"SELECT * FROM {source}"


def _repeated_sql(table: str, source: str) -> str:
    return f"SELECT * FROM {source} UNION ALL SELECT * FROM {source} WHERE {TABLES[table].names[0]} % 2 = 1"


for _name, _checks in (("not_null_report", _null_checks), ("unique_report", _key_checks), ("fk_report", _fk_checks), ("rule_report", _rule_checks)):
    SQL[_name] = with_star(_checks(STAR), *STAR.values())
_contract = {**STAR, "customer_rfm_snapshot": "segments"}
for _name, _checks, _damage, _tables in (
        ("not_null_report_damaged", _null_checks, _nulls_sql, _contract), ("unique_report_damaged", _key_checks, _repeated_sql, _contract),
        ("fk_report_damaged", _fk_checks, _doubled_sql, _contract), ("rule_report_damaged", _rule_checks, _bad_sql, STAR)):
    SQL[_name] = with_star(
        _checks({t: f"bad_{c}" for t, c in _tables.items()}), *STAR.values(), **RFM,
        segments=f"SELECT *, {AS_OF} AS snapshot_date FROM rfm", **{f"bad_{c}": _damage(t, c) for t, c in _tables.items()})
# the limits once more, apart from those of the engine
_limits = """dim_date month_name 12, dim_date day_name 12, dim_date year_month 7, dim_customer gender 1, dim_customer city 50,
    dim_customer income_band 10, dim_customer employment 20, dim_product product_name 50, dim_product product_group 30,
    dim_merchant merchant_name 60, dim_merchant mcc_category 20, dim_campaign campaign_name 100, dim_campaign contact_channel 20,
    fact_transaction txn_type 20, fact_transaction direction 6, fact_transaction channel 20, fact_transaction mcc_category 20,
    fact_campaign_response assignment 10, customer_rfm_snapshot rfm_segment 20"""


def _long_sql(table: str, source: str) -> str:
    texts = ", ".join(f"CASE WHEN k >= {i} THEN {f.name} || repeat('é', 100) ELSE {f.name} END AS {f.name}"
                      for i, f in enumerate(TABLES[table]) if f.dataType.simpleString() == "string")
    return f"SELECT {texts or '1 AS none'} FROM {source} CROSS JOIN range(0, {len(TABLES[table])}) r(k)"


for _name, _prefix in (("length_report", ""), ("length_report_damaged", "long_")):
    SQL[_name] = with_star(
        " UNION ALL ".join(_line.format(t=t, k="length", r=c, q=f"{_prefix}{_contract[t]} WHERE length({c}) > {n}")
                           for t, c, n in (x.split() for x in _limits.split(","))),
        *STAR.values(), **RFM, segments=f"SELECT *, {AS_OF} AS snapshot_date FROM rfm",
        **{f"long_{c}": _long_sql(t, c) for t, c in _contract.items()})
_dq = {
    ("customers_without_transactions", "ERROR"): "FROM dimc WHERE customer_sk NOT IN (SELECT customer_sk FROM txn)",
    ("negative_transaction_amounts", "ERROR"): "FROM txn WHERE amount_gel < 0",
    ("non_purchase_with_merchant", "ERROR"): "FROM txn WHERE NOT (txn_type = 'purchase' OR merchant_sk = 0)",
    ("category_disagrees_with_merchant", "ERROR"): "FROM txn t JOIN dimm m USING (merchant_sk) WHERE t.mcc_category <> m.mcc_category",
    ("control_customers_contacted", "ERROR"): "FROM resp WHERE assignment = 'control' AND (contacted = 1 OR contact_date IS NOT NULL)",
    ("campaign_targeted_existing_cardholders", "ERROR"): f"""FROM resp WHERE responded = 0 AND customer_sk IN (
        SELECT customer_sk FROM snap JOIN prod USING (product_sk) WHERE product_name = 'Credit Card' AND month_end_date < {AS_OF})""",
    ("revenue_without_response", "ERROR"): "FROM resp WHERE responded = 0 AND annual_value_gel <> 0",
    ("transactions_outside_window", "ERROR"): "FROM txn WHERE date_sk NOT IN (SELECT date_sk FROM dimd)",
    ("current_accounts_below_floor", "WARNING"): "FROM snap JOIN prod USING (product_sk) WHERE product_name = 'Current Account' AND balance_gel < -500",
    ("treatment_share_off_target", "WARNING"): "FROM (SELECT avg(contacted) AS p FROM resp) WHERE abs(p - 0.7) > 0.02",
}
SQL["dq_suite"] = with_star("SELECT *, CASE violations WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, '{sev}' AS severity, count(*) AS violations {q}" for (n, sev), q in _dq.items()) + ")", *STAR.values())
SQL["reconcile_counts"] = with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {want} AS expected_rows, {got} AS loaded_rows, CASE WHEN {want} = {got} THEN 'ok' ELSE 'MISMATCH' END AS status"
    for t, want, got in (
        ("fact_transaction", "(SELECT count(*) FROM lineitem)", "(SELECT count(*) FROM txn)"),
        ("dim_customer", "(SELECT count(*) FROM customer)", "(SELECT count(*) FROM dimc)"),
        ("dim_merchant", "(SELECT count(*) + 1 FROM supplier)", "(SELECT count(*) FROM dimm)"))), "txn", "dimc", "dimm")
SQL["load_counts"] = with_star(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS expected_rows, count(*) AS loaded_rows, 'ok' AS status FROM {c}" for t, c in STAR.items()), *STAR.values())
SQL["randomisation_check"] = with_star(f"""
    SELECT campaign_sk, {_d('sum(contacted)')} / count(*) AS treated_share, {_d('0.7')} AS target_share,
           CAST(abs({_d('sum(contacted)')} / count(*) - 0.7) > 0.02 AS INTEGER) AS off_target FROM resp GROUP BY campaign_sk""", "resp")
SQL["eligibility_check"] = with_star(f"""
    SELECT count(DISTINCT customer_sk) FILTER (WHERE month_end_date < {AS_OF}) AS held_before_start, count(DISTINCT customer_sk) AS held_at_any_time
    FROM resp JOIN snap USING (customer_sk) WHERE product_sk = 3 AND responded = 0""", "resp", "snap")
SQL["shares_check"] = with_star("""
    SELECT customer_sk, round(sum(share), 9) AS share_sum, CAST(0 AS BIGINT) AS unknown_members,
           CASE WHEN abs(sum(share) - 1) <= 1e-6 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (UNPIVOT p ON COLUMNS(* EXCLUDE customer_sk) INTO NAME n VALUE share) GROUP BY customer_sk""", "txn", p=P_SPEND)
SQL["truth_coverage"] = with_star("""
    SELECT (SELECT count(*) FROM dimc WHERE customer_sk NOT IN (SELECT customer_sk FROM persona)) AS without_label,
           (SELECT count(*) FROM (SELECT 1 FROM persona GROUP BY customer_sk HAVING count(*) > 1)) AS repeated_label,
           (SELECT count(*) FROM persona WHERE customer_sk NOT IN (SELECT customer_sk FROM dimc)) AS unknown_customer""", "dimc", "persona")

# ---- ledger -----------------------------------------------------------------------------------
L_FLOWS = """
    SELECT customer_sk, CAST(date_trunc('month', txn_date) AS DATE) AS month,
           CAST(COALESCE(sum(amount_gel) FILTER (WHERE direction = 'credit'), 0) AS DOUBLE) AS inflow,
           CAST(COALESCE(sum(amount_gel) FILTER (WHERE direction = 'debit'), 0) AS DOUBLE) AS outflow
    FROM txn GROUP BY 1, 2"""
L_DENSE = """
    SELECT customer_sk, CAST(i AS INTEGER) AS month_idx, month, COALESCE(inflow, 0) AS inflow, COALESCE(outflow, 0) AS outflow
    FROM (SELECT customer_sk, i, CAST(DATE '2000-02-01' + to_months(CAST(i AS INTEGER)) AS DATE) AS month FROM cust CROSS JOIN range(0, 12) r(i))
    LEFT JOIN flows USING (customer_sk, month)"""
L_LEDGER = """
    SELECT customer_sk, -1 AS month_idx, CAST(NULL AS DATE) AS month, CAST(abs(acctbal) AS DOUBLE) AS ca, CAST(abs(acctbal) AS DOUBLE) AS buffer,
           saver, CASE WHEN saver THEN CAST(abs(acctbal) AS DOUBLE) * CAST(0.8 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS sav
    FROM (SELECT *, customer_sk IN (SELECT customer_sk FROM hold WHERE product_sk = 4) AS saver FROM cust)
    UNION ALL
    SELECT customer_sk, month_idx, month, greatest(gross - sweep, CAST(-500 AS DOUBLE)), buffer, saver, sav * CAST(1.004 AS DOUBLE) + sweep
    FROM (SELECT *, CASE WHEN saver THEN greatest(gross - buffer, 0) * CAST(0.4 AS DOUBLE) ELSE 0 END AS sweep
          FROM (SELECT d.customer_sk, d.month_idx, d.month, l.ca + d.inflow - d.outflow AS gross, l.buffer, l.saver, l.sav
                FROM ledger l JOIN dense d ON d.customer_sk = l.customer_sk AND d.month_idx = l.month_idx + 1))"""
SQL["monthly_flows"] = with_star("SELECT * FROM flows", "txn", flows=L_FLOWS)
SQL["densify_months"] = with_star("SELECT * FROM dense", "txn", "cust", flows=L_FLOWS, dense=L_DENSE)
SQL["ledger_rollforward"] = with_star("""
    SELECT customer_sk, month, round(ca, 6) AS current_account_gel, round(sav, 6) AS savings_gel FROM ledger WHERE month_idx >= 0""",
    "txn", "cust", "hold", recursive=True, flows=L_FLOWS, dense=L_DENSE, ledger=L_LEDGER)
SQL["account_snapshot"] = with_star("""
    SELECT live.customer_sk, product_sk, year(month_end_date) * 10000 + month(month_end_date) * 100 + day(month_end_date) AS date_sk,
           month_end_date, round(CASE product_sk WHEN 1 THEN ca WHEN 4 THEN sav WHEN 5 THEN CAST(abs(acctbal) AS DOUBLE) * 3
             WHEN 6 THEN -CAST(abs(acctbal) AS DOUBLE) * 36 * greatest(1 - CAST(balance_slot % 36 + live.month_idx AS DOUBLE) / 36, 0)
             WHEN 3 THEN CAST(-15 * balance_slot AS DOUBLE) ELSE 0 END, 2) AS balance_gel,
           CAST(open_month_idx = live.month_idx AS INTEGER) AS opened_this_month, 1 AS is_held
    FROM live JOIN ledger ON ledger.customer_sk = live.customer_sk AND ledger.month_idx = live.month_idx""",
    "txn", "cust", "live", recursive=True, flows=L_FLOWS, dense=L_DENSE, ledger=L_LEDGER)
SQL["loan_remaining"] = with_star("""
    SELECT customer_sk, month_end_date, round(-CAST(abs(acctbal) AS DOUBLE) * 3 *
           greatest(least(1 - CAST(balance_slot % 36 + month_idx AS DOUBLE) / 36, 1), 0), 6) AS balance_gel
    FROM live WHERE product_sk = 6""", "live")
_z = lambda c: f"round((CAST({c} AS DOUBLE) - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0), 7) AS {c}_z"
SQL["standardize"] = with_star(
    "SELECT customer_sk, " + ", ".join(_z(c) for c in ("age", "tenure_years", "existing_product_count")) + " FROM dimc", "dimc")

# ---- campaign ---------------------------------------------------------------------------------
SQL["campaign_eligible"] = with_star(
    "SELECT customer_sk FROM cust WHERE customer_sk NOT IN (SELECT customer_sk FROM hold WHERE product_sk = 3)", "cust", "hold")
_drawn = slot("'campaign-1|' || c", slots=10000)
SQL["assign_holdout"] = with_star(f"""
    SELECT customer_sk, CASE WHEN {_drawn} < 7000 THEN 'treatment' ELSE 'control' END AS assignment,
           CAST({_drawn} < 7000 AS INTEGER) AS contacted FROM cust""", "cust")
SQL["campaign_arms"] = with_star(f"""
    SELECT campaign_sk, assignment, count(*) AS customers, sum(responded) AS responders, {_mean('responded')} AS response_rate,
           sum(card_opened) AS cards_opened, {_d('sum(annual_value_gel)')} AS revenue_gel, {_d('sum(contact_cost_gel)')} AS cost_gel
    FROM resp GROUP BY campaign_sk, assignment""", "resp")
C_LIFT = f"""
    SELECT *, lift - CAST(1.96 AS DOUBLE) * se AS low, lift + CAST(1.96 AS DOUBLE) * se AS high, lift * n_t AS extra,
           lift * n_t * (revenue / NULLIF(y_t, 0)) AS gained
    FROM (SELECT *, p_t - p_c AS lift, sqrt(p_t * (1 - p_t) / n_t + p_c * (1 - p_c) / n_c) AS se
          FROM (SELECT campaign_sk, count(*) FILTER (WHERE contacted = 1) AS n_t, count(*) FILTER (WHERE contacted = 0) AS n_c,
                       sum(responded) FILTER (WHERE contacted = 1) AS y_t, {_mean('responded', 'contacted = 1')} AS p_t,
                       {_mean('responded', 'contacted = 0')} AS p_c,
                       {_d('sum(contact_cost_gel) FILTER (WHERE contacted = 1)')} AS cost,
                       {_d('sum(annual_value_gel) FILTER (WHERE contacted = 1)')} AS revenue
                FROM resp GROUP BY campaign_sk))"""


def _lift_sql(r: bool) -> str:
    def at(expr: str, digits: int) -> str:
        return f"round({expr}, {digits})" if r else expr
    return f"""
    SELECT campaign_sk, n_t AS treated, n_c AS control, {at('p_t', 4)} AS treatment_rate, {at('p_c', 4)} AS control_rate,
           {at('lift', 4)} AS incremental_rate, {at('se', 4)} AS std_error, {at('low', 4)} AS ci_low, {at('high', 4)} AS ci_high,
           CASE WHEN low > 0 THEN 'YES' ELSE 'NO' END AS significant, y_t AS naive_conversions, {at('extra', 0)} AS incremental_conversions,
           {at('y_t / NULLIF(extra, 0)', 1)} AS naive_overstatement_x, {at('cost', 0)} AS campaign_cost_gel,
           {at('revenue', 0)} AS naive_revenue_gel, {at('gained', 0)} AS incremental_revenue_gel,
           {at('(gained - cost) / NULLIF(cost, 0)', 2)} AS incremental_roi, {at('cost / NULLIF(extra, 0)', 2)} AS cost_per_incremental_gel
    FROM lifted"""


SQL["campaign_lift"] = with_star(_lift_sql(False), "resp", lifted=C_LIFT)
SQL["campaign_lift_report"] = with_star(_lift_sql(True), "resp", lifted=C_LIFT)


def _arms(group: str, source: str) -> str:
    return f"""SELECT {group}, count(*) AS n, {_mean('responded', 'contacted = 1')} AS p_t, {_mean('responded', 'contacted = 0')} AS p_c,
        NULLIF(count(*) FILTER (WHERE contacted = 1), 0) AS n_t, NULLIF(count(*) FILTER (WHERE contacted = 0), 0) AS n_c FROM {source} GROUP BY 1"""


SQL["campaign_lift_by_segment"] = with_star("""
    SELECT segment, n AS customers, p_t AS treatment_rate, p_c AS control_rate, gap AS incremental_rate, gap - m AS ci_low, gap + m AS ci_high,
           CASE WHEN gap - m > 0 THEN 'TARGET' WHEN gap + m < 0 THEN 'SUPPRESS' ELSE 'NO EVIDENCE' END AS recommendation
    FROM (SELECT *, p_t - p_c AS gap, CAST(1.96 AS DOUBLE) * sqrt(p_t * (1 - p_t) / n_t + p_c * (1 - p_c) / n_c) AS m FROM arms)""",
    "txn", "resp", **RFM, arms=_arms("segment", "(SELECT resp.*, COALESCE(rfm_segment, 'No History') AS segment FROM resp LEFT JOIN rfm USING (customer_sk))"))
SQL["response_curve"] = with_star(f"""
    SELECT d AS days_since_contact, n AS responders, sum(n) OVER w AS cumulative, {_d('n')} / sum(n) OVER () AS pct_of_total,
           {_d('sum(n) OVER w')} / sum(n) OVER () AS cumulative_pct
    FROM (SELECT response_date - contact_date AS d, count(*) AS n FROM resp WHERE contacted = 1 AND responded = 1 GROUP BY 1)
    WINDOW w AS (ORDER BY d)""", "resp")
SQL["lift_by_group"] = with_star(
    "SELECT persona, p_t AS treatment, p_c AS control, p_t - p_c AS lift, n FROM arms", "resp", "persona",
    arms=_arms("persona", "resp JOIN persona USING (customer_sk)"))
SQL["activation_rates"] = with_star(f"""
    SELECT campaign_sk, {_mean('card_opened')} AS opened_rate, {_mean('activated')} AS activated_rate,
           {_d('sum(activated)')} / sum(card_opened) AS activated_of_opened FROM resp WHERE contacted = 1 GROUP BY campaign_sk""", "resp")
C_TRUTH = """
    SELECT campaign_sk, avg(true_tau) AS mean_tau, avg(least(greatest(true_p0 + true_tau, 0), 1) - true_p0) AS realisable
    FROM resp JOIN truth USING (customer_sk) WHERE contacted = 1 GROUP BY campaign_sk"""
SQL["truth_in_interval"] = with_star("""
    SELECT campaign_sk, lift AS incremental_rate, low AS ci_low, high AS ci_high, round(mean_tau, 9) AS mean_tau,
           round(realisable, 9) AS realisable_lift, CAST(realisable BETWEEN low AND high AS INTEGER) AS inside,
           round(lift - realisable, 9) AS gap, round(abs(lift - realisable) / se, 9) AS gap_in_se
    FROM lifted JOIN planted USING (campaign_sk)""", "resp", "truth", lifted=C_LIFT, planted=C_TRUTH)
SQL["campaign_summary"] = with_star("""
    SELECT campaign_sk, n_t + n_c AS eligible, n_t AS treated, n_c AS control, se AS lift_se, low AS lift_ci_low, high AS lift_ci_high,
           p_t AS treatment_response_rate, p_c AS control_response_rate, lift AS observed_lift, round(mean_tau, 9) AS true_mean_tau_treated,
           round(realisable, 9) AS true_realisable_lift, y_t AS naive_conversions, extra AS incremental_conversions,
           y_t / greatest(extra, CAST(1e-9 AS DOUBLE)) AS overstatement_factor, revenue / y_t AS avg_annual_value_gel,
           cost AS campaign_cost_gel, gained AS incremental_revenue_gel, (extra * (revenue / y_t) - cost) / greatest(cost, CAST(1e-9 AS DOUBLE)) AS roi
    FROM lifted JOIN planted USING (campaign_sk)""", "resp", "truth", lifted=C_LIFT, planted=C_TRUTH)
SQL["value_index"] = with_star(f"""
    SELECT customer_sk, {_d('monetary_gel')} / (SELECT quantile_cont({_d('monetary_gel')}, 0.5) FROM base) AS value_index FROM base""",
    "txn", base=RFM["base"])

# ---- every campaign at its own start ------------------------------------------------------------
_all_base = f"""
    SELECT campaign_sk, start_date, customer_sk, start_date - max(txn_date) AS recency_days, count(*) AS frequency, sum(amount_gel) AS monetary_gel,
           {_mean('amount_gel')} AS avg_ticket_gel
    FROM txn JOIN camps ON txn_date < start_date WHERE txn_type = 'purchase' GROUP BY 1, 2, 3"""
ALL_RFM = {
    "base": _all_base, "scored": RFM["scored"].replace("OVER (ORDER", "OVER (PARTITION BY campaign_sk ORDER"),
    "rfm": RFM["rfm"].replace("SELECT customer_sk", "SELECT campaign_sk, start_date, customer_sk")}
SQL["rfm_by_campaign"] = with_star("SELECT * FROM rfm", "txn", "camps", **ALL_RFM)
SQL["lift_by_campaign_segment"] = with_star("""
    SELECT campaign_sk, segment, n AS customers, p_t AS treatment_rate, p_c AS control_rate, gap AS incremental_rate, gap - m AS ci_low, gap + m AS ci_high,
           CASE WHEN gap - m > 0 THEN 'TARGET' WHEN gap + m < 0 THEN 'SUPPRESS' ELSE 'NO EVIDENCE' END AS recommendation
    FROM (SELECT *, p_t - p_c AS gap, CAST(1.96 AS DOUBLE) * sqrt(p_t * (1 - p_t) / n_t + p_c * (1 - p_c) / n_c) AS m FROM arms)""",
    "txn", "resps", "camps", **ALL_RFM, arms=_arms("campaign_sk, segment", """
        (SELECT resps.*, COALESCE(rfm_segment, 'No History') AS segment FROM resps LEFT JOIN rfm USING (campaign_sk, customer_sk))""").replace("GROUP BY 1", "GROUP BY 1, 2"))
SQL["response_curves"] = with_star(f"""
    SELECT campaign_sk, d AS days_since_contact, n AS responders, sum(n) OVER w AS cumulative, {_d('n')} / sum(n) OVER (PARTITION BY campaign_sk) AS pct_of_total,
           {_d('sum(n) OVER w')} / sum(n) OVER (PARTITION BY campaign_sk) AS cumulative_pct
    FROM (SELECT campaign_sk, response_date - contact_date AS d, count(*) AS n FROM resps WHERE contacted = 1 AND responded = 1 GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY campaign_sk ORDER BY d)""", "resps")
SQL["spend_concentration"] = with_star(f"""
    SELECT customer_sk, row_number() OVER w AS position, {_d('monetary_gel')} AS monetary_gel, {_d('sum(monetary_gel) OVER w')} AS cumulative,
           {_d('row_number() OVER w')} / count(*) OVER () AS cumulative_rows,
           {_d('sum(monetary_gel) OVER w')} / {_d('sum(monetary_gel) OVER ()')} AS cumulative_share
    FROM base WINDOW w AS (ORDER BY monetary_gel DESC, customer_sk ROWS UNBOUNDED PRECEDING)""", "txn", base=RFM["base"])

# ---- distributions ----------------------------------------------------------------------------
SQL["share_vs_expected"] = with_star(f"""
    SELECT mcc_category, COALESCE(a.share, 0) AS actual_share, e.share AS expected_share, COALESCE(a.share, 0) - e.share AS gap
    FROM (SELECT mcc_category, {_d('count(*)')} / sum(count(*)) OVER () AS share FROM dimm WHERE merchant_sk <> 0 GROUP BY 1) e
    LEFT JOIN (SELECT mcc_category, {_d('count(*)')} / sum(count(*)) OVER () AS share FROM txn WHERE txn_type = 'purchase' GROUP BY 1) a
    USING (mcc_category)""", "dimm", "txn")
SQL["event_mix"] = with_star(
    f"SELECT txn_type, count(*) AS n, {_d('count(*)')} / sum(count(*)) OVER () AS share FROM txn GROUP BY 1", "txn")
SQL["event_type_mix"] = f"SELECT event_type, count(*) AS n, {_d('count(*)')} / sum(count(*)) OVER () AS share FROM events GROUP BY 1"
SQL["monthly_volume"] = with_star(f"""
    SELECT CAST(date_trunc('month', txn_date) AS DATE) AS month, count(*) AS n, {_d('count(*)')} / max(count(*)) OVER () AS of_peak
    FROM txn GROUP BY 1""", "txn")
SQL["mix_crosstab"] = with_star("SELECT persona, " + ", ".join(
    f"{_d(f'''count(*) FILTER (WHERE channel = '{c}')''')} / count(*) AS {c}" for c in CHANS if c != "atm")
    + " FROM txn JOIN persona USING (customer_sk) WHERE txn_type = 'purchase' GROUP BY persona", "txn", "persona")
SQL["amount_distribution"] = with_star(f"""
    SELECT round(quantile_cont({_d('amount_gel')}, 0.5), 6) AS median, {_mean('amount_gel')} AS mean,
           round(quantile_cont({_d('amount_gel')}, 0.95), 6) AS p95,
           {_d('max(amount_gel)')} AS max FROM txn WHERE txn_type = 'purchase'""", "txn")
SQL["avg_ticket_by_category"] = with_star(
    f"SELECT mcc_category, {_mean('amount_gel')} AS avg_ticket_gel FROM txn WHERE txn_type = 'purchase' GROUP BY 1", "txn")
SQL["balance_by_group"] = with_star(f"""
    SELECT persona, {_mean('balance_gel')} AS mean, quantile_cont({_d('balance_gel')}, 0.5) AS median, round(stddev_samp({_d('balance_gel')}), 4) AS sd
    FROM snap JOIN persona USING (customer_sk) WHERE product_sk = 1 GROUP BY persona""", "snap", "persona")
SQL["balance_path"] = with_star("SELECT customer_sk, month_end_date, " + ", ".join(
    f"{_d(f'max(balance_gel) FILTER (WHERE product_sk = {p})')} AS product_{p}" for p in range(1, 7)) + " FROM snap GROUP BY 1, 2", "snap")
SQL["range_by_group"] = with_star(f"""
    SELECT CASE k WHEN 0 THEN 'persuadable' WHEN 1 THEN 'sure_thing' WHEN 2 THEN 'lost_cause' ELSE 'sleeping_dog' END AS archetype,
           count(*) AS n, min(true_p0) AS min_true_p0, max(true_p0) AS max_true_p0, min(true_tau) AS min_true_tau, max(true_tau) AS max_true_tau,
           {_d('count(*)')} / sum(count(*)) OVER () AS share
    FROM (SELECT truth.*, {slot('c', 'type')} % 4 AS k FROM truth JOIN cust USING (customer_sk)) GROUP BY k""", "truth", "cust")
SQL["mean_by_group"] = with_star(
    "SELECT persona, round(avg(true_tau), 9) AS avg_true_tau FROM truth JOIN persona USING (customer_sk) GROUP BY persona", "truth", "persona")

# ---- uplift and evaluation ----------------------------------------------------------------------
SQL["clustering_agreement"] = with_star("""
    SELECT round((ij - i * j / p) / ((i + j) / 2 - i * j / p), 8) AS adjusted_rand_index,
           round(mi / ((hc + hl) / 2), 8) AS normalized_mutual_information, round(top / t, 8) AS purity
    FROM (SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS ij, (SELECT sum(n * (n - 1) / 2) FROM a) AS i,
                 (SELECT sum(n * (n - 1) / 2) FROM b) AS j, t * (t - 1) / 2 AS p, t, (SELECT sum(top) FROM a) AS top,
                 (SELECT -sum(n / t * ln(n / t)) FROM a) AS hc, (SELECT -sum(n / t * ln(n / t)) FROM b) AS hl,
                 (SELECT sum(x.n / t * ln(x.n * t / (a.n * b.n))) FROM cells x JOIN a USING (income_band) JOIN b USING (persona)) AS mi
          FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM dimc))""", "dimc", "persona",
    cells="SELECT income_band, persona, CAST(count(*) AS DOUBLE) AS n FROM dimc JOIN persona USING (customer_sk) GROUP BY 1, 2",
    a="SELECT income_band, sum(n) AS n, max(n) AS top FROM cells GROUP BY 1", b="SELECT persona, sum(n) AS n FROM cells GROUP BY 1")
def _leaks(columns: list[str], source: str) -> str:
    """One-way ANOVA over the bands; a column without any spread has F 0."""
    names = ", ".join(columns)
    values = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"""
    SELECT feature, CASE WHEN low = high THEN 0 WHEN within = 0 THEN CAST('inf' AS DOUBLE)
                         ELSE round((between_ / (k - 1)) / (within / (n - k)), 6) END AS f_statistic,
           CAST(within = 0 AND low < high AS INTEGER) AS leaked
    FROM (SELECT feature, count(DISTINCT income_band) AS k, count(*) AS n, min(x) AS low, max(x) AS high,
                 sum((gm - m) ** 2) AS between_, sum((x - gm) ** 2) AS within
          FROM (SELECT *, avg(x) OVER (PARTITION BY feature) AS m, avg(x) OVER (PARTITION BY feature, income_band) AS gm
                FROM (SELECT income_band, feature, v AS x FROM
                      (UNPIVOT (SELECT income_band, {values} FROM {source}) ON {names} INTO NAME feature VALUE v)))
          GROUP BY feature)"""


SQL["leak_scan"] = with_star(_leaks(["age", "tenure_years", "existing_product_count", "digital_engagement_flag"], "dimc"), "dimc")
SQL["leak_scan_matrix"] = with_star(
    _leaks(["age", "tenure_years", "existing_product_count", *_matrix_columns], f"({_matrix_sql})"), "txn", "snap", "prod", "dimc",
    **{f"f{i}": _unrounded(q) for i, q in enumerate(_parts)})
_points = ["age_z", "tenure_years_z", "existing_product_count_z"]
_apart = lambda a, b: " + ".join(f"({a}.{c} - {b}.{c}) ** 2" for c in _points)
#: The silhouette over all pairs of points.
SQL["cluster_quality"] = with_star(f"""
    SELECT income_band, count(*) AS points, round(sum(d), 5) AS cost, round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
    FROM (SELECT p.customer_sk, p.income_band, p.d, (SELECT count(*) FROM near q WHERE q.income_band = p.income_band) AS n,
                 sum(m.total) FILTER (WHERE m.other = p.income_band) / NULLIF(max(m.n) FILTER (WHERE m.other = p.income_band) - 1, 0) AS a,
                 min(m.total / m.n) FILTER (WHERE m.other <> p.income_band) AS b
          FROM near p JOIN means m USING (customer_sk) GROUP BY 1, 2, 3)
    GROUP BY income_band""", "dimc",
    points="SELECT customer_sk, income_band AS band, " + ", ".join(
        f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0) AS {c}_z" for c in ("age", "tenure_years", "existing_product_count")) + " FROM dimc",
    centers="SELECT band AS income_band, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in _points) + " FROM points GROUP BY band",
    near=f"""SELECT p.*, c.income_band, {_apart('p', 'c')} AS d FROM points p CROSS JOIN centers c
             QUALIFY row_number() OVER (PARTITION BY customer_sk ORDER BY {_apart('p', 'c')}, c.income_band) = 1""",
    means=f"SELECT p.customer_sk, q.income_band AS other, count(*) AS n, sum({_apart('p', 'q')}) AS total FROM near p CROSS JOIN near q GROUP BY 1, 2")


def _newton(step: int) -> str:
    """Slope and intercept of each arm after one step more: the two normal equations solved by hand; the slope's square weighs 1."""
    return f"""
    SELECT assignment, b0 + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b0, b1 + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b1
    FROM (SELECT assignment, b0, b1, sum(y - p) AS g0, sum((y - p) * x) - b1 AS g1, sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01,
                 sum(p * (1 - p) * x * x) + 1 AS h11
          FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM training JOIN beta{step} USING (assignment)) GROUP BY assignment, b0, b1)"""


_model = lambda arm: f"1 / (1 + exp(-(SELECT b0 + b1 * z.x FROM beta4 WHERE assignment = '{arm}')))"
SQL["newton_uplift"] = with_star(f"""
    SELECT customer_sk, round({_model('treatment')}, 9) AS propensity, round({_model('treatment')} - {_model('control')}, 9) AS uplift FROM z""",
    "dimc", "resp", z="SELECT customer_sk, (CAST(age AS DOUBLE) - 48) / 18 AS x FROM dimc",
    training="SELECT assignment, CAST(responded AS DOUBLE) AS y, x FROM z JOIN resp USING (customer_sk)",
    beta0="SELECT DISTINCT assignment, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1 FROM resp", **{f"beta{i + 1}": _newton(i) for i in range(4)})
U_BINS = f"""
    SELECT customer_sk, score, ntile(20) OVER (ORDER BY score DESC, customer_sk) AS bin
    FROM (SELECT customer_sk, CAST(acctbal AS DOUBLE) / 50000 + CAST({slot('c', 'score', 1000)} AS DOUBLE) / 10000 - CAST(0.05 AS DOUBLE) AS score FROM cust)"""
SQL["equal_budget_by_score"] = with_star("""
    SELECT ranking, count(*) AS customers, round(avg(responded) FILTER (WHERE assignment = 'treatment')
           - avg(responded) FILTER (WHERE assignment <> 'treatment'), 9) AS lift
    FROM (SELECT customer_sk, 'uplift' AS ranking, bin FROM bins
          UNION ALL SELECT customer_sk, 'propensity', ntile(20) OVER (ORDER BY acctbal DESC, customer_sk) FROM cust)
    JOIN resp USING (customer_sk) WHERE bin <= 6 GROUP BY ranking""", "cust", "resp", bins=U_BINS)
U_RUN = """
    SELECT bin, sum(n_t) OVER w AS n_t, sum(n_c) OVER w AS n_c, sum(y_t) OVER w AS y_t, sum(y_c) OVER w AS y_c
    FROM (SELECT bin, sum(contacted) AS n_t, sum(1 - contacted) AS n_c, sum(contacted * responded) AS y_t, sum((1 - contacted) * responded) AS y_c
          FROM bins JOIN resp USING (customer_sk) GROUP BY bin) WINDOW w AS (ORDER BY bin)"""
U_QINI = f"""
    SELECT *, {_d('n_t + n_c')} / max(n_t + n_c) OVER () AS targeted_share,
           arg_max(qini, bin) OVER () * ({_d('n_t + n_c')} / max(n_t + n_c) OVER ()) AS random
    FROM (SELECT *, y_t - COALESCE({_d('y_c * n_t')} / NULLIF(n_c, 0), 0) AS qini FROM run)"""
SQL["qini_curve"] = with_star("SELECT * FROM q", "cust", "resp", bins=U_BINS, run=U_RUN, q=U_QINI)
SQL["qini_area"] = with_star("""
    SELECT round(sum((gap + COALESCE(lag_gap, 0)) / 2 * (targeted_share - COALESCE(lag_share, 0))), 8) AS qini_area
    FROM (SELECT qini - random AS gap, targeted_share, lag(qini - random) OVER (ORDER BY bin) AS lag_gap,
                 lag(targeted_share) OVER (ORDER BY bin) AS lag_share FROM q)""", "cust", "resp", bins=U_BINS, run=U_RUN, q=U_QINI)
U_PLAN = """
    SELECT *, sum(CASE WHEN contact = 1 THEN profit ELSE 0 END) OVER (ORDER BY bin) AS total
    FROM (SELECT *, CAST(n > 0 AND min(profit) OVER (ORDER BY bin) > 0 AS INTEGER) AS contact
          FROM (SELECT bin, count(*) AS customers, count(*) FILTER (WHERE score > 0) AS n, COALESCE(sum(score) FILTER (WHERE score > 0), 0) AS conv,
                       COALESCE(sum(score) FILTER (WHERE score > 0), 0) * 250 - count(*) FILTER (WHERE score > 0) * 20 AS profit
                FROM bins GROUP BY bin))"""
SQL["targeting_plan"] = with_star("""
    SELECT bin, customers, n AS contactable, round(conv, 7) AS expected_conversions, round(profit, 6) AS expected_profit,
           contact, round(total, 6) AS cumulative_profit FROM plan""", "cust", bins=U_BINS, plan=U_PLAN)
SQL["targeting_cutoff"] = with_star("""
    SELECT customer_sk, position, round(score, 9) AS score, CAST(gain AS DOUBLE) / 10000 AS gain_gel, CAST(position * 200000 AS DOUBLE) / 10000 AS spent_gel,
           CAST(profit AS DOUBLE) / 10000 AS profit_gel,
           CAST(position <= COALESCE((SELECT min(position) FROM r WHERE profit > 0 AND profit = (SELECT max(profit) FROM r)), 0) AS INTEGER) AS contact
    FROM r""", "cust", bins=U_BINS, r="""
    SELECT *, row_number() OVER w AS position, sum(gain) OVER w AS profit
    FROM (SELECT customer_sk, score, CAST(round(score * 250 * 10000) AS BIGINT) - 200000 AS gain FROM bins)
    WINDOW w AS (ORDER BY score DESC, customer_sk ROWS UNBOUNDED PRECEDING)""")
SQL["budget_table"] = with_star("""
    SELECT budget, count(*) FILTER (WHERE spent <= budget) AS bins, COALESCE(sum(n) FILTER (WHERE spent <= budget), 0) AS contacts,
           COALESCE(max(spent) FILTER (WHERE spent <= budget), 0) AS spend_gel,
           round(COALESCE(sum(conv) FILTER (WHERE spent <= budget), 0), 7) AS expected_conversions,
           round(COALESCE(sum(profit) FILTER (WHERE spent <= budget), 0), 6) AS expected_profit_gel
    FROM (SELECT *, CAST(sum(n) OVER (ORDER BY bin) * 20 AS DOUBLE) AS spent FROM plan WHERE contact = 1)
    CROSS JOIN (VALUES (CAST(500 AS DOUBLE)), (2000), (10000)) v(budget) GROUP BY budget""", "cust", bins=U_BINS, plan=U_PLAN)
