"""The star schema over the raw test tables as DuckDB common table expressions.

Written apart from ``verification.adapter``: the two must agree for any query to match.
"""

from __future__ import annotations


def slot(key: str, salt: str = "", slots: int = 100) -> str:
    text = f"{key} || '{salt}'" if salt else key
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % {slots})"


def _key(d: str) -> str:
    return f"COALESCE(year({d}) * 10000 + month({d}) * 100 + day({d}), 0)"


def _nth(values: list[str], index: str) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {v!r}" for i, v in enumerate(values)) + " END"


# Spending categories with their merchant codes, and channels.
CATS = ["groceries", "dining", "ecommerce", "entertainment", "transport",
        "fuel", "utilities", "healthcare", "retail", "travel"]
MCC = [5411, 5812, 5399, 7832, 4111, 5541, 4900, 8011, 5651, 4722]
CHANS = ["pos", "ecommerce", "atm", "mobile_app", "internet_bank", "branch"]

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTES[name] = (needs, sql)


_cte("txn", (), f"""
    SELECT customer_sk, txn_date, txn_type, amount_gel, {_key('txn_date')} AS date_sk,
           CASE txn_type WHEN 'purchase' THEN l_suppkey + 1 ELSE 0 END AS merchant_sk,
           CASE txn_type WHEN 'inflow' THEN 'credit' ELSE 'debit' END AS direction,
           CASE txn_type WHEN 'cash_withdrawal' THEN 'atm' WHEN 'inflow' THEN 'transfer' ELSE
             CASE o_orderpriority WHEN '1-URGENT' THEN 'pos' WHEN '2-HIGH' THEN 'ecommerce' WHEN '3-MEDIUM' THEN 'mobile_app'
               WHEN '4-NOT SPECIFIED' THEN 'internet_bank' WHEN '5-LOW' THEN 'branch' END END AS channel,
           CASE txn_type WHEN 'purchase' THEN {_nth(CATS, 'l_suppkey % 10')} ELSE 'n/a' END AS mcc_category
    FROM (SELECT o_custkey AS customer_sk, CAST(o_orderdate AS DATE) AS txn_date, l_suppkey, o_orderpriority,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS amount_gel,
                 CASE WHEN l_returnflag <> 'R' THEN 'purchase' WHEN l_linestatus = 'F' THEN 'cash_withdrawal' ELSE 'inflow' END AS txn_type
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
_cte("cust", (), """
    SELECT c_custkey AS customer_sk, CAST(c_custkey AS VARCHAR) AS c, CAST(c_acctbal AS DECIMAL(14,2)) AS acctbal, c_nationkey
    FROM customer""")
_cte("prod", (), """
    SELECT CAST(product_sk AS BIGINT) AS product_sk, product_name, product_group, pct FROM (VALUES
      (1, 'Current Account', 'daily_banking', 100), (2, 'Debit Card', 'daily_banking', 100), (3, 'Credit Card', 'lending', 20),
      (4, 'Savings Account', 'deposits', 40), (5, 'Term Deposit', 'deposits', 20), (6, 'Consumer Loan', 'lending', 25)
    ) v(product_sk, product_name, product_group, pct)""")
_cte("hold", ("cust", "prod"), f"""
    SELECT customer_sk, c, cp, acctbal, product_sk,
           CASE WHEN product_sk <= 2 OR {slot('cp', 'o')} < 85 THEN -1 ELSE 1 + {slot('cp', 'm')} % 11 END AS open_month_idx,
           {slot('cp', 'b')} AS balance_slot
    FROM (SELECT *, c || '-' || CAST(product_sk AS VARCHAR) AS cp FROM cust CROSS JOIN prod)
    WHERE {slot('cp', 'h')} < pct""")
_cte("live", ("hold",), """
    SELECT hold.*, m AS month_idx, last_day(CAST(DATE '2000-02-01' + to_months(CAST(m AS INTEGER)) AS DATE)) AS month_end_date
    FROM hold CROSS JOIN range(0, 12) r(m) WHERE open_month_idx <= m""")
_cte("snap", ("live",), f"""
    SELECT customer_sk, product_sk, month_end_date, {_key('month_end_date')} AS date_sk,
           CAST(CASE product_sk WHEN 1 THEN acctbal + 20 * ({slot("c || 'b' || CAST(month_idx AS VARCHAR)")} - 50)
                WHEN 2 THEN 0 WHEN 3 THEN -15 * balance_slot WHEN 4 THEN 8 * abs(acctbal)
                WHEN 5 THEN 25 * abs(acctbal) ELSE -90 * balance_slot END AS DECIMAL(14,2)) AS balance_gel,
           CAST(open_month_idx = month_idx AS INTEGER) AS opened_this_month, 1 AS is_held
    FROM live""")
def _responses(campaign: int, start: str, salt: str) -> str:
    return f"""
    SELECT customer_sk, CAST({campaign} AS BIGINT) AS campaign_sk, assignment, treated AS contacted, contact_date, {_key('contact_date')} AS contact_date_sk,
           responded, response_date, {_key('response_date')} AS response_date_sk,
           CAST(responded = 1 OR {slot('c', 'dorm')} < 4 AS INTEGER) AS card_opened, responded AS activated,
           CAST(CASE WHEN responded = 1 THEN 100 + 3 * {slot('c', 'v')} ELSE 0 END AS DECIMAL(12,2)) AS annual_value_gel,
           CAST(CASE WHEN treated = 1 THEN 2.5 ELSE 0 END AS DECIMAL(8,2)) AS contact_cost_gel
    FROM (SELECT *, CASE WHEN responded = 1 THEN
                 CASE WHEN treated = 1 THEN contact_date + CAST({slot('c', 'd' + salt)} % 60 + 1 AS INTEGER)
                      ELSE DATE '{start}' + CAST({slot('c', 'g')} % 70 AS INTEGER) END END AS response_date
          FROM (SELECT *, CASE treated WHEN 1 THEN 'treatment' ELSE 'control' END AS assignment,
                       CASE treated WHEN 1 THEN DATE '{start}' + CAST({slot('c', 'c')} % 10 AS INTEGER) END AS contact_date,
                       CAST({slot('c', 'resp' + salt)} < CASE treated WHEN 1 THEN 32 ELSE 22 END AS INTEGER) AS responded
                FROM (SELECT customer_sk, c, CAST({slot('c', 'arm' + salt)} < 70 AS INTEGER) AS treated FROM cust
                      WHERE customer_sk NOT IN (SELECT customer_sk FROM hold WHERE product_sk = 3))))"""


CAMPAIGNS = ((1, "2001-01-01", ""), (2, "1998-03-20", "k2"), (3, "1996-11-01", "k3"))
_cte("resp", ("cust", "hold"), _responses(*CAMPAIGNS[0]))
_cte("resps", ("cust", "hold"), " UNION ALL ".join(_responses(*c) for c in CAMPAIGNS))
_cte("camps", (), "SELECT CAST(campaign_sk AS BIGINT) AS campaign_sk, CAST(start_date AS DATE) AS start_date FROM (VALUES "
     + ", ".join(f"({k}, '{start}')" for k, start, _ in CAMPAIGNS) + ") v(campaign_sk, start_date)")
_cte("dimc", ("cust", "hold"), f"""
    SELECT customer_sk, CAST(18 + {slot('c', 'age')} % 60 AS INTEGER) AS age,
           CASE {slot('c', 'sex')} % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender, n_name AS city,
           CASE WHEN acctbal < 0 THEN 'low' WHEN acctbal < 3000 THEN 'low_mid' WHEN acctbal < 7000 THEN 'mid' ELSE 'high' END AS income_band,
           {_nth(['employed', 'self_employed', 'retired', 'student'], slot('c', 'emp') + ' % 4')} AS employment,
           CAST({slot('c', 'ten')} % 30 AS INTEGER) AS tenure_years,
           CAST(DATE '2001-01-01' - to_months(CAST(12 * ({slot('c', 'ten')} % 30) AS INTEGER)) AS DATE) AS relationship_start_date,
           CAST(COALESCE(held, 0) AS INTEGER) AS existing_product_count, CAST(acctbal >= 3000 AS INTEGER) AS digital_engagement_flag
    FROM cust JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT customer_sk, count(*) AS held FROM hold GROUP BY 1) h USING (customer_sk)""")
_cte("dimm", (), f"""
    SELECT s_suppkey + 1 AS merchant_sk, {_nth([c.title() for c in CATS], 's_suppkey % 10')} || ' Merchant ' ||
           CASE WHEN s_suppkey // 10 + 1 < 10 THEN '0' ELSE '' END || CAST(s_suppkey // 10 + 1 AS VARCHAR) AS merchant_name,
           CAST({'CASE s_suppkey % 10 ' + ' '.join(f'WHEN {i} THEN {m}' for i, m in enumerate(MCC)) + ' END'} AS INTEGER) AS mcc_code,
           {_nth(CATS, 's_suppkey % 10')} AS mcc_category FROM supplier
    UNION ALL SELECT 0, 'Not Applicable', 0, 'n/a'""")
_cte("dimd", (), f"""
    SELECT {_key('d')} AS date_sk, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
           CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend,
           CAST(d = last_day(d) AS INTEGER) AS is_month_end, strftime(d, '%Y-%m') AS year_month
    FROM (SELECT CAST(UNNEST(generate_series(date_trunc('year', min(o_orderdate)),
            date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
    UNION ALL SELECT 0, NULL, NULL, NULL, NULL, 'Unknown', NULL, NULL, 'Unknown', NULL, NULL, NULL""")
_cte("persona", (), "SELECT c_custkey AS customer_sk, lower(c_mktsegment) AS persona FROM customer")
_cte("truth", ("cust",), f"""
    SELECT customer_sk, p0 AS true_p0, tau AS true_tau FROM (SELECT customer_sk,
      CAST(CASE k WHEN 0 THEN 0.10 WHEN 1 THEN 0.97 WHEN 2 THEN 0.04 ELSE 0.08 END AS DOUBLE) AS p0,
      CAST(CASE k WHEN 0 THEN 0.24 WHEN 1 THEN 0.06 WHEN 2 THEN 0.02 ELSE -0.12 END AS DOUBLE) AS tau
      FROM (SELECT customer_sk, {slot('c', 'type')} % 4 AS k FROM cust))""")


def with_star(body: str, *needed: str, recursive: bool = False, **extra: str) -> str:
    """``body`` preceded by the CTEs it needs and by ``extra`` ones, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    parts = [f"{n} AS ({CTES[n][1].strip()}\n)" for n in order] + [f"{n} AS ({q.strip()}\n)" for n, q in extra.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()
