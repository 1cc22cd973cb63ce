"""Reference SQL for the registered queries, for DuckDB over the same tables.

Each text is written from the definition of the query, not from its plan. Money
is summed as whole paise and means are held to the same number of decimals, so
both engines give identical doubles.
"""

from __future__ import annotations

from ledgermill.functions import bands
from ledgermill.schemas import FOREIGN_KEYS, PRIMARY_KEYS, PRODUCT_OF_REVENUE, PRODUCT_SHARES
from ledgermill.verification.queries import COSTLY, DRILL_BRANCH

AS_OF = "2024-06-30"
RUN = "2024-06-30 12:00:00"
RANGE = 2147483648


def money(x: str) -> str:
    return f"(CAST(sum(CAST(round(({x}) * 100) AS BIGINT)) AS DOUBLE) / 100)"


def mean_money(x: str) -> str:
    return f"(CAST(sum(CAST(round(({x}) * 100) AS BIGINT)) AS DOUBLE) / (count({x}) * 100))"


def mean_rate(x: str) -> str:
    return f"(CAST(sum(CAST(round(({x}) * 1000000) AS BIGINT)) AS DOUBLE) / (count({x}) * 1000000))"


def mean_ratio(x: str) -> str:
    return (
        f"(CAST(sum(CAST(round_even(({x}) * 1000000000, 0) AS HUGEINT)) AS DOUBLE)"
        f" / (count({x}) * 1000000000))"
    )


def ratio(a: str, b: str, default: str = "0.0") -> str:
    return f"(CASE WHEN {b} > 0 THEN {a} / {b} ELSE {default} END)"


def draw(key: str, seed: int) -> str:
    return f"((({key} + {seed}) % {RANGE} * 1103515245 + 12345) % {RANGE})"


def between(key: str, seed: int, low: int, high: int) -> str:
    return f"CAST({low} + floor({draw(key, seed)} / {RANGE} * {high - low}) AS INTEGER)"


def day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def second(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def below(x: str, bounds: bands.Bounds, last: str) -> str:
    """CASE over strict upper bounds."""
    steps = " ".join(f"WHEN {x} < {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE {steps} ELSE '{last}' END"


def above(x: str, bounds: bands.Bounds, last: str) -> str:
    """CASE over strict lower bounds."""
    steps = " ".join(f"WHEN {x} > {bound} THEN '{label}'" for bound, label in bounds)
    return f"CASE {steps} ELSE '{last}' END"


def choice(x: str, table: dict[str, str]) -> str:
    steps = " ".join(f"WHEN '{key}' THEN '{label}'" for key, label in table.items())
    return f"CASE {x} {steps} END"


EFFICIENCY = below("cost_income_ratio", bands.EFFICIENCY_RATINGS, "Needs Improvement")
PRODUCTIVITY = above("transaction_per_staff", bands.PRODUCTIVITY_RATINGS, "Low Productivity")
TIER = above("profit_margin", bands.VALUE_TIERS, "Low Value")
RATE_RISK = above("interest_rate", bands.RATE_RISKS, "Low Risk")
SEGMENT = above("account_balance", bands.CUSTOMER_SEGMENTS, "BASIC")

CTES: dict[str, str] = {
    "branches": """
        SELECT s_suppkey AS branch_id, s_name AS branch_name, n_name AS city, r_name AS region,
               CAST(8 + s_suppkey % 42 AS INTEGER) AS staff_count
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "customers": f"""
        SELECT *, {SEGMENT} AS customer_segment
        FROM (SELECT c_custkey AS customer_id, n_name AS city,
                     CAST(18 + c_custkey % 63 AS INTEGER) AS age,
                     floor(c_acctbal * 6000 + 0.5) / 100 AS account_balance,
                     (c_custkey * 7919) % 1500000 AS annual_income,
                     DATE '2016-01-01' + CAST(c_custkey % 2900 AS INTEGER) AS customer_since
              FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "transactions": """
        SELECT event_id AS transaction_id, user_id AS customer_id,
               floor(value * 2000 + 0.5) / 100 AS amount,
               CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER'
                    WHEN 'signup' THEN 'DEPOSIT' WHEN 'purchase' THEN 'PURCHASE'
                    ELSE 'WITHDRAWAL' END AS transaction_type,
               ts AS "timestamp",
               CASE WHEN event_id % 50 = 0 THEN 1000000000 + event_id % 7
                    ELSE event_id % (SELECT count(*) FROM supplier) END AS branch_id
        FROM events""",
    "revenue": """
        SELECT l_orderkey * 10 + l_linenumber AS revenue_id, o_custkey AS customer_id,
               l_suppkey AS branch_id,
               CASE WHEN l_returnflag = 'A' THEN 'ACCOUNT_MAINTENANCE_FEE'
                    WHEN l_returnflag = 'N' THEN 'TRANSACTION_FEE'
                    WHEN l_linestatus = 'F' THEN 'INTEREST_INCOME' ELSE 'LATE_FEE' END
               AS revenue_type,
               floor(floor(l_extendedprice * 100 + 0.5) * floor(l_discount * 100 + 0.5) / 100
                     + 0.5) / 100 AS amount,
               CAST(l_shipdate AS DATE) AS event_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "costs": """
        SELECT l_orderkey * 10 + l_linenumber AS cost_id, l_suppkey AS branch_id,
               CASE l_linenumber % 5 WHEN 0 THEN 'STAFF_SALARIES' WHEN 1 THEN 'TECHNOLOGY'
                    WHEN 2 THEN 'FACILITIES' WHEN 3 THEN 'MARKETING' ELSE 'COMPLIANCE' END
               AS cost_category,
               floor(floor(l_extendedprice * 100 + 0.5) * floor(l_tax * 100 + 0.5)
                     * (31 + l_suppkey % 62) / 6200 + 0.5) / 100 AS amount,
               CAST(l_shipdate AS DATE) AS cost_date
        FROM lineitem""",
    "loans": """
        SELECT o_orderkey AS loan_id, o_custkey AS customer_id,
               floor(o_totalprice * 400 + 0.5) / 100 AS loan_amount,
               floor(floor(o_totalprice * 400 + 0.5) * (20 + o_orderkey % 61) / 100 + 0.5) / 100
               AS outstanding_balance,
               (85 + o_orderkey % 96) / 1000 AS interest_rate,
               CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'HOME_LOAN'
                    WHEN '2' THEN 'PERSONAL_LOAN' WHEN '3' THEN 'CAR_LOAN'
                    ELSE 'EDUCATION_LOAN' END AS loan_type,
               CAST(o_orderdate AS DATE) AS start_date,
               CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
               o_custkey % (SELECT count(*) FROM supplier) AS branch_id
        FROM orders""",
    "branch_sums": f"""
        SELECT branch_id, total_revenue, total_costs, transaction_count
        FROM (SELECT branch_id, {money('amount')} AS total_revenue FROM revenue GROUP BY branch_id)
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_costs FROM costs GROUP BY branch_id)
             USING (branch_id)
        LEFT JOIN (SELECT branch_id, count(transaction_id) AS transaction_count
                   FROM transactions GROUP BY branch_id) USING (branch_id)""",
    "branch_mart": f"""
        SELECT branch_id, total_revenue, coalesce(total_costs, 0) AS total_costs,
               total_revenue - coalesce(total_costs, 0) AS net_income,
               {ratio('coalesce(total_costs, 0)', 'total_revenue')} AS cost_income_ratio,
               transaction_count,
               CASE WHEN transaction_count > 0 THEN transaction_count / 20 ELSE 0.0 END
               AS transaction_per_staff
        FROM branch_sums""",
    "branch_view": f"""
        SELECT *, {EFFICIENCY} AS efficiency_rating, {PRODUCTIVITY} AS productivity_rating
        FROM branch_mart""",
    "branch_details": """
        SELECT v.*, b.branch_name, b.city, b.region
        FROM branch_view v LEFT JOIN branches b USING (branch_id)""",
    "customer_sums": f"""
        SELECT c.customer_id, customer_segment, coalesce(total_revenue, 0) AS total_revenue,
               transaction_count
        FROM customers c
        LEFT JOIN (SELECT customer_id, {money('amount')} AS total_revenue
                   FROM revenue GROUP BY customer_id) USING (customer_id)
        LEFT JOIN (SELECT customer_id, count(transaction_id) AS transaction_count
                   FROM transactions GROUP BY customer_id) USING (customer_id)""",
    "customer_mart": f"""
        SELECT customer_id, customer_segment, total_revenue, estimated_costs,
               total_revenue - estimated_costs AS net_profit,
               {ratio('(total_revenue - estimated_costs)', 'total_revenue')} AS profit_margin
        FROM (SELECT *, transaction_count * CAST(5 AS DOUBLE) AS estimated_costs
              FROM customer_sums)""",
    "costly_mart": f"""
        SELECT customer_id, customer_segment, total_revenue, estimated_costs,
               total_revenue - estimated_costs AS net_profit,
               {ratio('(total_revenue - estimated_costs)', 'total_revenue')} AS profit_margin
        FROM (SELECT *, transaction_count * CAST({COSTLY} AS DOUBLE) AS estimated_costs
              FROM customer_sums)""",
    "silver_people": f"""
        SELECT *, {below('age', bands.AGE_GROUPS, '65+')} AS age_group,
               {below('annual_income', bands.INCOME_SEGMENTS, 'High')} AS income_segment,
               {below('account_balance', bands.BALANCE_SEGMENTS, 'High')} AS balance_segment
        FROM customers""",
    "people_details": f"""
        SELECT m.*, {TIER} AS value_tier, s.age, s.city, s.account_balance, s.annual_income,
               s.age_group, s.income_segment, s.balance_segment, s.customer_since
        FROM customer_mart m LEFT JOIN silver_people s USING (customer_id)""",
    "loan_mart": f"""
        SELECT branch_id, {money('loan_amount')} AS total_loan_portfolio,
               {money('outstanding_balance')} AS total_outstanding,
               {mean_rate('interest_rate')} AS avg_interest_rate, count(loan_id) AS active_loans
        FROM loans WHERE status = 'ACTIVE' GROUP BY branch_id""",
    "loan_view": f"""
        SELECT *, {ratio('total_outstanding', 'total_loan_portfolio')} AS utilization_rate,
               {above('avg_interest_rate', bands.RATE_CATEGORIES, 'Low Rate')} AS rate_category
        FROM loan_mart""",
    "revenue_months": f"""
        SELECT branch_id, revenue_type, {money('amount')} AS amount,
               {month('event_date')} AS month
        FROM revenue GROUP BY branch_id, revenue_type, {month('event_date')}""",
    "costs_months": f"""
        SELECT branch_id, cost_category, {money('amount')} AS amount, {month('cost_date')} AS month
        FROM costs GROUP BY branch_id, cost_category, {month('cost_date')}""",
    "ratio_months": f"""
        SELECT branch_id, month, CASE WHEN r <> 0 THEN c / r END AS cir
        FROM (SELECT branch_id, month, {money('amount')} AS r FROM revenue_months GROUP BY ALL)
        JOIN (SELECT branch_id, month, {money('amount')} AS c FROM costs_months GROUP BY ALL)
             USING (branch_id, month)
        WHERE branch_id IN (SELECT branch_id FROM branch_mart
                            ORDER BY total_revenue DESC, branch_id LIMIT 15)""",
    "features": f"""
        SELECT l.customer_id, loan_id, branch_id, loan_type, outstanding_balance, interest_rate,
               account_balance, CAST(annual_income AS DOUBLE) AS annual_income,
               {ratio('outstanding_balance', 'annual_income', '0.5')} AS loan_to_income_ratio
        FROM loans l JOIN customers c USING (customer_id)""",
    "labelled": """
        SELECT *, CASE WHEN loan_to_income_ratio > 0.8 AND interest_rate > 12 THEN 1
                       WHEN outstanding_balance > 1000000 THEN 1 ELSE 0 END AS is_default
        FROM features""",
    "raw": """
        SELECT 'T' || event_id AS "TransactionID", 'C' || user_id AS "CustomerID",
               CASE user_id % 17 WHEN 0 THEN '1/1/1800' WHEN 1 THEN 'nan' WHEN 2 THEN ''
                    ELSE (1 + user_id * 7 % 31) || '/' || (1 + user_id % 12) || '/'
                         || (40 + user_id * 3 % 60) END AS "CustomerDOB",
               CASE user_id % 11 WHEN 0 THEN '' WHEN 1 THEN 'male' WHEN 2 THEN 'F'
                    WHEN 3 THEN 'f' ELSE 'M' END AS "CustGender",
               CASE user_id % 7 WHEN 0 THEN 'MUMBAI' WHEN 1 THEN 'navi mumbai' WHEN 2 THEN ''
                    WHEN 3 THEN 'Delhi' WHEN 4 THEN 'PUNE' WHEN 5 THEN 'GURGAON'
                    ELSE 'chennai' END AS "CustLocation",
               CASE user_id % 13 WHEN 0 THEN '' WHEN 1 THEN 'abc'
                    ELSE (user_id * 7919 % 900000) || '.50' END AS "CustAccountBalance",
               CASE WHEN event_id % 29 = 0 THEN '' ELSE (1 + event_id % 31) || '/'
                    || (1 + event_id % 12) || '/' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0')
                    END AS "TransactionDate",
               CAST(event_id % 240000 AS VARCHAR) AS "TransactionTime",
               CASE WHEN event_id % 97 = 0 THEN 'abc'
                    ELSE CASE WHEN event_id % 5 = 0 THEN '-' ELSE '' END
                         || CAST(floor(value * 20 + 0.5) AS BIGINT) || '.25' END AS "RawAmount",
               event_id, user_id
        FROM events""",
    "dated": """
        SELECT *,
               TRY_CAST(printf('%04d-%02d-%02d',
                   CASE WHEN event_id % 100 < 50 THEN 2000 ELSE 1900 END + event_id % 100,
                   1 + event_id % 12, 1 + event_id % 31) AS DATE) AS any_date,
               CASE WHEN user_id % 17 > 2 AND 40 + user_id * 3 % 60 > 50 THEN
                    TRY_CAST(printf('%04d-%02d-%02d', 1940 + user_id * 3 % 60,
                        1 + user_id % 12, 1 + user_id * 7 % 31) AS DATE) END AS born
        FROM raw""",
    "cleaned": f"""
        SELECT 'KAGGLE_' || "CustomerID" AS customer_id, "CustomerID" AS original_customer_id,
               CASE WHEN user_id % 11 = 0 THEN
                    CASE WHEN {between('user_id', 11, 0, 2)} = 0 THEN 'M' ELSE 'F' END
                    WHEN user_id % 11 IN (2, 3) THEN 'F' ELSE 'M' END AS gender,
               CASE user_id % 7 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Navi Mumbai' WHEN 3 THEN 'Delhi'
                    WHEN 4 THEN 'Pune' WHEN 5 THEN 'Gurgaon' WHEN 6 THEN 'Chennai' END AS city,
               coalesce(TRY_CAST("CustAccountBalance" AS DOUBLE), 0) AS account_balance,
               coalesce(TRY_CAST("RawAmount" AS DOUBLE), 0) AS transaction_amount,
               CASE WHEN event_id % 29 <> 0 THEN any_date END AS transaction_date,
               "TransactionID" AS transaction_id, "TransactionTime" AS transaction_time,
               born AS date_of_birth,
               CAST(coalesce(date_diff('year', born, DATE '{AS_OF}')
                        - CASE WHEN strftime(born, '%m%d') > '0630' THEN 1 ELSE 0 END,
                        {between('user_id', 11, 25, 65)}) AS INTEGER) AS age,
               'kaggle_original' AS data_source,
               user_id % 11 = 0 AS gender_imputed, born IS NULL AS age_imputed,
               event_id, user_id
        FROM dated""",
    "ledger": f"""
        SELECT transaction_id, customer_id, 'ACC_' || split_part(customer_id, '_', 2) AS account_id,
               abs(transaction_amount) AS amount,
               CASE WHEN transaction_amount > 0 THEN 'DEPOSIT' ELSE 'PURCHASE' END
               AS transaction_type,
               CASE WHEN abs(transaction_amount) < 500 THEN
                    ['GROCERIES', 'COFFEE', 'TRANSPORT', 'UTILITIES'][choice]
                    WHEN abs(transaction_amount) < 5000 THEN
                    ['SHOPPING', 'DINING', 'ENTERTAINMENT', 'SERVICES'][choice]
                    ELSE ['ELECTRONICS', 'TRAVEL', 'HOME_IMPROVEMENT', 'EDUCATION'][choice] END
               AS category,
               CASE WHEN transaction_amount > 0 THEN 'BANK_CREDIT' END AS merchant,
               {day('transaction_date')} AS "timestamp",
               CASE city WHEN 'Mumbai' THEN 'BR_001' WHEN 'Delhi' THEN 'BR_002'
                    WHEN 'Pune' THEN 'BR_007' WHEN 'Chennai' THEN 'BR_004'
                    ELSE 'BR_' || lpad(CAST({between('event_id', 3, 10, 51)} AS VARCHAR), 3, '0')
                    END AS branch_id,
               'INR' AS currency, data_source
        FROM (SELECT *, 1 + {between('event_id', 3, 0, 4)} AS choice FROM cleaned)""",
    "all_alerts": """
        SELECT 'HIGH_COST_RATIO' AS alert, CAST(branch_id AS VARCHAR) AS subject_id,
               branch_name AS subject_name, cost_income_ratio AS measure
        FROM branch_details WHERE cost_income_ratio > 0.7
        UNION ALL
        SELECT 'LOW_PRODUCTIVITY', CAST(branch_id AS VARCHAR), branch_name, transaction_per_staff
        FROM branch_details WHERE transaction_per_staff < 50
        UNION ALL
        SELECT 'NEGATIVE_PROFIT', CAST(customer_id AS VARCHAR), customer_segment, net_profit
        FROM costly_mart WHERE net_profit < 0
        UNION ALL
        SELECT 'HIGH_UTILIZATION', CAST(branch_id AS VARCHAR), branch_name, utilization_rate
        FROM loan_view LEFT JOIN branches USING (branch_id) WHERE utilization_rate > 0.75""",
    "volume": f"""
        SELECT date_trunc('minute', "timestamp") - to_minutes(k) AS started, branch_id,
               {money('amount')} AS window_total_volume, count(transaction_id) AS window_txn_count
        FROM transactions, unnest([0, 1, 2, 3, 4]) AS o(k)
        GROUP BY ALL""",
    "executive": f"""
        SELECT {money('total_revenue')} AS total_revenue, {money('total_costs')} AS total_costs,
               count(*) AS active_branches,
               {money('total_revenue')} - {money('total_costs')} AS net_income,
               {money('total_costs')} / {money('total_revenue')} AS cost_income_ratio,
               (SELECT count(*) FROM customers) AS active_customers,
               (SELECT CAST(sum(active_loans) AS BIGINT) FROM loan_mart) AS active_loans
        FROM branch_mart""",
}

BODIES: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    BODIES[name] = sql


# --- Gold and warehouse views -----------------------------------------------

add("branch_performance", f"SELECT *, '{AS_OF}' AS kpi_date FROM branch_view")
add(
    "branch_performance_all_branches",
    f"""SELECT branch_id, coalesce(total_revenue, 0) AS total_revenue,
               coalesce(total_costs, 0) AS total_costs,
               coalesce(total_revenue, 0) - coalesce(total_costs, 0) AS net_income,
               CASE WHEN total_revenue > 0 THEN coalesce(total_costs, 0) / total_revenue
                    ELSE 0.0 END AS cost_income_ratio,
               transaction_count,
               CASE WHEN transaction_count > 0 THEN transaction_count / staff_count ELSE 0.0 END
               AS transaction_per_staff, '{AS_OF}' AS kpi_date
        FROM branches
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_revenue FROM revenue GROUP BY ALL)
             USING (branch_id)
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_costs FROM costs GROUP BY ALL)
             USING (branch_id)
        LEFT JOIN (SELECT branch_id, count(*) AS transaction_count FROM transactions GROUP BY ALL)
             USING (branch_id)""",
)
add(
    "branch_throughput",
    f"""SELECT branch_id, total_revenue, total_costs, net_income, cost_income_ratio,
               transaction_count,
               ((transaction_count * 20000 + 86400) // 172800) / 10000
               AS avg_transactions_per_second,
               transaction_per_staff, '{AS_OF}' AS kpi_date
        FROM branch_mart""",
)
add(
    "branch_ratio_from_entities",
    f"""SELECT branch_id, branch_name, city, region, staff_count,
               coalesce(total_revenue, 0) AS total_revenue, coalesce(total_costs, 0) AS total_costs,
               coalesce(total_revenue, 0) - coalesce(total_costs, 0) AS net_income,
               CASE WHEN total_revenue > 0 THEN coalesce(total_costs, 0) / total_revenue
                    ELSE 0.0 END AS cost_income_ratio
        FROM branches
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_revenue FROM revenue GROUP BY ALL)
             USING (branch_id)
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_costs FROM costs GROUP BY ALL)
             USING (branch_id)""",
)
add(
    "customer_profitability",
    f"SELECT *, '{AS_OF}' AS kpi_date, {TIER} AS value_tier FROM customer_mart",
)
add(
    "customer_profitability_view",
    f"""SELECT customer_id, customer_segment, total_revenue, net_profit, profit_margin,
               {TIER} AS value_tier FROM customer_mart""",
)
add(
    "customer_profitability_missing_as_zero",
    f"""SELECT customer_id, customer_segment, total_revenue, c AS estimated_costs,
               total_revenue - c AS net_profit,
               {ratio('(total_revenue - c)', 'total_revenue')} AS profit_margin,
               '{AS_OF}' AS kpi_date
        FROM (SELECT *, coalesce(transaction_count, 0) * CAST(5 AS DOUBLE) AS c
              FROM customer_sums)""",
)
add(
    "customer_activity",
    f"""SELECT customer_id,
               {money("CASE WHEN transaction_type IN ('DEPOSIT', 'TRANSFER') THEN amount ELSE 0 END")}
               AS total_credits,
               {money("CASE WHEN transaction_type NOT IN ('DEPOSIT', 'TRANSFER') THEN amount ELSE 0 END")}
               AS total_debits,
               count(transaction_id) AS transaction_count
        FROM transactions GROUP BY customer_id""",
)
add("loan_portfolio", "SELECT * FROM loan_view")
add(
    "loan_portfolio_dashboard_bands",
    f"""SELECT * REPLACE (
               {above('avg_interest_rate', bands.RATE_CATEGORIES_DASHBOARD, 'Low Rate')}
               AS rate_category) FROM loan_view""",
)
add(
    "summary_kpis",
    f"""SELECT '{AS_OF}' AS kpi_date, count(DISTINCT customer_id) AS total_customers,
               {money('total_revenue')} AS total_revenue, {money('net_profit')} AS total_profit,
               {mean_ratio('profit_margin')} AS avg_profit_margin,
               (SELECT {money('total_loan_portfolio')} FROM loan_mart) AS total_loan_portfolio
        FROM customer_mart""",
)

# --- Silver and the gate ----------------------------------------------------

add(
    "silver_customers",
    f"""SELECT * REPLACE ({day('customer_since')} AS customer_since),
               '{RUN}' AS updated_timestamp
        FROM silver_people WHERE account_balance >= 0""",
)
add(
    "silver_transactions",
    f"""SELECT transaction_id, customer_id, amount, transaction_type,
               {second('"timestamp"')} AS "timestamp", branch_id,
               {day('"timestamp"')} AS transaction_date,
               transaction_type IN ('WITHDRAWAL', 'PAYMENT', 'PURCHASE') AS is_debit,
               transaction_type IN ('DEPOSIT', 'TRANSFER') AS is_credit,
               {below('amount', bands.AMOUNT_CATEGORIES, 'Large')} AS amount_category,
               '{RUN}' AS updated_timestamp
        FROM transactions WHERE amount > 0""",
)
add(
    "silver_revenue",
    f"""SELECT * REPLACE ({day('event_date')} AS event_date), '{RUN}' AS updated_timestamp,
               {month('event_date')} AS month FROM revenue""",
)
add(
    "silver_costs",
    f"""SELECT * REPLACE ({day('cost_date')} AS cost_date), '{RUN}' AS updated_timestamp,
               {month('cost_date')} AS month FROM costs""",
)
add(
    "silver_loans",
    f"""SELECT * REPLACE ({day('start_date')} AS start_date), '{RUN}' AS updated_timestamp
        FROM loans WHERE interest_rate BETWEEN 0 AND 30""",
)
add(
    "quarantine_customers",
    f"""SELECT * REPLACE ({day('customer_since')} AS customer_since),
               '{RUN}' AS updated_timestamp, 'account_balance is negative' AS violations,
               '{RUN}' AS quarantine_timestamp, 'customers' AS quarantine_entity
        FROM silver_people WHERE account_balance < 0""",
)
add(
    "quarantine_raw_transactions",
    f"""SELECT transaction_id, {day('transaction_date')} AS transaction_date, transaction_amount,
               concat_ws('; ', CASE WHEN transaction_date IS NULL
                                    THEN 'transaction_date is missing' END,
                         CASE WHEN transaction_amount <= 0 THEN 'amount is not positive' END)
               AS violations,
               '{RUN}' AS quarantine_timestamp, 'transactions' AS quarantine_entity
        FROM cleaned WHERE transaction_date IS NULL OR transaction_amount <= 0""",
)
add(
    "quarantine_unknown_branch",
    """SELECT transaction_id, branch_id, 'branch is unknown' AS violations
       FROM transactions WHERE branch_id NOT IN (SELECT branch_id FROM branches)""",
)
add(
    "gate_counts",
    """SELECT 'customers' AS entity, count(*) FILTER (account_balance >= 0) AS valid_rows,
              count(*) FILTER (account_balance < 0) AS rejected_rows FROM customers
       UNION ALL SELECT 'transactions', count(*) FILTER (amount > 0),
              count(*) FILTER (amount <= 0) FROM transactions
       UNION ALL SELECT 'loans', count(*) FILTER (interest_rate BETWEEN 0 AND 30),
              count(*) FILTER (interest_rate NOT BETWEEN 0 AND 30) FROM loans
       UNION ALL SELECT 'loans up to 15 percent', count(*) FILTER (interest_rate <= 0.15),
              count(*) FILTER (interest_rate > 0.15) FROM loans""",
)

# --- integrity and profiles -------------------------------------------------

add(
    "integrity_report",
    " UNION ALL ".join(
        [
            f"""SELECT 'duplicate_rows' AS "check", '{t}' AS subject,
                       (SELECT count(*) FROM {t})
                       - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS failures"""
            for t in PRIMARY_KEYS
        ]
        + [
            f"SELECT 'repeated_keys', '{t}', count(*) - count(DISTINCT {k}) FROM {t}"
            for t, k in PRIMARY_KEYS.items()
        ]
        + [
            f"""SELECT 'orphans', '{c}.{k}', count(*) FROM {c}
                WHERE NOT EXISTS (SELECT 1 FROM {p} WHERE {p}.{k} = {c}.{k})"""
            for c, k, p in FOREIGN_KEYS
        ]
    ),
)
add(
    "duplicate_rows",
    """SELECT 'revenue_id' AS subject, count(*) - count(DISTINCT revenue_id) AS failures
       FROM revenue
       UNION ALL SELECT 'revenue_branch_type_amount', (SELECT count(*) FROM revenue) - count(*)
       FROM (SELECT DISTINCT branch_id, revenue_type, amount FROM revenue)
       UNION ALL SELECT 'transactions_customer_type', (SELECT count(*) FROM transactions) - count(*)
       FROM (SELECT DISTINCT customer_id, transaction_type FROM transactions)""",
)
add(
    "pk_duplicates",
    """SELECT revenue_id, count(*) AS row_count FROM revenue
       GROUP BY revenue_id HAVING count(*) > 1""",
)
add(
    "pk_summary",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS subject, count(*) AS row_count, count(DISTINCT {k}) AS distinct_keys,
                   count(*) - count(DISTINCT {k}) AS failures FROM {t}"""
        for t, k in PRIMARY_KEYS.items()
    ),
)
add(
    "fk_orphans",
    " UNION ALL ".join(
        f"""SELECT '{c}.{k}' AS subject, {k} AS key_value, count(*) AS row_count FROM {c}
            WHERE {k} NOT IN (SELECT {k} FROM {p}) GROUP BY {k}"""
        for c, k, p in FOREIGN_KEYS
    ),
)
add(
    "orphan_transactions",
    """SELECT transaction_id, branch_id, amount FROM transactions
       WHERE branch_id NOT IN (SELECT branch_id FROM branches)""",
)
add(
    "source_overlap",
    """SELECT count(*) FILTER (customer_id IN (SELECT user_id FROM raw)) AS matching,
              count(*) AS total FROM customers""",
)
add(
    "layer_assertions",
    """SELECT 'customers not empty' AS "check", CAST(count(*) = 0 AS BIGINT) AS failures
       FROM customers
       UNION ALL SELECT 'customer_id unique', count(*) - count(DISTINCT customer_id) FROM customers
       UNION ALL SELECT 'account_balance not negative', count(*) FROM customers
       WHERE account_balance < 0
       UNION ALL SELECT 'transactions not empty', CAST(count(*) = 0 AS BIGINT) FROM transactions
       UNION ALL SELECT 'amount positive', count(*) FROM transactions WHERE amount <= 0""",
)
add(
    "layer_counts",
    """SELECT 'raw' AS layer, count(*) AS row_count FROM raw
       UNION ALL SELECT 'bronze.customers', count(*) FROM customers
       UNION ALL SELECT 'silver.customers', count(*) FROM customers WHERE account_balance >= 0
       UNION ALL SELECT 'silver.transactions', count(*) FROM transactions WHERE amount > 0
       UNION ALL SELECT 'gold.branch_performance', count(*) FROM branch_mart
       UNION ALL SELECT 'gold.loan_portfolio', count(*) FROM loan_mart""",
)
_RAW_COLUMNS = {
    "TransactionID": "TransactionID",
    "CustomerID": "CustomerID",
    "CustomerDOB": "CustomerDOB",
    "CustGender": "CustGender",
    "CustLocation": "CustLocation",
    "CustAccountBalance": "CustAccountBalance",
    "TransactionDate": "TransactionDate",
    "TransactionTime": "TransactionTime",
    "TransactionAmount": "RawAmount",
}


def _presence(label: str, present: str, table: str) -> str:
    return f"""SELECT '{label}' AS column_name, count(*) AS total_rows,
                      {present} AS present_rows, count(*) - {present} AS missing_rows,
                      {present} * 100.0e0 / count(*) AS present_pct,
                      (count(*) - {present}) * 100.0e0 / count(*) AS missing_pct FROM {table}"""


add(
    "profile_columns",
    " UNION ALL ".join(
        _presence(label, f"count(nullif(\"{c}\", ''))", "raw") for label, c in _RAW_COLUMNS.items()
    ),
)
_CLEANED_COLUMNS = [
    "customer_id", "original_customer_id", "gender", "city", "account_balance",
    "transaction_amount", "transaction_date", "transaction_id", "transaction_time",
    "date_of_birth", "age", "data_source", "gender_imputed", "age_imputed",
]
add(
    "quality_gaps",
    "SELECT * FROM ("
    + " UNION ALL ".join(_presence(c, f"count({c})", "cleaned") for c in _CLEANED_COLUMNS)
    + ") WHERE missing_rows > 0",
)


def _statistics(amount: str, key: str, table: str) -> str:
    return f"""SELECT count(*) AS total_rows, count(DISTINCT {key}) AS distinct_keys,
                      count(*) / count(DISTINCT {key}) AS rows_per_key,
                      {money(amount)} AS total_amount, {mean_money(amount)} AS mean_amount,
                      min({amount}) AS min_amount, max({amount}) AS max_amount,
                      median({amount}) AS median_amount
               FROM {table}"""


add("raw_profile", _statistics('TRY_CAST("RawAmount" AS DOUBLE)', '"CustomerID"', "raw"))
add("quality_report", _statistics("account_balance", "customer_id", "cleaned"))

# --- monthly marts ----------------------------------------------------------

add("monthly_revenue", "SELECT * FROM revenue_months")
add("monthly_costs", "SELECT * FROM costs_months")
add(
    "monthly_loans",
    f"""SELECT branch_id, loan_type, count(loan_id) AS new_loans_count,
               {money('loan_amount')} AS new_loans_amount,
               {money('outstanding_balance')} AS outstanding_amount,
               {mean_rate('interest_rate')} AS avg_interest_rate, {month('start_date')} AS month
        FROM loans GROUP BY branch_id, loan_type, {month('start_date')}""",
)
add(
    "monthly_trend",
    f"""SELECT month, amount_rev, amount_cost, amount_rev - amount_cost AS net_income
        FROM (SELECT {month('event_date')} AS month, {money('amount')} AS amount_rev
              FROM revenue GROUP BY 1)
        JOIN (SELECT {month('cost_date')} AS month, {money('amount')} AS amount_cost
              FROM costs GROUP BY 1) USING (month)""",
)
add(
    "disbursement_trend",
    f"""SELECT {month('start_date')} AS month, {money('loan_amount')} AS volume,
               count(loan_id) AS loan_count FROM loans GROUP BY 1""",
)
add("cir_matrix_long", "SELECT * FROM ratio_months")
add(
    "cir_matrix_pivot",
    """SELECT branch_id, month, max(cir) AS cir
       FROM (SELECT * FROM (SELECT DISTINCT branch_id FROM ratio_months),
                           (SELECT DISTINCT month FROM ratio_months)) AS every
            LEFT JOIN ratio_months USING (branch_id, month)
       GROUP BY branch_id, month""",
)

# --- headlines and products -------------------------------------------------

add("executive_summary", "SELECT * FROM executive")
add(
    "executive_cards",
    """SELECT printf('₹%.2f Cr', total_revenue / 10000000) AS total_revenue,
              printf('₹%.2f Cr', total_costs / 10000000) AS total_costs,
              printf('₹%.2f Cr', net_income / 10000000) AS net_income,
              printf('%.1f%%', cost_income_ratio * 100) AS cost_income_ratio,
              format('{:,}', active_customers) AS active_customers,
              format('{:,}', active_loans) AS active_loans
       FROM executive""",
)
add(
    "branch_headline",
    f"""SELECT count(*) AS total_branches, {money('total_revenue')} AS total_revenue,
               {money('total_costs')} AS total_costs,
               {mean_ratio('cost_income_ratio')} AS average_cir,
               {mean_ratio('transaction_per_staff')} AS average_txn_per_staff
        FROM branch_mart""",
)
add(
    "customer_headline",
    f"""SELECT count(*) AS total_customers,
               count(*) FILTER (value_tier = 'High Value') AS high_value_customers,
               {mean_money('total_revenue')} AS avg_revenue,
               {mean_ratio('profit_margin')} AS avg_margin
        FROM people_details""",
)
add(
    "loan_headline",
    f"""SELECT {money('total_loan_portfolio')} AS total_loan_book,
               {money('total_outstanding')} AS total_outstanding,
               {mean_ratio('avg_interest_rate')} AS avg_interest_rate,
               {money('total_outstanding')} / {money('total_loan_portfolio')} AS overall_utilization
        FROM loan_mart""",
)
add(
    "product_contribution",
    f"""SELECT revenue_type, {money('amount')} AS amount,
               {choice('revenue_type', PRODUCT_OF_REVENUE)} AS product
        FROM revenue GROUP BY revenue_type""",
)
_SHARES = (
    "(VALUES "
    + ", ".join(f"('{product}', {r}e0, {c}e0)" for product, r, c in PRODUCT_SHARES)
    + ") AS s(product, r, c)"
)
add(
    "product_profit",
    f"""SELECT product, total_revenue * r AS revenue, total_costs * c AS costs,
               total_revenue * r - total_costs * c AS net_profit
        FROM (SELECT {money('total_revenue')} AS total_revenue, {money('total_costs')} AS total_costs
              FROM branch_mart), {_SHARES}""",
)
add(
    "region_product_revenue",
    f"""SELECT region, product, total_revenue * r AS revenue
        FROM (SELECT region, {money('total_revenue')} AS total_revenue FROM branch_details
              WHERE region IS NOT NULL GROUP BY region), {_SHARES}""",
)

# --- rankings and drill-down ------------------------------------------------


def _top_branches(name: str, n: int) -> str:
    return f"""SELECT branch_id, branch_name,
                      CASE WHEN row_number() OVER (PARTITION BY branch_name
                                                   ORDER BY net_income DESC, branch_id) > 1
                           THEN branch_name || ' (' || branch_id || ')' ELSE branch_name END
                      AS display_label,
                      city, total_revenue, net_income, cost_income_ratio, efficiency_rating
               FROM (SELECT * REPLACE ({name} AS branch_name) FROM branch_details
                     ORDER BY net_income DESC, branch_id LIMIT {n})"""


add("top_branches", _top_branches("branch_name", 10))
add("top_branches_by_city_label", _top_branches("region", 5))
add(
    "top_bottom_branches",
    """WITH ends AS (
         (SELECT branch_id, branch_name, net_income FROM branch_details
          ORDER BY net_income DESC, branch_id LIMIT 5)
         UNION ALL
         (SELECT branch_id, branch_name, net_income FROM branch_details
          ORDER BY net_income, branch_id LIMIT 5))
       SELECT *, CASE WHEN net_income > (SELECT median(net_income) FROM ends)
                      THEN 'Top 5' ELSE 'Bottom 5' END AS group_label FROM ends""",
)
add(
    "top_customers",
    """SELECT customer_id, customer_segment, account_balance, total_revenue, net_profit,
              profit_margin, value_tier, '₹' || format('{:,.2f}', net_profit) AS net_profit_text,
              printf('%.1f%%', profit_margin * 100) AS profit_margin_text FROM people_details
       ORDER BY net_profit DESC NULLS LAST, customer_id LIMIT 100""",
)
add(
    "negative_profit_head",
    """SELECT customer_id, customer_segment, total_revenue, estimated_costs, net_profit,
              profit_margin FROM costly_mart WHERE net_profit < 0
       ORDER BY customer_id LIMIT 100""",
)
add(
    "top_outstanding",
    "SELECT * FROM loan_view ORDER BY total_outstanding DESC NULLS LAST, branch_id LIMIT 15",
)
add("branch_list", "SELECT DISTINCT branch_id FROM branch_mart")
add(
    "branch_drilldown",
    f"""SELECT d.*, '{AS_OF}' AS kpi_date, l.total_loan_portfolio, l.total_outstanding,
               l.utilization_rate
        FROM branch_details d LEFT JOIN loan_view l USING (branch_id)
        WHERE d.branch_id = {DRILL_BRANCH}""",
)
add(
    "branch_drilldown_trend",
    f"""SELECT month, amount_rev, amount_cost
        FROM (SELECT {month('event_date')} AS month, {money('amount')} AS amount_rev FROM revenue
              WHERE branch_id = {DRILL_BRANCH} GROUP BY 1)
        JOIN (SELECT {month('cost_date')} AS month, {money('amount')} AS amount_cost FROM costs
              WHERE branch_id = {DRILL_BRANCH} GROUP BY 1) USING (month)""",
)

# --- customers --------------------------------------------------------------

add(
    "customer_details",
    f"""SELECT * REPLACE ({day('customer_since')} AS customer_since), '{AS_OF}' AS kpi_date
        FROM people_details""",
)
add(
    "category_mix",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS dimension, {c} AS category, count(*) AS row_count
            FROM people_details WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in (
            "customer_segment", "value_tier", "age_group", "income_segment", "balance_segment",
        )
    ),
)
add(
    "cohort_profit",
    f"""SELECT {month('customer_since')} AS cohort_month, count(customer_id) AS customer_count,
               {mean_money('net_profit')} AS avg_profit,
               {mean_ratio('profit_margin')} AS avg_margin
        FROM people_details GROUP BY 1 ORDER BY 1 DESC LIMIT 15""",
)
add(
    "high_value_by_city",
    """SELECT city, count(customer_id) AS hv_customers FROM people_details
       WHERE value_tier = 'High Value' GROUP BY city ORDER BY 2 DESC, 1 LIMIT 12""",
)
add(
    "customer_plot_sample",
    f"""SELECT customer_id, total_revenue, profit_margin, account_balance, customer_segment
        FROM people_details ORDER BY {draw('customer_id', 5)}, customer_id LIMIT 5000""",
)

# --- loans, risk and alerts -------------------------------------------------

add(
    "rate_histogram",
    """WITH active AS (SELECT interest_rate FROM loans WHERE status = 'ACTIVE'),
            ends AS (SELECT min(interest_rate) AS lo, max(interest_rate) AS hi FROM active)
       SELECT b.bin, count(interest_rate) AS loan_count, min(interest_rate) AS lowest_rate,
              max(interest_rate) AS highest_rate
       FROM (SELECT bin FROM range(1, 13) AS r(bin), ends WHERE bin = 1 OR coalesce(lo <> hi, TRUE)) AS b LEFT JOIN
            (SELECT interest_rate,
                    CASE WHEN hi > lo
                         THEN CAST(least(floor((interest_rate - lo) * 12 / (hi - lo)) + 1, 12) AS BIGINT)
                         ELSE 1 END AS bin
             FROM active, ends) USING (bin) GROUP BY 1""",
)
add(
    "loan_risk_distribution",
    f"""SELECT risk_category, count(*) AS loan_count,
               CAST(CASE risk_category WHEN 'Critical Risk' THEN 1 WHEN 'High Risk' THEN 2
                    WHEN 'Moderate Risk' THEN 3 WHEN 'Low Risk' THEN 4 ELSE 5 END AS BIGINT)
               AS severity
        FROM (SELECT {RATE_RISK} AS risk_category FROM loans) GROUP BY risk_category""",
)
add("alerts", "SELECT * FROM all_alerts")
add("alert_counts", "SELECT alert, count(*) AS alert_count FROM all_alerts GROUP BY alert")
add("loan_default_features", "SELECT * FROM labelled")
add(
    "loan_default_features_fraction_rates",
    """SELECT * REPLACE (CASE WHEN loan_to_income_ratio > 0.8 AND interest_rate > 0.12 THEN 1
              WHEN outstanding_balance > 1000000 THEN 1 ELSE 0 END AS is_default)
       FROM labelled""",
)

# --- raw ingestion ----------------------------------------------------------

add(
    "clean_raw",
    f"""SELECT * EXCLUDE (event_id, user_id)
               REPLACE ({day('transaction_date')} AS transaction_date,
                        {day('date_of_birth')} AS date_of_birth)
        FROM cleaned""",
)
add("transaction_ledger", "SELECT * FROM ledger")
add(
    "ledger_union",
    f"""SELECT source AS data_source, transaction_type, count(*) AS row_count,
               {money('amount')} AS total_amount
        FROM ledger, unnest(['kaggle_original', 'late_feed']) AS o(source) GROUP BY ALL""",
)
add(
    "customer_dimension",
    f"""SELECT customer_id, original_customer_id, age, gender, city, 'India' AS country,
               account_balance, segment AS customer_segment,
               CAST(round_even(CASE segment WHEN 'PREMIUM' THEN greatest(account_balance * 1.5e0, 800000)
                    WHEN 'STANDARD' THEN greatest(account_balance * 2, 400000)
                    ELSE greatest(account_balance * 3, 200000) END, 0) AS BIGINT) AS annual_income,
               CAST(NULL AS VARCHAR) AS first_name, CAST(NULL AS VARCHAR) AS last_name,
               CAST(NULL AS INTEGER) AS credit_score,
               {day(f"CAST(transaction_date - {between('user_id', 7, 1, 2920)} AS DATE)")}
               AS customer_since,
               'kaggle_enhanced' AS data_source
        FROM (SELECT *, {SEGMENT} AS segment FROM cleaned
              QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_id) = 1)""",
)
add(
    "raw_sample",
    f"""WITH spot AS (SELECT (CAST(9 AS BIGINT) * 1103515245 + 12345)
                             % (greatest(0, count(*) - 2000) + 1) AS start FROM raw)
        SELECT "TransactionID", "CustomerID", event_id AS ordinal FROM raw, spot
        WHERE event_id >= start AND event_id < start + 2000""",
)
add(
    "sample_keys",
    f"""SELECT DISTINCT customer_id FROM revenue
        WHERE {draw('customer_id', 1)} < CAST(floor(0.2 * {RANGE}) AS BIGINT)""",
)
add(
    "sample_keys_exact",
    f"""WITH keys AS (SELECT DISTINCT customer_id FROM loans),
             ranked AS (SELECT customer_id, row_number() OVER
                               (ORDER BY {draw('customer_id', 2)}, customer_id) AS place FROM keys)
        SELECT customer_id FROM ranked WHERE place <= floor((SELECT count(*) FROM keys) * 0.4e0)""",
)
add(
    "repeat_rows",
    f"""SELECT customer_id, CAST(copy AS BIGINT) AS copy
        FROM (SELECT customer_id, unnest(range(1, {between('customer_id', 4, 2, 7)} + 1)) AS copy
              FROM customers)""",
)
add(
    "weighted_types",
    f"""SELECT transaction_id, CASE WHEN u < 0.1e0 THEN 'DEPOSIT' WHEN u < 0.3e0 THEN 'WITHDRAWAL'
               WHEN u < 0.4e0 THEN 'TRANSFER' WHEN u < 0.7e0 THEN 'PAYMENT' ELSE 'PURCHASE' END
               AS drawn_type
        FROM (SELECT transaction_id, {draw('transaction_id', 6)} / {RANGE} AS u FROM transactions)""",
)
add(
    "sequential_ids",
    f"""SELECT transaction_id, 'TX_SYNTH_' || lpad(CAST(row_number() OVER
               (ORDER BY {draw('transaction_id', 8)} % 64, transaction_id) AS VARCHAR), 8, '0')
               AS surrogate_id
        FROM transactions""",
)

add(
    "ids_per_branch",
    f"""SELECT loan_id, printf('LOAN_%03d_%03d', branch_id, row_number() OVER
               (PARTITION BY branch_id ORDER BY {draw('loan_id', 9)} % 8, loan_id) - 1)
               AS surrogate_id
        FROM loans""",
)

add(
    "hash_positions",
    """SELECT CAST('0x' || substr(md5('3:' || customer_id), 1, 8) AS BIGINT) % 16 AS position,
              count(*) AS customers FROM customers GROUP BY 1""",
)

# --- events -----------------------------------------------------------------

_VOLUME = f"""SELECT {second('started')} AS window_start,
                     {second('started + INTERVAL 5 MINUTE')} AS window_end, branch_id,
                     window_total_volume, window_txn_count FROM volume"""
add("branch_volume_batch", _VOLUME)
add("branch_volume_stream", _VOLUME)
add(
    "branch_surges",
    f"""WITH counted AS (SELECT date_trunc('minute', "timestamp") - to_minutes(k) AS started,
                                customer_id % 10 AS branch_id, count(*) AS window_txn_count
                         FROM transactions, unnest([0, 1, 2, 3, 4]) AS o(k) GROUP BY ALL),
             tested AS (SELECT c.*, min(started) OVER (PARTITION BY branch_id) AS first_seen,
                               (SELECT coalesce(sum(e.window_txn_count), 0) FROM counted e
                                WHERE e.branch_id = c.branch_id AND c.started - e.started IN
                                      (INTERVAL 5 MINUTE, INTERVAL 10 MINUTE, INTERVAL 15 MINUTE,
                                       INTERVAL 20 MINUTE, INTERVAL 25 MINUTE)) AS total
                        FROM counted c)
        SELECT {second('started')} AS window_start, branch_id, window_txn_count,
               CAST(total AS BIGINT) AS trailing_total, CAST(5 AS BIGINT) AS trailing_windows
        FROM tested WHERE started >= first_seen + INTERVAL 25 MINUTE
          AND window_txn_count * 5 > total * 1.5e0""",
)
_ROUTE = """CASE WHEN event_id % 37 = 0 OR event_id % 31 = 0 THEN 'QUARANTINE'
                 WHEN event_id % 10 < 6 THEN 'CARD_TRANSACTION'
                 WHEN event_id % 10 = 6 THEN 'CUSTOMER_ONBOARDED'
                 WHEN event_id % 10 = 7 THEN 'EMI_PAYMENT_EVENT'
                 WHEN event_id % 10 = 8 THEN 'NEW_BRANCH_OPENED' ELSE 'QUARANTINE' END"""
add("event_routing", f"SELECT {_ROUTE} AS route, count(*) AS event_count FROM events GROUP BY 1")
add(
    "card_events",
    f"""SELECT 'TXN-' || event_id AS transaction_id, 'CUST-' || user_id AS customer_id,
               'BR_' || (event_id % 70) AS branch_id, floor(value * 2000 + 0.5) / 100 AS amount,
               CAST(NULL AS VARCHAR) AS transaction_type, {second('ts')} AS event_time,
               CAST(NULL AS DOUBLE) AS interchange_fee_earned
        FROM events WHERE {_ROUTE} = 'CARD_TRANSACTION'""",
)

# --- documented extras ------------------------------------------------------

add(
    "premium_without_active_loan",
    """SELECT customer_id, city, account_balance FROM customers
       WHERE customer_segment = 'PREMIUM'
         AND customer_id NOT IN (SELECT customer_id FROM loans
                               WHERE status = 'ACTIVE' AND loan_type = 'HOME_LOAN')""",
)
add(
    "home_currency",
    f"""SELECT ['INR', 'USD', 'EUR', 'GBP'][1 + transaction_id % 4] AS currency,
               {day('"timestamp"')} AS transaction_date, transaction_id, amount,
               CASE transaction_id % 4 WHEN 0 THEN amount
                    WHEN 1 THEN round(amount * (80 + day("timestamp")) * 100) / 100
                    WHEN 2 THEN round(amount * (90 + day("timestamp")) * 100) / 100 END
               AS amount_home
        FROM transactions""",
)
add(
    "transaction_classes",
    f"""SELECT CASE transaction_type WHEN 'DEPOSIT' THEN 'Income' WHEN 'WITHDRAWAL'
                    THEN 'Withdrawal' WHEN 'TRANSFER' THEN 'Transfer' ELSE 'Expense' END
               AS transaction_class, count(*) AS row_count, {money('amount')} AS total_amount
        FROM transactions GROUP BY 1""",
)
add(
    "branch_activity",
    f"""SELECT *, {ratio('total_revenue', 'customers')} AS revenue_per_customer
        FROM (SELECT branch_id,
                     {money("CASE WHEN transaction_type = 'DEPOSIT' THEN amount ELSE 0 END")}
                     AS total_deposits,
                     {money("CASE WHEN transaction_type = 'WITHDRAWAL' THEN amount ELSE 0 END")}
                     AS total_withdrawals,
                     {mean_money('amount')} AS avg_transaction,
                     count(DISTINCT customer_id) AS customers
              FROM transactions GROUP BY branch_id)
        LEFT JOIN (SELECT branch_id, {money('amount')} AS total_revenue FROM revenue GROUP BY 1)
             USING (branch_id)""",
)
add(
    "branch_size",
    """SELECT branch_id, staff_count, CASE WHEN staff_count < 15 THEN 'Small'
              WHEN staff_count < 35 THEN 'Medium' ELSE 'Large' END AS size_class FROM branches""",
)
add(
    "loan_risk_classes",
    """SELECT loan_id, branch_id,
              CASE WHEN loan_amount > 0 THEN outstanding_balance / loan_amount END AS loan_to_value,
              CASE WHEN outstanding_balance > 1000000 THEN 'High'
                   WHEN outstanding_balance > 500000 THEN 'Medium' ELSE 'Low' END AS risk_class
       FROM loans""",
)
add(
    "loan_risk_shares",
    """SELECT CASE WHEN outstanding_balance > 1000000 THEN 'High'
                   WHEN outstanding_balance > 500000 THEN 'Medium' ELSE 'Low' END AS risk_class,
              count(*) AS loan_count, count(*) / (SELECT count(*) FROM loans) AS share
       FROM loans GROUP BY 1""",
)
add(
    "midnight_transfers",
    f"""SELECT transaction_id, customer_id, branch_id, amount,
               {second('"timestamp"')} AS "timestamp"
        FROM transactions WHERE transaction_type = 'TRANSFER' AND amount > 2000
          AND hour("timestamp") < 5""",
)
add(
    "rapid_city_use",
    f"""WITH uses AS (SELECT transaction_id, customer_id, "timestamp" AS t,
                             coalesce(city, 'branch ' || branch_id) AS city
                      FROM transactions LEFT JOIN branches USING (branch_id)),
             pairs AS (SELECT b.*, a.city AS previous_city, a.t AS previous,
                              row_number() OVER (PARTITION BY b.transaction_id
                                                 ORDER BY a.t DESC, a.transaction_id DESC) AS n
                       FROM uses a JOIN uses b ON a.customer_id = b.customer_id
                        AND (a.t < b.t OR (a.t = b.t AND a.transaction_id < b.transaction_id))
                        AND b.t - a.t <= INTERVAL 60 MINUTE)
        SELECT transaction_id, customer_id, city, {second('t')} AS "timestamp", previous_city,
               {second('previous')} AS previous_timestamp
        FROM pairs WHERE n = 1 AND city <> previous_city""",
)
add(
    "provisions",
    f"""SELECT branch_id, exposed_balance, exposed_balance * 0.15e0 AS provision
        FROM (SELECT branch_id, coalesce({money("CASE WHEN interest_rate > 0.12 THEN outstanding_balance END")}, 0)
              AS exposed_balance FROM loans GROUP BY branch_id)""",
)
add(
    "revenue_by_segment",
    f"""SELECT customer_segment, {money('amount')} AS total_revenue
        FROM revenue JOIN customers USING (customer_id) GROUP BY 1""",
)
add(
    "default_rate_by_region",
    """SELECT region, count(*) AS loans, CAST(sum(is_default) AS BIGINT) AS defaults,
              sum(is_default) / count(*) AS default_rate
       FROM labelled JOIN branches USING (branch_id) GROUP BY region""",
)
add(
    "threshold_metrics",
    """SELECT threshold, tp AS true_positives, fp AS false_positives, fn AS false_negatives,
              CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall,
              CASE WHEN 5 * tp + 4 * fn + fp > 0 THEN 5 * tp / (5 * tp + 4 * fn + fp) END AS f_beta
       FROM (SELECT threshold,
                    count(*) FILTER (p >= threshold AND is_default = 1) AS tp,
                    count(*) FILTER (p >= threshold AND is_default = 0) AS fp,
                    count(*) FILTER (p < threshold AND is_default = 1) AS fn
             FROM (SELECT least(outstanding_balance / 2000000, 1) AS p, is_default FROM labelled),
                  (VALUES (0.25e0), (0.55e0), (0.80e0)) AS t(threshold) GROUP BY threshold)""",
)
add(
    "rate_drift",
    """WITH placed AS (SELECT status, CAST((loan_amount >= 250000)::INT + (loan_amount >= 500000)::INT
                 + (loan_amount >= 1000000)::INT + (loan_amount >= 1500000)::INT AS BIGINT) AS bin
          FROM loans),
       shares AS (SELECT status, bin, count(*) / sum(count(*)) OVER (PARTITION BY status) AS share
          FROM placed GROUP BY status, bin)
       SELECT *, round_even((actual_share - expected_share) * ln(actual_share / expected_share)
                            * 1e12, 0) / 1e12 AS stability_index
       FROM (SELECT bin, greatest(coalesce(max(share) FILTER (status = 'CLOSED'), 0), 0.0001e0)
              AS expected_share,
              greatest(coalesce(max(share) FILTER (status = 'ACTIVE'), 0), 0.0001e0)
              AS actual_share
       FROM shares GROUP BY bin)""",
)
add(
    "percentile_bands",
    """WITH cuts AS (SELECT quantile_disc(cost_income_ratio, 0.25) AS lo,
                            quantile_disc(cost_income_ratio, 0.75) AS hi FROM branch_mart)
       SELECT branch_id, cost_income_ratio, CASE WHEN cost_income_ratio < lo THEN 'Low Cost'
              WHEN cost_income_ratio < hi THEN 'Typical' ELSE 'High Cost' END AS cost_band
       FROM branch_mart, cuts""",
)
add(
    "home_currency_last_known",
    f"""WITH rate_days AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS rate_date FROM transactions
                           WHERE day("timestamp") % 3 = 2),
       day_rates AS (SELECT rate_date, currency, base + day(rate_date) AS rate
                 FROM rate_days, (VALUES ('USD', 80), ('EUR', 90)) AS c(currency, base)),
       foreign_rows AS (SELECT transaction_id, amount, CAST("timestamp" AS DATE) AS transaction_date,
                        ['INR', 'USD', 'EUR', 'GBP'][1 + transaction_id % 4] AS currency
                 FROM transactions)
       SELECT d.currency, {day('transaction_date')} AS transaction_date, transaction_id, amount,
              {day('rate_date')} AS rate_known,
              CASE WHEN d.currency = 'INR' THEN amount
                   ELSE round_even(amount * rate * 100, 0) / 100 END AS amount_home
       FROM foreign_rows d ASOF LEFT JOIN day_rates r
            ON d.currency = r.currency AND d.transaction_date >= r.rate_date""",
)
add(
    "last_deposit_before",
    f"""WITH deposits AS (SELECT customer_id, "timestamp" AS at, max(transaction_id) AS deposit_id,
                                arg_max(amount, transaction_id) AS deposit_amount
                         FROM transactions WHERE transaction_type = 'DEPOSIT' GROUP BY 1, 2)
       SELECT transaction_id, t.customer_id, {second('t."timestamp"')} AS "timestamp",
              deposit_id, deposit_amount
       FROM transactions t ASOF LEFT JOIN deposits d
            ON t.customer_id = d.customer_id AND t."timestamp" >= d.at""",
)
add("branch_volume_ledger", _VOLUME)
_GIVEN = f"""WITH odds AS (
         SELECT *, 1 / (1 + exp(-(-4.0e0 + outstanding_balance * 4e-06 + interest_rate * 3e0
                + account_balance * -1e-07 + annual_income * -5e-07
                + loan_to_income_ratio * 0.25e0))) AS p FROM features),
       held AS (SELECT *, round_even(p * 1e9, 0) / 1e9 AS default_probability FROM odds),
       given AS (SELECT *, {below('default_probability', bands.RISK_RATINGS, 'Critical')}
                 AS risk_rating FROM held)
       """
add(
    "loan_scores_given",
    _GIVEN
    + f"""SELECT loan_id, customer_id, branch_id, loan_type, outstanding_balance, interest_rate,
              loan_to_income_ratio, default_probability, risk_rating,
              CASE WHEN risk_rating IN ('High', 'Critical') THEN 'Action Needed: Credit Review'
                   WHEN risk_rating = 'Moderate' THEN 'Monitor Performance'
                   ELSE 'Healthy Credit' END AS risk_action_recommendation,
              '{RUN}' AS ml_evaluated_at FROM given""",
)
add(
    "interventions_given",
    _GIVEN
    + """SELECT branch_id, loan_id, customer_id, outstanding_balance, default_probability
         FROM given WHERE risk_rating IN ('High', 'Critical')""",
)
add("monthly_revenue_refreshed", "SELECT * FROM revenue_months")


def _broken(condition: str, name: str) -> str:
    return f"CASE WHEN NOT coalesce({condition}, false) THEN '{name}' END"


def _refers(key: str, parent: str, gate: str) -> str:
    return (
        f"CASE WHEN {key} NOT IN (SELECT row_id FROM {gate}) THEN '{key} is not in {parent}' END, "
        f"CASE WHEN {key} IN (SELECT row_id FROM {gate}) AND {key} NOT IN"
        f" (SELECT row_id FROM {gate} WHERE violations = '')"
        f" THEN '{key} is rejected in {parent}' END"
    )


add(
    "cascade_gate",
    f"""WITH gate_c AS (SELECT 'customers' AS entity, CAST(customer_id AS BIGINT) AS row_id,
           concat_ws('; ', {_broken('account_balance >= 0', 'account_balance is negative')})
           AS violations FROM customers),
       gate_b AS (SELECT CAST(branch_id AS BIGINT) AS row_id, '' AS violations FROM branches),
       gate_l AS (SELECT 'loans' AS entity, CAST(loan_id AS BIGINT) AS row_id, concat_ws('; ',
           {_broken('interest_rate >= 0', 'interest_rate is negative')},
           {_broken('interest_rate <= 30', 'interest_rate is too high')},
           {_refers('customer_id', 'customers', 'gate_c')}) AS violations FROM loans),
       gate_r AS (SELECT 'revenue' AS entity, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS row_id,
           concat_ws('; ', {_refers('loan_id', 'loans', 'gate_l')}) AS violations
           FROM (SELECT *, l_orderkey AS loan_id FROM lineitem)),
       gate_t AS (SELECT 'transactions' AS entity, CAST(transaction_id AS BIGINT) AS row_id,
           concat_ws('; ', {_broken('amount > 0', 'amount is not positive')},
           {_refers('customer_id', 'customers', 'gate_c')},
           {_refers('branch_id', 'branches', 'gate_b')}) AS violations FROM transactions)
       SELECT * FROM (SELECT * FROM gate_c UNION ALL SELECT * FROM gate_l
                      UNION ALL SELECT * FROM gate_r UNION ALL SELECT * FROM gate_t)
       WHERE violations <> ''""",
)


def oracle_texts() -> dict[str, str]:
    """Each body behind the shared entity and mart definitions."""
    shared = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    texts = {}
    for name, body in BODIES.items():
        own = body.lstrip()
        if own.startswith("WITH "):
            texts[name] = f"WITH {shared},\n{own[5:]}"
        else:
            texts[name] = f"WITH {shared}\n{own}"
    return texts
