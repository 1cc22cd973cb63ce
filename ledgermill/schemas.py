"""Declared schemas and the fixed values shared by every layer.

Nothing is ever inferred: a CSV is read once, with the types given here. Date
columns of the text layer stay strings until the Silver step parses them, so a
bad date becomes a NULL the quality gate can see instead of a failed task.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

DEBIT_TYPES = ["WITHDRAWAL", "PAYMENT", "PURCHASE"]
CREDIT_TYPES = ["DEPOSIT", "TRANSFER"]
RISK_SEVERITY = ["Critical Risk", "High Risk", "Moderate Risk", "Low Risk"]

# revenue type -> product label
PRODUCT_OF_REVENUE = {
    "INTEREST_INCOME": "Loans Product",
    "ACCOUNT_MAINTENANCE_FEE": "Savings Accounts",
    "TRANSACTION_FEE": "Credit Cards",
    "LATE_FEE": "Investments Portal",
}
# product, share of revenue, share of costs
PRODUCT_SHARES = [
    ("Loans", 0.45, 0.30),
    ("Savings", 0.25, 0.25),
    ("Credit Cards", 0.20, 0.30),
    ("Investments", 0.10, 0.15),
]
# metro city -> branch
BRANCH_OF_CITY = {
    "MUMBAI": "BR_001",
    "DELHI": "BR_002",
    "BANGALORE": "BR_003",
    "CHENNAI": "BR_004",
    "KOLKATA": "BR_005",
    "HYDERABAD": "BR_006",
    "PUNE": "BR_007",
    "AHMEDABAD": "BR_008",
    "JAIPUR": "BR_009",
}
FALLBACK_BRANCHES = (10, 50)
SMALL_CATEGORIES = ["GROCERIES", "COFFEE", "TRANSPORT", "UTILITIES"]
MEDIUM_CATEGORIES = ["SHOPPING", "DINING", "ENTERTAINMENT", "SERVICES"]
LARGE_CATEGORIES = ["ELECTRONICS", "TRAVEL", "HOME_IMPROVEMENT", "EDUCATION"]
CURRENCY = "INR"
COUNTRY = "India"
RAW_ID_PREFIX = "KAGGLE_"
RAW_SOURCE_TAG = "kaggle_original"
CUSTOMER_SOURCE_TAG = "kaggle_enhanced"

# --- text layer -------------------------------------------------------------

CORRUPT = "_corrupt_record"

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """``"a string, b int"`` to a StructType, without needing a session."""
    fields = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("TransactionID", T.StringType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("CustomerDOB", T.StringType()),
        T.StructField("CustGender", T.StringType()),
        T.StructField("CustLocation", T.StringType()),
        T.StructField("CustAccountBalance", T.StringType()),
        T.StructField("TransactionDate", T.StringType()),
        T.StructField("TransactionTime", T.StringType()),
        T.StructField("TransactionAmount (INR)", T.StringType()),
    ]
)

ENTITIES: dict[str, T.StructType] = {
    "customers": _struct(
        "customer_id string, original_customer_id string, first_name string, last_name string,"
        "age int, gender string, city string, country string, account_balance double,"
        "customer_segment string, credit_score int, annual_income bigint, customer_since string,"
        "data_source string"
    ),
    "transactions": _struct(
        "transaction_id string, customer_id string, account_id string, amount double,"
        "transaction_type string, category string, merchant string, timestamp string,"
        "branch_id string, currency string, data_source string"
    ),
    "revenue": _struct(
        "revenue_id string, customer_id string, account_id string, revenue_type string,"
        "amount double, event_date string, branch_id string, description string"
    ),
    "costs": _struct(
        "cost_id string, branch_id string, cost_category string, amount double,"
        "cost_date string, description string, region string"
    ),
    "loans": _struct(
        "loan_id string, customer_id string, loan_amount double, outstanding_balance double,"
        "interest_rate double, loan_type string, start_date string, term_months int,"
        "status string, branch_id string"
    ),
    "branches": _struct(
        "branch_id string, branch_name string, city string, region string, country string,"
        "opening_date string, branch_manager string, staff_count int, monthly_operating_cost int"
    ),
}

PRIMARY_KEYS = {
    "customers": "customer_id",
    "transactions": "transaction_id",
    "revenue": "revenue_id",
    "costs": "cost_id",
    "loans": "loan_id",
    "branches": "branch_id",
}

# (child table, key column, parent table)
FOREIGN_KEYS = [
    ("transactions", "customer_id", "customers"),
    ("revenue", "customer_id", "customers"),
    ("loans", "customer_id", "customers"),
    ("transactions", "branch_id", "branches"),
    ("revenue", "branch_id", "branches"),
    ("loans", "branch_id", "branches"),
]

# --- event stream -----------------------------------------------------------

EVENT = _struct(
    "event_type string, transaction_id string, customer_id string, branch_id string,"
    "amount double, transaction_type string, interchange_fee_earned double,"
    "credit_score int, customer_segment string, initial_balance double, loan_id string,"
    "emi_amount double, status string, opening_date string, monthly_cost int,"
    "timestamp string"
)
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

# event type -> columns of its typed stream
EVENT_COLUMNS = {
    "CARD_TRANSACTION": [
        "transaction_id", "customer_id", "branch_id", "amount", "transaction_type",
        "interchange_fee_earned", "event_time",
    ],
    "CUSTOMER_ONBOARDED": [
        "customer_id", "credit_score", "customer_segment", "branch_id", "initial_balance",
        "event_time",
    ],
    "EMI_PAYMENT_EVENT": ["loan_id", "customer_id", "emi_amount", "status", "event_time"],
    "NEW_BRANCH_OPENED": ["branch_id", "opening_date", "monthly_cost", "event_time"],
}

# --- warehouse --------------------------------------------------------------

# Ratios are DECIMAL(12,4): a cost ratio above 9.9999 is ordinary and must load.
WAREHOUSE: dict[str, dict[str, str]] = {
    "customer_profitability": {
        "customer_id": "string",
        "customer_segment": "string",
        "total_revenue": "decimal(15,2)",
        "estimated_costs": "decimal(15,2)",
        "net_profit": "decimal(15,2)",
        "profit_margin": "decimal(12,4)",
        "kpi_date": "date",
    },
    "branch_performance": {
        "branch_id": "string",
        "total_revenue": "decimal(15,2)",
        "total_costs": "decimal(15,2)",
        "net_income": "decimal(15,2)",
        "cost_income_ratio": "decimal(12,4)",
        "transaction_count": "bigint",
        "transaction_per_staff": "decimal(15,2)",
        "kpi_date": "date",
    },
    "loan_portfolio": {
        "branch_id": "string",
        "total_loan_portfolio": "decimal(15,2)",
        "total_outstanding": "decimal(15,2)",
        "avg_interest_rate": "decimal(12,4)",
        "active_loans": "bigint",
        "kpi_date": "date",
    },
    "loan_risk_analytics": {
        "loan_id": "string",
        "customer_id": "string",
        "branch_id": "string",
        "loan_type": "string",
        "outstanding_balance": "decimal(15,2)",
        "interest_rate": "decimal(12,4)",
        "annual_income": "decimal(15,2)",
        "loan_to_income_ratio": "decimal(12,4)",
        "default_probability": "decimal(5,4)",
        "risk_rating": "string",
        "ml_evaluated_at": "timestamp",
    },
}
