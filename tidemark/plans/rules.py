"""Fixed values of the credit tables: layouts, bounds and category lists.

These must equal the stored tables' definitions for results to agree.
"""

# --- raw layouts -----------------------------------------------------------

ATTRIBUTE_COLUMNS = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]

CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]
CLICKSTREAM_COLUMNS = [*CLICK_FEATURES, "Customer_ID", "snapshot_date"]

FINANCIAL_TYPES = {
    "Customer_ID": "string",
    "Annual_Income": "float",
    "Monthly_Inhand_Salary": "float",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "float",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "float",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "float",
    "Credit_Utilization_Ratio": "float",
    "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "float",
    "snapshot_date": "date",
}

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

RAW_LAYOUTS = {
    "attributes": ATTRIBUTE_COLUMNS,
    "clickstream": CLICKSTREAM_COLUMNS,
    "financials": list(FINANCIAL_TYPES),
    "lms": list(LOAN_TYPES),
}

# --- cleaning --------------------------------------------------------------

AGE_RANGE = (16, 100)
SSN_PATTERN = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
OCCUPATION_SENTINELS = ["", "-", "^_+$"]
CREDIT_MIX_SENTINELS = ["_", ""]
LOAN_TYPE_SENTINELS = ["", "_", "Not Specified"]

AGE_BANDS = [(25, "young"), (40, "middle_25_40"), (60, "mature_40_60")]
AGE_BAND_DEFAULT = "seniors"

OCCUPATION_GROUPS = {
    "professional": ["Doctor", "Lawyer", "Engineer"],
    "education_media": ["Teacher", "Journalist"],
    "business": ["Manager", "Entrepreneur"],
    "technical": ["Mechanic", "Accountant"],
}

PAYMENT_BEHAVIOURS = [
    "High_spent_Large_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Large_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
]

# Numeric text whose underscores are noise, except here, where they make it null.
KEEPS_UNDERSCORES = ["Num_Credit_Inquiries"]

# Closed ranges; None leaves the side open.  Values outside become null.
FINANCIAL_RANGES = {
    "Annual_Income": (0, 1000000),
    "Monthly_Inhand_Salary": (0, None),
    "Num_Bank_Accounts": (0, 10),
    "Num_Credit_Card": (0, 15),
    "Interest_Rate": (0, 50),
    "Num_of_Loan": (0, 20),
    "Delay_from_due_date": (0, 365),
    "Num_of_Delayed_Payment": (0, 100),
    "Num_Credit_Inquiries": (0, 50),
    "Outstanding_Debt": (0, 50000),
    "Credit_Utilization_Ratio": (0, None),
    "Total_EMI_per_month": (0, 10000),
    "Amount_invested_monthly": (0, 10000),
    "Monthly_Balance": (-10000, 100000),
}

UTILISATION_BANDS = [
    (90, "critical"),
    (70, "very_high"),
    (50, "high"),
    (30, "moderate"),
    (10, "low"),
]
UTILISATION_DEFAULT = "very_low"

# --- validation ------------------------------------------------------------

# Null rates in percent: accepted below the first, failed at the second.
ACCEPTED_NULLS = {"Num_Credit_Inquiries": (10.0, 100.0)}

ACCEPTED_BOUNDS = {
    "Num_of_Loan": (0, 20),
    "Num_of_Delayed_Payment": (0, 100),
    "Annual_Income": (0, 1000000),
    "Amount_invested_monthly": (0, 10000),
    "Monthly_Balance": (-10000, 100000),
    "Outstanding_Debt": (0, 50000),
    "Delay_from_due_date": (0, 365),
}

SANITY_BOUNDS = {
    "Monthly_Balance": (-1e10, 1e10),
    "Annual_Income": (0, 10000000),
    "Num_of_Loan": (0, 1000),
    "Num_of_Delayed_Payment": (0, 1000),
}

# --- scores ----------------------------------------------------------------

RISK_EDGES = [0.0, 0.3, 0.7, 1.0]
RISK_NAMES = ["Low Risk", "Medium Risk", "High Risk"]

# --- gold ------------------------------------------------------------------

FEATURE_STORE_DROPPED = [
    "Name", "SSN", "SSN_is_valid", "SSN_clean", "Occupation", "age_group",
    "Monthly_Inhand_Salary", "Credit_History_Age", "credit_risk_level",
]
