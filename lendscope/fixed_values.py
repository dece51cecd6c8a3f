"""Values that must equal the published ones for results to agree.

Everything below is a fixed value: column names, labels, code lists, thresholds and
regulatory constants. Nothing here is derived.
"""

# --- Fixed values: borrower snapshot ---------------------------------------------------
SNAPSHOT_TARGET = "SeriousDlqin2yrs"
LATE_30 = "NumberOfTime30-59DaysPastDueNotWorse"
LATE_60 = "NumberOfTime60-89DaysPastDueNotWorse"
LATE_90 = "NumberOfTimes90DaysLate"
SNAPSHOT_UTILIZATION = "RevolvingUtilizationOfUnsecuredLines"
SNAPSHOT_LOG_COLUMNS = ("MonthlyIncome", "RevolvingUtilizationOfUnsecuredLines", "DebtRatio")
ARTIFACT_CODES = (96, 98)
MINIMUM_AGE = 18

# --- Fixed values: loan book -----------------------------------------------------------
LOAN_TARGET = "is_default"
LOAN_STATUS = "loan_status"
DEFAULT_STATUSES = ("Charged Off", "Default")
PAID_STATUSES = ("Fully Paid",)
LOAN_COLUMNS = (
    "loan_amnt", "int_rate", "annual_inc", "dti", "grade", "home_ownership", "delinq_2yrs",
    "revol_util", "open_acc", "pub_rec", "revol_bal", "installment", "sub_grade", "term",
    "emp_length", "purpose", "addr_state", "issue_d", "verification_status",
)
LOAN_NUMERIC_COLUMNS = (
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti",
    "delinq_2yrs", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
)
LOAN_PERCENT_COLUMNS = ("int_rate", "revol_util")
LOAN_LOG_COLUMNS = ("annual_inc", "revol_bal", "loan_amnt")
EMPLOYMENT_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}
UNKNOWN_EMPLOYMENT = -1
GRADE_ORDINALS = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7}
ISSUE_DATE_FORMAT = "MMM-yyyy"

# --- Fixed values: buckets (right-closed) ----------------------------------------------
BUCKET_LABELS = ("Low", "Medium", "High", "Very High")
UTILIZATION_EDGES = (30.0, 60.0, 90.0)
DTI_EDGES = (20.0, 35.0, 50.0)
FRACTION_SCALE_LIMIT = 2.0
DELINQUENCY_THRESHOLD = 1

# --- Fixed values: macro series --------------------------------------------------------
MACRO_SERIES = {
    "UNRATE": "unemployment_rate",
    "GDP": "gdp",
    "FEDFUNDS": "fed_funds_rate",
    "DRCCLACBS": "credit_card_delinq_rate",
}
MACRO_MEASURES = ("unemployment_rate", "gdp", "fed_funds_rate", "credit_card_delinq_rate")
DEFAULT_MACRO_QUARTER = (2009, 4)

# --- Fixed values: modelling -----------------------------------------------------------
NON_FEATURES = (
    "loan_id", "row_id", "Unnamed: 0", "issue_d", "issue_year", "issue_quarter",
    "RevolvingUtilizationOfUnsecuredLines_bucket", "revol_util_bucket", "dti_bucket",
    "grade", "emp_length", "home_ownership", "purpose",
)
SEED = 42
TEST_SHARE = 0.15
VALIDATION_SHARE_OF_REST = 0.1765
SMOTE_NEIGHBOURS = 5
EXPLAIN_SAMPLE = 500
SEQUENCE_LENGTH = 3

# --- Fixed values: expected loss -------------------------------------------------------
LGD = 0.45
FIXED_EAD = 15_000.0
RISK_GRADE_EDGES = (0.0, 0.05, 0.10, 0.20, 0.50, 1.0)
RISK_GRADES = ("A (Very Low)", "B (Low)", "C (Medium)", "D (High)", "E (Very High)")

# --- Fixed values: anomaly detection ---------------------------------------------------
CONTAMINATION = 0.01
ISOLATION_TREES = 100
ISOLATION_ROWS = 256
BOTTLENECK = 8

# --- Fixed values: reporting -----------------------------------------------------------
RATINGS = {
    "auc_roc": ((0.85, "Excellent"), (0.75, "Good"), (None, "Below Threshold")),
    "gini": ((0.65, "Excellent"), (None, "Acceptable")),
    "ks_statistic": ((0.40, "Excellent"), (0.20, "Acceptable"), (None, "Weak")),
}
RADAR_METRICS = {
    "auc_roc": "AUC-ROC", "gini": "Gini", "ks_statistic": "KS",
    "precision": "Precision", "recall": "Recall", "f1_score": "F1",
}

# --- Fixed values: star schema (table -> columns, in order) ----------------------------
STAR_TABLES = {
    "fact_loans": ("loan_id", "loan_amnt", "funded_amnt", "int_rate", "installment",
                   "is_default", "SeriousDlqin2yrs"),
    "dim_borrower": ("loan_id", "annual_inc", "dti", "delinq_2yrs", "revol_util", "open_acc",
                     "pub_rec", "age", "MonthlyIncome", "DebtRatio", "NumberOfDependents",
                     "RevolvingUtilizationOfUnsecuredLines", "emp_length_years"),
    "dim_loan_terms": ("loan_id", "grade", "sub_grade", "term", "purpose",
                       "verification_status", "grade_numeric"),
    "dim_geography": ("loan_id", "addr_state"),
    "dim_time": ("loan_id", "issue_date", "issue_year", "issue_quarter", "loan_vintage_months"),
    "dim_macro": ("loan_id", "unemployment_rate", "gdp", "fed_funds_rate",
                  "credit_card_delinq_rate"),
}
STAR_TABLES_JDBC = {
    "fact_loans": ("loan_id", "loan_amnt", "int_rate", "installment", "is_default",
                   "SeriousDlqin2yrs"),
    "dim_borrower": ("loan_id", "annual_inc", "dti", "delinq_2yrs", "revol_util", "open_acc",
                     "pub_rec", "age", "MonthlyIncome", "DebtRatio"),
    "dim_loan_terms": ("loan_id", "grade", "sub_grade", "term", "purpose"),
    "dim_geography": ("loan_id", "addr_state"),
    "dim_time": ("loan_id", "issue_year", "issue_quarter", "loan_vintage_months"),
    "dim_macro": ("loan_id", "unemployment_rate", "gdp", "fed_funds_rate",
                  "credit_card_delinq_rate"),
}

# --- Fixed values: file schemas (name type, in file order) -----------------------------
SNAPSHOT_FIELDS = (
    ("row_id", "int"), ("SeriousDlqin2yrs", "int"),
    ("RevolvingUtilizationOfUnsecuredLines", "double"), ("age", "int"),
    ("NumberOfTime30-59DaysPastDueNotWorse", "int"), ("DebtRatio", "double"),
    ("MonthlyIncome", "double"), ("NumberOfOpenCreditLinesAndLoans", "int"),
    ("NumberOfTimes90DaysLate", "int"), ("NumberRealEstateLoansOrLines", "int"),
    ("NumberOfTime60-89DaysPastDueNotWorse", "int"), ("NumberOfDependents", "double"),
)
LOAN_BOOK_FIELDS = (
    ("id", "bigint"), ("loan_amnt", "double"), ("funded_amnt", "double"), ("term", "string"),
    ("int_rate", "string"), ("installment", "double"), ("grade", "string"),
    ("sub_grade", "string"), ("emp_length", "string"), ("home_ownership", "string"),
    ("annual_inc", "double"), ("verification_status", "string"), ("issue_d", "string"),
    ("loan_status", "string"), ("purpose", "string"), ("addr_state", "string"),
    ("dti", "double"), ("delinq_2yrs", "double"), ("open_acc", "double"), ("pub_rec", "double"),
    ("revol_bal", "double"), ("revol_util", "string"), ("total_acc", "double"),
)
MONTHLY_FIELDS = (
    ("loan_seq_num", "string"), ("monthly_rpt_prd", "string"), ("current_upb", "double"),
    ("current_loan_delinq_status", "string"), ("loan_age", "int"),
    ("remaining_months_to_maturity", "int"), ("zero_balance_code", "string"),
    ("zero_balance_eff_date", "string"),
)
MACRO_FIELDS = (
    ("year", "int"), ("quarter", "int"), ("unemployment_rate", "double"), ("gdp", "double"),
    ("fed_funds_rate", "double"), ("credit_card_delinq_rate", "double"),
)
