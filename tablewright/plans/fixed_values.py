"""Names, word lists, limits, patterns and formats that results depend on.

Everything here is data, and the operators take these values as parameters. Column lists of
tables are next to the code that builds them.
"""

# ---------------------------------------------------------------- ingest (fixed values)
LANDING_GLOBS = {
    "customers": "customers_*.csv",
    "claims": "claims_*.json",
    "policy": "policy.csv",
    "sales": "*[Ss]ales*.csv",
    "cars": "cars.csv",
}
SOURCE_FILE = "_source_file"
LOAD_TIMESTAMP = "_load_timestamp"
RESCUED = "_rescued_data"

# ---------------------------------------------------------------- customers (fixed values)
CUSTOMER_VARIANTS = {
    "customer_id": ["CustomerID", "Customer_ID", "cust_id"],
    "region": ["Region", "Reg"],
    "city": ["City", "City_in_state"],
    "marital": ["Marital", "Marital_status"],
    "education": ["Education", "Edu"],
}
# Columns that each customer file has, by file, and those that all have.
CUSTOMER_HEADERS = {
    "customers_1": ["CustomerID", "Reg", "City", "Marital_status", "Education", "HHInsurance"],
    "customers_2": ["Customer_ID", "Region", "City_in_state", "Job", "Edu"],
    "customers_3": ["cust_id", "Region", "City", "Job", "Marital", "Education", "HHInsurance"],
    "customers_4": ["CustomerID", "Region", "City", "Job", "Marital", "HHInsurance"],
    "customers_5": ["CustomerID", "Region", "City", "Job", "Marital", "Education",
                    "HHInsurance"],
    "customers_6": ["CustomerID", "Region", "City", "Job", "Marital_status", "Education",
                    "HHInsurance"],
    "customers_7": ["CustomerID", "Region", "City", "Job", "Marital", "Education",
                    "HHInsurance"],
}
CUSTOMER_COMMON = ["State", "Default", "Balance", "CarLoan"]
REGION_CODES = {"E": "East", "W": "West", "C": "Central", "S": "South"}
MARITAL_VALUES = ["single", "married", "divorced"]
EDUCATION_VALUES = ["primary", "secondary", "tertiary", "NA"]
EDUCATION_TYPOS = {"terto": "tertiary"}
MASTER_SOURCE = "customers_7"

# ---------------------------------------------------------------- sentinels, patterns (fixed values)
AMOUNT_SENTINELS = ["NULL", ""]
UNKNOWN_SENTINELS = ["?"]
NUMBER_PATTERN = r"([\d.]+)"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
DATE_FORMAT = "yyyy-MM-dd"
MINUTE_FORMAT = "dd-MM-yyyy HH:mm"

# ---------------------------------------------------------------- row rules (fixed values)
# (rule name, column, predicate that a good row satisfies, reason when it does not)
CUSTOMER_RULES = [
    ("valid_customer_id", "customer_id", "customer_id IS NOT NULL", "null customer_id"),
    ("valid_region", "region",
     "region IN ('East','West','Central','South','North')", "invalid region: {value}"),
    ("valid_marital", "marital",
     "marital IN ('single','married','divorced') OR marital IS NULL", "invalid marital"),
    ("valid_education", "education",
     "education IN ('primary','secondary','tertiary','NA') OR education IS NULL",
     "invalid education"),
]
CLAIM_RULES = [
    ("valid_claim_id", "claim_id", "claim_id IS NOT NULL", "null claim_id"),
    ("valid_policy_id", "policy_id", "policy_id IS NOT NULL", "null policy_id"),
    ("valid_rejected", "claim_rejected", "claim_rejected IN ('Y','N')",
     "invalid claim_rejected"),
    ("valid_injury", "injury_amount", "injury_amount IS NOT NULL",
     "injury not castable to float"),
    ("valid_property", "property_amount", "property_amount IS NOT NULL",
     "property not castable to float"),
]
POLICY_RULES = [
    ("valid_policy_number", "policy_number", "policy_number IS NOT NULL",
     "null policy_number"),
    ("valid_customer_id", "customer_id", "customer_id IS NOT NULL", "null customer_id"),
    ("valid_car_id", "car_id", "car_id IS NOT NULL", "null car_id"),
    ("valid_premium", "policy_annual_premium", "policy_annual_premium > 0",
     "invalid premium"),
    ("valid_umbrella", "umbrella_limit", "umbrella_limit >= 0", "negative umbrella_limit"),
]
SALES_RULES = [
    ("valid_sales_id", "sales_id", "sales_id IS NOT NULL", "null sales_id"),
    ("valid_ad_placed", "ad_placed_on", "ad_placed_on IS NOT NULL", "null ad_placed_on"),
    ("valid_car_id", "car_id", "car_id IS NOT NULL", "null car_id"),
]
CAR_RULES = [
    ("valid_car_id", "car_id", "car_id IS NOT NULL", "null car_id"),
    ("valid_seats", "seats", "seats > 0", "invalid seats"),
]

# ---------------------------------------------------------------- coverage tiers (fixed values)
CSL_TIERS = {"100/300": "Low", "250/500": "Medium", "500/1000": "High"}
CSL_TIER_DEFAULT = "Unknown"

# ---------------------------------------------------------------- calendar (fixed values)
CALENDAR_START = "2010-01-01"
CALENDAR_DAYS = 4018
DATE_KEY_FORMAT = "yyyyMMdd"
WEEKEND_DAYS = [1, 7]

# ---------------------------------------------------------------- claim scoring (fixed values)
AMOUNT_MEAN = 12652.40
AMOUNT_STD = 10743.84
AMOUNT_P95 = 35665.0
SCORE_CAP = 100
SCORE_TIERS = [(40, "HIGH"), (20, "MEDIUM")]
SCORE_TIER_DEFAULT = "LOW"
FLAGGED_TIERS = ["HIGH", "MEDIUM"]
# rule name -> ordered (predicate, points); the first predicate that holds gives the points
SCORE_RULES = [
    ("HIGH_AMOUNT", [
        ("amount_zscore > 2.0", 30),
        ("amount_zscore > 1.5", 20),
        ("amount_zscore > 1.0", 10),
    ]),
    ("SEVERITY_MISMATCH", [
        ("incident_severity = 'Trivial Damage' AND total_claim_amount > amount_mean", 25),
        ("incident_severity = 'Minor Damage' AND total_claim_amount > amount_p95", 20),
    ]),
    ("MISSING_DOCUMENTATION", [
        ("property_damage = 'YES' AND police_report_available IS NULL", 20),
        ("property_damage = 'YES' AND police_report_available = 'NO'", 15),
        ("authorities_contacted = 'None'", 10),
    ]),
    ("NO_WITNESSES_MULTI_VEHICLE", [
        ("number_of_vehicles_involved >= 3 AND witnesses = 0", 15),
        ("number_of_vehicles_involved >= 3 AND witnesses = 1", 8),
    ]),
    ("INJURY_WITHOUT_PROPERTY", [
        ("bodily_injuries = 2 AND (property_damage = 'NO' OR property_damage IS NULL)", 10),
        ("bodily_injuries >= 1 AND property_damage = 'NO' AND vehicle_amount IS NULL", 10),
    ]),
]

# ------------------------------------- columns of each customer file (fixed values; None: it has none)
CUSTOMER_COLUMNS: dict[str, dict[str, str | None]] = {
    "customers_1": {"id": "CustomerID", "region": "Reg", "city": "City", "education": "Education"},
    "customers_2": {"id": "Customer_ID", "region": "Region", "city": "City_in_state",
                    "education": "Edu"},
    "customers_3": {"id": "cust_id", "region": "Region", "city": "City", "education": "Education"},
    "customers_4": {"id": "CustomerID", "region": "Region", "city": "City", "education": None},
    "customers_5": {"id": "CustomerID", "region": "Region", "city": "City", "education": "Education"},
    "customers_6": {"id": "CustomerID", "region": "Region", "city": "City", "education": "Education"},
    "customers_7": {"id": "CustomerID", "region": "Region", "city": "City", "education": "Education"},
}

# ---------------------------------------------------------------- generation, retrieval (fixed values)
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATUS_NOT_FLAGGED = "not_flagged"
ERROR_PREFIX = "ERROR: "
TOP_K = 5
SCORE_FORMAT = "%.4f"
QUERY_TYPES = ["specific_lookup", "comparative", "filter_based", "deductible_inquiry",
               "coverage_tier"]
