"""Names, bands and thresholds the pipeline's results depend on.

FIXED VALUES — these must stay equal to the behaviour being reproduced, so they
are listed here plainly and in their natural order. Everything else in the
package takes them as default arguments, so a caller can override any of them.
"""

# --- fixed values: bands (upper bound is exclusive; the last label has no bound) ---
AGE_BANDS = ((25, "Young"), (45, "Adult"), (65, "Middle-aged"))
AGE_DEFAULT = "Senior"

AMOUNT_BANDS = ((100, "Small"), (500, "Medium"), (1000, "Large"))
AMOUNT_DEFAULT = "Very Large"

# --- fixed values: segments (strict ">" tests, first match wins) ---
# (label, total_spent greater than, total_orders greater than); None = no test
SEGMENT_RULES = (
    ("VIP", 5000, 10),
    ("High Value", 1000, 5),
    ("Regular", None, 3),
)
SEGMENT_DEFAULT = "New"

# --- fixed values: provenance literals ---
CUSTOMER_SOURCE = "customer_system"
SALES_SOURCE = "sales_system"
CUSTOMER_LINEAGE_JOB = "customer_data_etl"
CUSTOMER_JOB = "customer-data-etl"
SALES_JOB = "sales-data-etl"
QUALITY_JOB = "data-quality-check"
PROJECT_DEFAULT = "data-pipeline"
ENVIRONMENT_DEFAULT = "dev"

# --- fixed values: raw layout ---
CUSTOMERS_PREFIX = "customers/"
SALES_PREFIX = "sales/"
VALID_SUFFIX = ".csv"
DATE_FORMAT = "yyyy-MM-dd"

# --- fixed values: event shapes ---
FILE_EVENT_SOURCE = "aws.s3"
FILE_CREATED_DETAIL_TYPE = "Object Created"
SCHEDULE_SOURCE = "aws.events"
SCHEDULE_MARKER = "Scheduled Event"
JOB_EVENT_SOURCE = "aws.glue"
JOB_STATE_DETAIL_TYPE = "Glue Job State Change"
STATE_SUCCEEDED = "SUCCEEDED"
STATE_FAILED = "FAILED"
STATE_STARTED = "STARTED"
UNKNOWN_ERROR = "Unknown error"
FILE_TRIGGER = "S3_OBJECT_CREATED"

# --- fixed values: messages ---
VALID_FILE_MESSAGE = "File %s in bucket %s is valid."
INVALID_FILE_MESSAGE = "File %s in bucket %s is invalid or missing."

# --- our own defaults (not from the reference) ---
AMOUNT_TYPE = "decimal(18,2)"
# Raw amounts keep the digits the rules are tested on; clean rows have AMOUNT_TYPE.
RAW_AMOUNT_TYPE = "decimal(28,10)"
TOTAL_TYPE = "decimal(38,2)"
