"""Input schema and the fixed label values the results must carry."""

from pyspark.sql.types import (DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampType)

SESSION_SCHEMA = StructType([
    StructField("user_id", StringType(), True),
    StructField("session_duration", IntegerType(), True),
    StructField("pages_viewed", IntegerType(), True),
    StructField("product_category", StringType(), True),
    StructField("purchase_amount", DoubleType(), True),
    StructField("review_score", DoubleType(), True),
    StructField("review_text", StringType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("device_type", StringType(), True),
    StructField("country", StringType(), True),
    StructField("city", StringType(), True),
])

SESSION_COLUMNS = [f.name for f in SESSION_SCHEMA.fields]

# --- Fixed values: labels, word classes and thresholds that must equal the
# --- reference's output verbatim (French labels included).
SESSION_SHORT = "Courte"
SESSION_MEDIUM = "Moyenne"
SESSION_LONG = "Longue"

REVIEW_NEGATIVE = "Négatif"
REVIEW_NEUTRAL = "Neutre"
REVIEW_POSITIVE = "Positif"
REVIEW_UNRATED = "Non évalué"

SEGMENT_NON_BUYER = "Non-acheteur"
SEGMENT_ONE_TIME = "One-time buyer"
SEGMENT_REPEAT = "Repeat customer"
SEGMENT_LOYAL = "Loyal customer"
SEGMENT_UNKNOWN = "Unknown"

RFM_CHAMPIONS = "Champions"
RFM_LOYAL = "Loyal Customers"
RFM_RECENT = "Recent Customers"
RFM_FREQUENT = "Frequent Customers"
RFM_BIG_SPENDERS = "Big Spenders"
RFM_POTENTIAL = "Potential Loyalists"
RFM_AT_RISK = "At Risk"
RFM_ABOUT_TO_SLEEP = "About to Sleep"
RFM_NEED_ATTENTION = "Need Attention"
RFM_LOST = "Lost"

WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
            "Saturday", "Sunday"]

# Letters kept by the review tokenizer (everything else is stripped before
# splitting on whitespace); tokens must be longer than 2 characters.
TOKEN_LETTERS = "a-zéèêëàâäôöùûüÿçœ"
TOKEN_MIN_LENGTH = 3

# Numeric columns of the correlation matrix, in the reference's order.
CORRELATION_COLUMNS = ["session_duration", "pages_viewed", "purchase_amount",
                       "review_score", "has_purchased"]

# Columns summarised by the descriptive statistics.
DESCRIBE_COLUMNS = ["session_duration", "pages_viewed", "purchase_amount",
                    "review_score"]

# IQR fence multiplier and the approximate-quantile relative error.
IQR_FENCE = 1.5
QUANTILE_REL_ERROR = 0.05
RFM_QUINTILES = [0.2, 0.4, 0.6, 0.8]

# Minimum sessions for a pages_viewed bucket to appear in the dashboard.
PAGES_MIN_SESSIONS = 50
