"""Texts, patterns and constants that results must equal."""

# --- fixed values: timestamp formats -------------------------------------
ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PLAIN_SECONDS = "yyyy-MM-dd HH:mm:ss"
LENIENT_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mmXXX",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm",
]

# --- fixed values: patterns ----------------------------------------------
CATEGORY_PATTERN = r"Category: (.+?)\n"
PREDICTED_PATTERN = r"Predicted Quantity: ([\d.]+)"
ACTUAL_PATTERN = r"Actual Quantity: ([\d.]+|N/A)"
BATCH_PATTERN = r"B(\d+)$"

# --- fixed values: labels ------------------------------------------------
ALL = "All"
NOT_AVAILABLE = "N/A"
UNKNOWN = "Unknown"
NUMERICAL = "numerical"
PIPELINE = "pipeline"
PIPELINE_ANOMALY = "Pipeline Quantity Anomaly"
ML_ANOMALY = "ML Quantity Anomaly"
RECORD_METHOD = "Isolation Forest (quantity, price)"
MODEL_ARIMA = "ARIMA"
MODEL_BOOSTED = "XGBoost"
MODEL_FOREST = "Isolation Forest"
MODEL_TREND = "Prophet"

# --- fixed values: notification lines ------------------------------------
HEADLINE = "⚠️ Anomaly Detected in Inventory!"
NUMERICAL_CLOSING = (
    "This unusual quantity may indicate an inventory issue. Investigate immediately!"
)
PIPELINE_CLOSING = "This anomaly may indicate an inventory issue. Investigate immediately!"

# --- fixed values: answers to questions, first match wins ----------------
ANSWERS = [
    (
        "inventory issue",
        "The anomaly suggests a potential inventory issue. Check stock levels and recent "
        "transactions for the affected store location.",
    ),
    (
        "price",
        "The anomaly indicates an unusual price. Verify pricing data and check for errors "
        "or promotions.",
    ),
    (
        "quantity",
        "The anomaly indicates an unusual quantity. Investigate stock levels and recent "
        "sales for the product.",
    ),
    (
        "next steps",
        "Recommended next steps: 1) Investigate the affected store location or product. "
        "2) Verify data accuracy. 3) Adjust inventory or pricing as needed.",
    ),
]
DEFAULT_ANSWER = (
    "I'm not sure how to respond to that query. Try asking about 'inventory issue', "
    "'price', 'quantity', or 'next steps'."
)

# --- fixed values: drill-down domains ------------------------------------
DRILL_STORES = ["Store_A", "Store_B", "Store_C", "Store_D"]
DRILL_CATEGORIES = ["Electronics", "Clothing", "Groceries", "Books"]

# --- fixed values: numbers -----------------------------------------------
MOVING_ROWS = 5
TURNOVER_EPSILON = 1e-10
Z_THRESHOLD = 1.5
HORIZON_DAYS = 7
RECORD_CONTAMINATION = 0.05
GROUP_CONTAMINATION = 0.3
BASELINE_CONTAMINATION = 0.1
SEED = 42
OUTLIER_SHARE = 0.05
OUTLIER_QUANTITY = 1000
OUTLIER_PRICE = 5000.0
