"""One fixed schema per table; every reader enforces it."""

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_S, _I, _L, _D, _B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
)

INVENTORY = _table(
    product_id=_S, quantity=_I, price=_D, event_timestamp=_S, store_location=_S, category=_S
)

LABELLED_INVENTORY = T.StructType(INVENTORY.fields + [T.StructField("is_anomaly", _B, True)])

# CSV exports name the store column ``store_id`` and put the timestamp first.
INVENTORY_CSV = _table(
    event_timestamp=_S, product_id=_S, quantity=_I, price=_D, store_id=_S, category=_S
)

METRICS = _table(
    product_id=_S,
    store_location=_S,
    category=_S,
    event_timestamp=_S,
    total_quantity=_L,
    avg_price=_D,
    total_stock_value=_D,
    moving_avg_stock_value=_D,
    turnover_rate=_D,
    stock_value_by_category=_D,
)

FORECASTS = _table(
    model_name=_S,
    store_location=_S,
    category=_S,
    forecast_timestamp=_S,
    predicted_quantity=_D,
    actual_quantity=_L,
    event_timestamp=_S,
)

ANOMALIES = _table(
    model_name=_S,
    store_location=_S,
    category=_S,
    event_timestamp=_S,
    anomaly_type=_S,
    method=_S,
    predicted_quantity=_D,
    actual_quantity=_L,
    score=_D,
    description=_S,
)

RECORD_ANOMALIES = T.StructType(
    INVENTORY.fields
    + [T.StructField("is_anomaly", _B, True), T.StructField("anomaly_method", _S, True)]
)

NOTIFICATIONS = _table(
    type=_S, notification=_S, store_location=_S, event_timestamp=_S, product_id=_S, category=_S
)

# Identity of one stock event, and of one metrics row.
EVENT_KEY = ["product_id", "event_timestamp", "store_location"]
METRIC_KEY = ["event_timestamp", "store_location", "category", "product_id"]
FORECAST_KEY = ["model_name", "store_location", "category", "forecast_timestamp"]
