"""Fixed values that decide results, kept together so that they are easy to review."""

# --- fixed values: cleaning -------------------------------------------------------------------
MIN_MINUTES = 1.0          # inclusive
MAX_MINUTES = 60.0         # inclusive
FIRST_ZONE = 1
LAST_ZONE = 265

# --- fixed values: month arithmetic, in months before the run date ------------------------------
TRAIN_LAG_MONTHS = 4
VALIDATION_LAG_MONTHS = 3
DATA_LAG_MONTHS = 24

# --- fixed values: scoring ------------------------------------------------------------------------
DEFAULT_ZONE = "1"
DEFAULT_DISTANCE = 1.0
DEFAULT_MINUTES = 15.0
GENERATED_ID_PREFIX = "ride_"
GENERATED_ID_TIME = "yyyyMMdd_HHmmss_SSSSSS"
PREDICTION_ROOT = "predictions"
PREDICTION_DAY = "yyyy/MM/dd"

# --- fixed values: trip envelopes -----------------------------------------------------------------
ENVELOPE_TYPE = "taxi_trip_request"
ENVELOPE_ID_PREFIX = "trip_"
EVENT_HASH_CHARACTERS = 16
UNKNOWN_ZONE = "unknown"
MISSING_FIELD = "Missing required field: {}"
MISSING_DATA_FIELD = "Missing required data field: {}"
REQUIRED_ENVELOPE_FIELDS = ("event_id", "event_type", "timestamp", "data")
REQUIRED_DATA_FIELDS = ("pickup_location_id", "dropoff_location_id")
NUMERIC_DATA_FIELDS = ("passenger_count", "trip_distance", "duration_minutes", "total_amount")

# --- fixed values: previews, samples --------------------------------------------------------------
PREVIEW_CHARACTERS = 1000
PREVIEW_ROWS = 5
RECENT_RECORDS = 10
LISTED_PREDICTIONS = 5
SAMPLE_SEED = 42

# --- fixed values: training -----------------------------------------------------------------------
BOOSTING_ROUNDS = 30
TREE_DEPTH = 30
LEARNING_RATE = 0.09585355369315604
MODEL_SEED = 42
RMSE_LIMIT = 10.0
CHILD_WEIGHT = 1.060597050922164   # with squared error every row weighs 1
L1 = 0.018060244040060163
L2 = 0.011658731377413597

# Training would end after so many rounds without a lower validation error.
PATIENCE_ROUNDS = 50
