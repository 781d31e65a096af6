"""Lists, lookup tables, constants and formats that decide results."""

# --- fixed values: vehicle reference data ------------------------------------------------------
CAR_MAKES = {
    "Toyota": ["Camry", "Corolla", "RAV4", "Highlander", "Prius"],
    "Honda": ["Civic", "Accord", "CR-V", "Pilot", "Odyssey"],
    "Ford": ["F-150", "Mustang", "Explorer", "Escape", "Bronco"],
    "BMW": ["3 Series", "5 Series", "X3", "X5", "M3"],
    "Mercedes": ["C-Class", "E-Class", "GLC", "GLE", "S-Class"],
    "Chevrolet": ["Silverado", "Malibu", "Equinox", "Tahoe", "Corvette"],
    "Tesla": ["Model 3", "Model Y", "Model S", "Model X"],
    "Nissan": ["Altima", "Rogue", "Sentra", "Pathfinder", "Maxima"],
}
BASE_PRICES = {
    "Toyota": 28000, "Honda": 27000, "Ford": 35000, "BMW": 55000,
    "Mercedes": 60000, "Chevrolet": 32000, "Tesla": 50000, "Nissan": 26000,
}
DEFAULT_BASE_PRICE = 30000
COLORS = ["Black", "White", "Silver", "Gray", "Blue", "Red", "Green", "Brown"]
ENGINE_SIZES = [1.5, 1.8, 2.0, 2.4, 2.5, 3.0, 3.5, 4.0, 5.0]
FUEL_TYPES = ["Gasoline", "Diesel", "Hybrid", "Electric"]
TRANSMISSIONS = ["Automatic", "Manual", "CVT"]
COVERAGE_TYPES = ["Basic", "Standard", "Premium", "Comprehensive"]
DEDUCTIBLES = [250, 500, 1000, 1500, 2000]
FUEL_WEIGHTS = [0.7, 0.1, 0.15, 0.05]
FUEL_WEIGHTS_LUXURY = [0.6, 0.15, 0.2, 0.05]
LUXURY_MAKES = ["BMW", "Mercedes"]
TRANSMISSION_WEIGHTS = [0.7, 0.15, 0.15]
FIRST_CAR_YEAR = 2010
DEPRECIATION_PER_YEAR = 0.85
KM_LIFETIME = 300000
KM_FACTOR_FLOOR = 0.5

# --- fixed values: people ----------------------------------------------------------------------
FIRST_NAMES = [
    "James", "Mary", "John", "Patricia", "Robert", "Jennifer", "Michael", "Linda",
    "William", "Elizabeth", "David", "Susan", "Richard", "Jessica", "Joseph", "Sarah",
]
LAST_NAMES = [
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis",
    "Rodriguez", "Martinez", "Wilson", "Anderson", "Taylor", "Thomas", "Moore", "Jackson",
]
GENDERS = ["M", "F"]
STATES = ["CA", "TX", "FL", "NY", "IL", "PA", "OH", "GA", "NC", "MI"]

# --- fixed values: rating factors --------------------------------------------------------------
BASE_PREMIUM = 800
MAKE_FACTORS = {
    "BMW": 1.3, "Mercedes": 1.35, "Tesla": 1.25, "Chevrolet": 1.05,
    "Ford": 1.1, "Toyota": 0.95, "Honda": 0.95, "Nissan": 1.0,
}
COVERAGE_FACTORS = {"Basic": 0.7, "Standard": 1.0, "Premium": 1.3, "Comprehensive": 1.6}
DEDUCTIBLE_FACTORS = {250: 1.2, 500: 1.1, 1000: 1.0, 1500: 0.9, 2000: 0.85}
PREMIUM_FLOOR = 400
PREMIUM_CEILING = 5000
YOUNG_AGE = 25
SENIOR_AGE = 65
CREDIT_TIERS = [(750, "Excellent"), (700, "Good"), (650, "Fair")]
LOWEST_CREDIT_TIER = "Poor"

# --- fixed values: defaults for keys without history and for missing request fields -------------
NEW_CLAIMS_HISTORY = 0
NEW_CREDIT_SCORE = 700
NEW_AVG_CLAIMS_PER_YEAR = 0.0
NEW_AVG_DEDUCTIBLE = 500
NEW_TOTAL_POLICIES = 0

# --- fixed values: column contract -------------------------------------------------------------
NUMERIC_COLS = [
    "car_age", "kilometers", "engine_size", "estimated_car_value", "age", "years_licensed",
    "claims_history", "credit_score", "risk_score", "avg_claims_per_year", "total_policies",
    "avg_car_age", "avg_kilometers", "total_car_value", "avg_deductible",
]
CATEGORICAL_COLS = [
    "car_make", "car_model", "fuel_type", "transmission", "coverage_type", "gender", "state",
]
MODEL_INPUT_COLS = NUMERIC_COLS + CATEGORICAL_COLS
ENCODED_COLS = [f"{c}_encoded" for c in CATEGORICAL_COLS]
MODEL_FEATURE_COLS = NUMERIC_COLS + ENCODED_COLS
LABEL_COL = "annual_premium"
PREDICTION_COL = "predicted_premium"
INTEGER_INPUT_COLS = [
    "car_age", "kilometers", "age", "years_licensed", "claims_history", "credit_score",
    "total_policies", "avg_kilometers", "avg_deductible",
]

REQUEST_DEFAULTS = {
    "car_age": 0, "kilometers": 0, "engine_size": 2.0, "estimated_car_value": 25000.0,
    "age": 30, "years_licensed": 10, "claims_history": 0, "credit_score": 700,
    "risk_score": 0.0, "avg_claims_per_year": 0.0, "total_policies": 0, "avg_car_age": 0.0,
    "avg_kilometers": 0, "total_car_value": 25000.0, "avg_deductible": 500,
    "car_make": "Toyota", "car_model": "Camry", "fuel_type": "Gasoline",
    "transmission": "Automatic", "coverage_type": "Standard", "gender": "M", "state": "CA",
}
REQUEST_FALLBACKS = {
    "avg_car_age": "car_age", "avg_kilometers": "kilometers", "total_car_value": "estimated_car_value",
}
MISSING_CLASS = "None"
NEW_CUSTOMER_TEXT = "New"

# --- fixed values: training, gate, retention, incremental job ----------------------------------
SEED = 42
TEST_FRACTION = 0.2
BOOSTING = {"rounds": 200, "depth": 6, "learning_rate": 0.1, "row_rate": 0.8, "column_rate": "0.8"}
GATE_METRIC = "test_r2"
GATE_THRESHOLD = 0.7
EXPIRY_DAYS = 7
WATERMARK_KEY = "TRANSFORM_TASK"
WATERMARK_START = "1970-01-01 00:00:00"
PROMOTE, ALERT = "promote_model", "send_alert"
ALERT_TYPE = "MODEL_QUALITY"

# --- messages of our own -----------------------------------------------------------------------
NOTHING_NEW_MESSAGE = "The log holds nothing after the mark."
PROGRESS_MESSAGE = "Processed {rows} rows; the mark is now {mark}"
ALERT_MESSAGE = "The gate turned {version} down ({metrics}); it stays a candidate until someone has looked at it."

# --- fixed values: display formats (Java date patterns) ----------------------------------------
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_FORMAT = "HH:mm:ss"
VERSION_FORMAT = "'v_'yyyyMMdd_HHmmss"
