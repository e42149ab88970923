"""Column lists and thresholds that define the default behaviour.

Every operator takes column names as arguments; these are only the defaults.
"""

# Columns of a sales line.
NUMERIC = ["sku", "units", "discount_pct", "amount", "receipt_id", "store", "gender"]
CODES = ["sku", "store", "receipt_id", "gender"]  # numbers that are really categories
MEASURES = [c for c in NUMERIC if c not in CODES]
CATEGORICAL = ["channel", "product", "customer_id", "customer_run", "sku", "store", "receipt_id", "gender"]
DATES = ["ts", "birth_date"]
TEXT = ["channel", "product", "first_name", "last_name", "customer_run", "customer_id"]
NULL_PROFILE_GROUPS = {"numeric": NUMERIC, "date": DATES, "text": TEXT}

# Columns derived from them.
DERIVED = ["amount_per_unit", "age", "hour", "purchase_freq", "recency_days", "gross_amount",
           "is_weekend", "amount_segment"]
DERIVED_NUMERIC = DERIVED[:6]
SCALED = ["amount_per_unit", "age", "recency_days", "gross_amount", "purchase_freq"]

# Column pairs examined together.
MISSINGNESS_TARGETS = ["discount_pct", "birth_date", "amount", "units", "customer_id"]
MISSINGNESS_PROBES = ["amount", "units", "sku", "discount_pct"]
ASSOCIATION_PAIRS = [("channel", "store"), ("channel", "gender"), ("amount_segment", "gender"),
                     ("is_weekend", "channel")]
DERIVED_PAIRS = [("age", "amount_per_unit"), ("age", "gross_amount"), ("age", "amount"),
                 ("recency_days", "purchase_freq"),
                 ("gross_amount", "amount_per_unit"), ("gross_amount", "amount"),
                 ("is_weekend", "amount_per_unit"), ("is_weekend", "amount"),
                 ("amount_segment", "amount_per_unit"), ("amount_segment", "gross_amount"),
                 ("amount_segment", "amount")]
ANOVA_VALUE = "amount"
ANOVA_FACTORS = ["channel", "store"]
CLUSTER_FEATURES = ["purchase_count", "amount_mean", "amount_sum", "discount_mean", "age_mean",
                    "recency_min", "amount_per_unit_mean"]

# Thresholds and fixed values.
REFERENCE_YEAR = 2026
DISCOUNT_RANGE = (0.0, 1.0)
AGE_RANGE = (12.0, 100.0)
GENDERS = [1.0, 2.0]
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# Texts of the reports.
NORMAL_NOT_REJECTED = "No se rechaza normalidad (p>0.05)"
NORMAL_REJECTED = "Rechazo de normalidad (p<=0.05)"
LEVEL_ABOVE, LEVEL_BELOW, LEVEL_SAME = "alto", "bajo", "similar"
PHRASE_FREQUENT = "Clientes frecuentes y de mayor valor."
PHRASE_INACTIVE = "Clientes menos activos con mayor recencia."
SEGMENT_LOW, SEGMENT_MIDDLE, SEGMENT_HIGH, SEGMENT_UNKNOWN = "Bajo", "Medio", "Alto", "Desconocido"
SEGMENT_PROBABILITIES = (0.33, 0.66)
IQR_FACTOR = 1.5
DROP_ROWS_UP_TO_PCT = 5.0
IMPUTE_UP_TO_PCT = 20.0
MISSINGNESS_SIGNAL = 0.1
ALPHA = 0.05
BLOCK_ROWS = 5_000
HEAD_ROWS = 50_000
TOP_FREQUENCIES = 20
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
CLUSTERS = 3
ELBOW_RANGE = range(2, 9)
KMEANS_STARTS = 10  # each start is itself chosen by several oversampling passes (k-means||)
SILHOUETTE_TOLERANCE = 1e-3  # of the silhouette in the segmentation's metrics
FITS_AT_ONCE = 8  # K-Means fits whose first centres are found side by side
VECTOR_BYTES = 8 << 20  # of a partition of the vectors that their first centres are drawn from
BLOCK_BYTES = 2 << 20  # of a partition of the blocks that all fits pass over together
SEED = 42


def present(df, columns):
    """The given columns that the frame has; absent optional columns are skipped everywhere."""
    have = set(df.columns)
    return [c for c in columns if c in have]


# What is left out where a stage's optional column is absent.
EXPECTED = {
    "features": {"units": "amount_per_unit", "amount": "amount_per_unit, amount_segment, gross_amount", "birth_date": "age", "ts": "hour, recency_days, is_weekend",
                 "customer_id": "purchase_freq", "receipt_id": "purchase_freq", "discount_pct": "gross_amount"},
    "association": {"channel": "channel x store, channel x gender, is_weekend x channel", "store": "channel x store", "gender": "channel x gender, amount_segment x gender"},
    "customers": {"amount": "amount_mean, amount_sum", "discount_pct": "discount_mean", "birth_date": "age_mean", "ts": "recency_min", "units": "amount_per_unit_mean"},
}


def missing(df, columns):
    """The expected columns that the frame lacks."""
    have = set(df.columns)
    return [c for c in columns if c not in have]
