"""Fixed values that must equal the reference's for equal results.

These are configuration constants (limits, marker spellings, grids), written
out plainly in their natural order.
"""

# --- fixed values: monitoring limits -------------------------------------
WINDOW_HOURS = 24
MINIMUM_ROWS_FOR_DRIFT = 30
SYSTEM_LIMITS = {
    "max_error_rate_warning": 0.03,
    "max_error_rate_critical": 0.05,
    "min_availability_warning": 0.99,
    "min_availability_critical": 0.95,
    "max_p95_latency_ms_warning": 300.0,
    "max_p95_latency_ms_critical": 500.0,
}
DATA_LIMITS = {
    "psi_warning": 0.1,
    "psi_critical": 0.2,
    "js_warning": 0.05,
    "js_critical": 0.1,
}
MODEL_LIMITS = {
    "anomaly_rate_difference_warning": 0.03,
    "anomaly_rate_difference_critical": 0.05,
    "score_mean_shift_warning": 1.0,
    "score_mean_shift_critical": 2.0,
}
RETRAINING = {
    "performance_metric": "recall",
    "reference_performance": 0.6792,
    "maximum_relative_drop": 0.10,
}
# severity order: no_data = insufficient_data = stable < warning < critical
STATUS_RANK = {"no_data": 0, "insufficient_data": 0, "stable": 0, "warning": 1, "critical": 2}

# --- fixed values: histogram / PSI -----------------------------------------
PROFILE_BINS = 10          # quantile grid 0, 0.1, ..., 1 (11 points)
PSI_EPSILON = 1e-6

# --- fixed values: data-quality gate ---------------------------------------
MIN_ROWS = 10000
MIN_ROWS_PRODUCTION = 30
MAX_MISSING_RATE = 0.0
MAX_DUPLICATE_RATE = 0.0
MAX_LABEL_CONTRADICTION_RATE = 0.003
MISSING_MARKERS = ["", "?", "-", "--", "na", "n/a", "null", "none", "nan", "missing", "unknown"]
SCORING_BATCH_MAX = 1000

# --- fixed values: evaluation / ensembles ----------------------------------
MIN_RECALL = 0.70
ENSEMBLE_WEIGHTS = [(0.8, 0.2), (0.7, 0.3), (0.6, 0.4), (0.5, 0.5), (0.4, 0.6), (0.3, 0.7), (0.2, 0.8)]
CASCADE_GATES = [0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95]

# --- fixed values: shift-sensitivity grid ------------------------------------
SHIFT_FACTOR_MIN = 0.01
SHIFT_FACTOR_MAX = 2.0
SHIFT_FACTOR_COUNT = 400
