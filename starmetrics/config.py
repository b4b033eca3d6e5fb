"""Run parameters of the model (test tables span 1995-01 … 2001-11)."""

# Temporal split (M-1), as yyyymm: train ≤ CUT_TRAIN < valid ≤ CUT_VALID < holdout.
CUT_TRAIN = 200012
CUT_VALID = 200105

# Smoothing weights of the historical rates (W-1 / W-2).
ALPHA_CUSTOMER = 25.0
ALPHA_PRODUCT = 40.0
ALPHA_CARRIER = 60.0
ALPHA_CUSTOMER_PRODUCT = 12.0
ALPHA_BRANCH = 80.0
ALPHA_DEPOT = 60.0

# Business thresholds.
SHELF_LIFE_ALERT_DAYS = 180
RETURN_RATE_CLIP = (0.0001, 0.6)
DISPROPORTION_RATIO = 2.2
RISK_BAND_QUANTILES = (0.60, 0.85, 0.95)
RISK_BANDS = ("Bajo", "Medio", "Alto", "Crítico")
PRIORITY_LABELS = ("4 - Baja", "3 - Media", "2 - Alta", "1 - Prioritaria")
COMMISSION_RATE = 0.0599
COMMISSION_TAX = 1.22

# Walk-forward scoring: the last month each model may see; it scores the months up to the next cut.
WALK_CUTS = (199712, 199912, 200012)
CALIBRATION_MONTHS = 5      # the last months before a cut calibrate, they are not fitted
EARLY_STOP_PCT = 12         # share of the fitted rows that only decides when to stop
FORECAST_RATE_MAX = 0.30    # clip of a projected return rate
OUTLOOK_MONTHS = 3          # months after the last data month in the multi-step outlook

# Rows of a dimension that the driver may collect for a broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000
# Aggregates that one plan of the measure graph may hold; of more, each is written before they meet.
PLAN_AGGREGATES = 8
