"""Default policies and constants.

FIXED VALUES — these must equal the account-risk project this library re-implements for its results
to agree; they are stated here plainly, in their natural order, and used as data everywhere else.
"""

from __future__ import annotations

# --- fixed values -------------------------------------------------------------------------------
# Reference "today" as an integer day serial.
TODAY = 18320

# Account-side column policy, in order.
ACCOUNT_ACTIONS = {
    "CANCEL_NO_CONTACT": "none",
    "IS_DIGITAL": "none",
    "ACCT_OPEN_DT": "turn_to_days",
    "AUM_AMT": "none",
    "DATE_OF_BIRTH": "none",
    "YEARLYINCOMELEVEL": "none",
    "CNTY_CD": "classify",
}
ACCOUNT_CLASSES = {
    "CNTY_CD": [[12]],
}
# Account-side null fills, in order.
ACCOUNT_FILLS = {
    "AUM_AMT": 50000,
    "IS_DIGITAL": 0,
    "DATE_OF_BIRTH": 20,
    "YEARLYINCOMELEVEL": 0,
    "CNTY_CD": 12,
    "CANCEL_NO_CONTACT": 0,
    "ACCT_OPEN_DT": 100,
}

# Transaction-side column policy, in order.
TXN_ACTIONS = {
    "CUST_ID": "drop",
    "TX_DATE": "turn_to_days",
    "TX_TIME": "classify",
    "DRCR": "one_hot_encode",
    "TX_AMT": "none",
    "PB_BAL": "none",
    "OWN_TRANS_ACCT": "drop",
    "OWN_TRANS_ID": "classify",
    "CHANNEL_CODE": "classify",
    "TRN_CODE": "classify",
    "BRANCH_NO": "drop",
    "EMP_NO": "drop",
    "mb_check": "none",
    "eb_check": "none",
    "SAME_NUMBER_IP": "none",
    "SAME_NUMBER_UUID": "none",
    "DAY_OF_WEEK": "classify",
}
TXN_CLASSES = {
    "TX_TIME": [[0, 1, 2, 3, 4, 5, 6, 20, 21, 22, 23]],
    "OWN_TRANS_ID": [["ID99999"]],
    "DAY_OF_WEEK": [["Saturday", "Sunday"]],
    "TRN_CODE": [
        [1, 4, 7, 8, 21, 29, 30, 24, 25, 26, 27, 28, 36, 37, 38],
        [2, 3, 5, 10, 11, 12, 13, 14, 15, 16, 17, 20, 22, 23, 42, 44],
        [8, 9, 19, 52, 53, 54],
        [31, 32, 33, 34, 35, 39, 40, 45, 46, 47, 48, 49, 50],
        [6, 16, 41, 43, 51],
    ],
    "CHANNEL_CODE": [[13, 14, 15, 16, 17, 18], [5, 6, 9, 12], [1, 2, 3, 4, 8, 10], [7, 11, 19]],
}

# Per-account aggregate of the date column when an account has one transaction; fill for accounts without any.
TEMPO_SINGLE = 30
# Amount bands: (1, 500], (500, 100000], (100000, inf) -> small, medium, large.
AMOUNT_CUTS = (1.0, 500.0, 100000.0)
AMOUNT_BANDS = ("small", "medium", "large")
# Transactions spread into columns per account.
TOP_K = 5
# Placeholder for missing text before label encoding.
UNKNOWN_TEXT = "UNKNOWN"

# Risk levels of a probability, right-closed bins (0, 0.3], (0.3, 0.6], (0.6, 1.0].
RISK_CUTS = (0.0, 0.3, 0.6, 1.0)
RISK_LEVELS = ("Low", "Medium", "High")
# Dashboard risk levels of a score: >= 0.75 high, >= 0.5 medium, else low.
SCORE_HIGH = 0.75
SCORE_MEDIUM = 0.5
# Decision thresholds: default, answer-sheet threshold.
THRESHOLD_DEFAULT = 0.5
THRESHOLD_SHEET = 0.6
# Threshold sweep 0.10, 0.15, ... 0.85 (sixteen values).
SWEEP_START, SWEEP_STEP, SWEEP_COUNT = 0.10, 0.05, 16
# Splits and sampling.
TEST_SHARE = 0.2
SEED = 42
N_FOLDS = 5
BATCH_SIZE = 32
PAGE_SIZE = 10
HEAD_ROWS = 500
TOP_FEATURES = 10
TOP_ATTRIBUTIONS = 5
# Transaction-gap value for the first transaction of an account.
FIRST_GAP = -30
# Focal loss: gamma, class weights, label smoothing.
FOCAL_GAMMA = 1.5
FOCAL_WEIGHTS = (1.0, 7.0)
FOCAL_SMOOTHING = 0.1
# Sequence importance: small constant in the min-max divisor.
IMPORTANCE_EPS = 1e-6
# Boosting: rounds, step, row and column sampling; the leaf count maps to depth 5.
GBT_PARAMS = {"maxIter": 1000, "stepSize": 0.05, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.9"}
# Rounds of each cross-validation fold.
CV_ROUNDS = 100
# Early stopping: folds, rounds in a row without gain, rounds to begin with.
EARLY_FOLDS, EARLY_PATIENCE, EARLY_START = 3, 3, 16
# Depth of a forest's trees (without a limit in the original; Spark's trees end at 30).
FOREST_DEPTH = 30
# Search space (step, row sampling, column sampling, depth, rounds), trials, and how many run at a time.
TUNE_SPACE = {
    "stepSize": (0.1, 0.7),
    "subsamplingRate": (0.75, 0.95),
    "featureSubsetStrategy": (0.7, 0.9),
    "maxDepth": (3, 15),
    "maxIter": (100, 500),
}
TUNE_TRIALS, TUNE_PARALLEL = 50, 10
# Of so many trials of a rung one goes on.
TUNE_KEEP = 4
# Neighbours of a row of the smaller class that synthetic rows lie between.
SMOTE_K = 5
# Columns of small whole numbers (0 to n - 1) of the transactions: hours, and codes that fit 63 bits.
PROFILE_DOMAINS = {"TX_TIME": 24, "CHANNEL_CODE": 63, "TRN_CODE": 63}
# Columns of the account profile, in order.
PROFILE_COLUMNS = (
    "CANCEL_NO_CONTACT", "IS_DIGITAL", "AUM_AMT", "YEARLYINCOMELEVEL", "TX_COUNT", "TX_SUM", "TX_MEAN", "TX_STD", "TX_MAX",
    "TX_MIN", "AVG_PB_BAL", "MAX_PB_BAL", "MIN_PB_BAL", "MODE_TX_TIME", "UNIQUE_CHANNELS", "UNIQUE_TRN_CODES",
    "SUM_MB_CHECK", "SUM_EB_CHECK", "FLAG_SAME_IP", "FLAG_SAME_UUID", "IS_WEEKEND", "ACCOUNT_AGE", "AGE",
)
# --- end of fixed values ------------------------------------------------------------------------
