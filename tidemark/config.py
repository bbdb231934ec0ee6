"""Fixed values that must equal the reference's for identical results
(thresholds, horizons, weights, formats, report texts), in natural order."""

# --- fixed values -----------------------------------------------------------
MIN_PRICE = 1e-3                      # closes at or below count as missing
LOG_RETURN_HORIZONS = (1, 3, 5)       # trading-row horizons of the log returns
MAX_LOG_RETURN_HORIZON = 5
PIVOTED_FEATURES = ("close", "high", "low", "open", "volume")
TARGET_METRICS = ("log_return_1d", "log_return_3d", "log_return_5d",
                  "zscore_1d", "rank_1d", "direction_1d")
INFERENCE_METRICS = ("zscore_1d", "rank_1d", "direction_1d",
                     "log_return_1d", "log_return_3d", "log_return_5d")

CONFLICT_THRESHOLD_LOW = 0.05
CONFLICT_THRESHOLD_HIGH = 0.15
EXTREME_THRESHOLD = 0.5
NEUTRAL_THRESHOLD = 0.1
PREVENT_DIV_BY_ZERO = 1e-9
TOKENIZER_MAX_LENGTH = 512
LAG_DAYS = 5

AGGREGATED_METRICS = (
    "count_articles", "mean_sentiment", "median_sentiment", "pct_positive",
    "pct_negative", "polarity_ratio", "weighted_mean_sentiment",
    "extreme_sentiment_share", "sentiment_skewness", "sentiment_kurtosis",
    "neutral_share", "max_sentiment", "min_sentiment",
    "article_length_variance", "ratio_pos_neg", "conflict_share",
)

WINDOW_SIZE = 30
BATCH_SIZE = 32
EPOCHS = 50
VALIDATION_MAX_RATIO = 0.2
VALIDATION_TO_WINDOW_RATIO = 2.0
TARGET_SCALE = 1000.0
TARGET_SCALE_CLIP_FACTOR = 10.0
HUBER_DELTA = 0.1
LOSS_WEIGHTS = (("zscore_1d", 1.0), ("rank_1d", 0.3), ("direction_1d", 0.3),
                ("log_return_1d", 0.05), ("log_return_3d", 0.05),
                ("log_return_5d", 0.05))
TOP_GAINERS_COUNT = 10
WATCHED_SYMBOLS = "goog,msft,tsla"
START_DATE = "1999-11-01"
PARTIAL_FILE_LIMIT = 1
DEFAULT_COMPRESSION_LEVEL = 1
CONSOLIDATED_COMPRESSION_LEVEL = 3
RUN_TS_FORMAT = "yyyyMMdd'T'HHmmss"
PILLAR_NEWS = "pillar/news"
SYMBOL_NOT_FOUND_CODE = 1001
SYMBOL_ALIASES = (("FI", "FISV"),)    # ticker renames, matched case-insensitively
SYMBOL_DOT_ESCAPE = "%25sl%25"        # '.' in a ticker is sent as this
US_DATE_FORMAT = "MM/dd/yyyy"
COMPARISON_HEADER = ("Symbol   z_p     z_a     r_p     r_a     d_p d_a lr1_p    lr1_a    "
                     "lr3_p    lr3_a    lr5_p    lr5_a")
# ---------------------------------------------------------------------------

# Engine-side layout (ours, not the reference's): symbols in one block of wide
# columns, or of one packed per-date array; any number of symbols makes blocks.
SYMBOL_BLOCK = 1_000
