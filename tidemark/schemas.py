"""Fixed values and schemas shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# They must equal the payload format and the feature table this
# library is compatible with.
SUCCESS_CODE = "2000000100"
SELL_FIELD = "hargaJual"
BUY_FIELD = "hargaBeli"
TIME_FIELD = "lastUpdate"
REQUIRED_FIELDS = (SELL_FIELD, BUY_FIELD, TIME_FIELD)
CHECKED_RECORDS = 5

# Column order of the 24-feature table.
FEATURES = (
    "selling_price",
    "buying_price",
    "spread",
    "ma_short",
    "ma_long",
    "price_ma_ratio",
    "volatility",
    "roc",
    "bb_upper",
    "bb_lower",
    "bb_position",
    "rsi",
    "day_of_week",
    "month",
    "day_sin",
    "day_cos",
    "month_sin",
    "month_cos",
    "price_lag_1",
    "spread_lag_1",
    "price_lag_3",
    "spread_lag_3",
    "price_lag_7",
    "spread_lag_7",
)

# Features scaled to [0, 1]; every other one is standardised.
# Columns whose name contains one of the markers belong here too.
MINMAX_FEATURES = (
    "selling_price",
    "buying_price",
    "spread",
    "ma_short",
    "ma_long",
    "bb_upper",
    "bb_lower",
)
MINMAX_MARKERS = ("price_lag", "spread_lag")

# Metric names per category and the order of the short summary.
REGRESSION_METRICS = (
    "mae",
    "mse",
    "rmse",
    "mape",
    "smape",
    "mase",
    "r2",
    "explained_variance",
    "max_error",
    "directional_accuracy",
)
TRADING_METRICS = (
    "strategy_return",
    "buy_hold_return",
    "excess_return",
    "sharpe_ratio",
    "max_drawdown",
    "win_rate",
    "profit_factor",
    "calmar_ratio",
    "final_portfolio_value",
)
DIAGNOSTIC_METRICS = (
    "theil_u",
    "residual_autocorr",
    "forecast_bias",
    "tracking_signal",
    "mean_residual",
    "std_residual",
)
SUMMARY_ORDER = (
    "mae",
    "rmse",
    "mape",
    "r2",
    "directional_accuracy",
    "smape",
    "mase",
    "explained_variance",
    "max_error",
)
REGRESSION_PANEL = ("mse", "rmse", "mae", "mape", "r2")
TRADING_PANEL = ("sharpe_ratio", "max_drawdown", "win_rate", "profit_factor")

# One payload holds one price history. Scalars are strings, so that JSON numbers
# and JSON strings both load; records are maps, because validation asks whether
# a field is present, not whether it has a value.
RECORD_MAP = T.MapType(T.StringType(), T.StringType())
PAYLOAD = T.StructType(
    [
        T.StructField("responseCode", T.StringType()),
        T.StructField("data", T.StructType([T.StructField("priceList", T.ArrayType(RECORD_MAP))])),
    ]
)
