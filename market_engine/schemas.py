"""Column names and types of each layer."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(columns: dict[str, object], required: tuple[str, ...] = ()) -> StructType:
    return StructType([StructField(name, kind, name not in required) for name, kind in columns.items()])


STRING, DOUBLE, DATE, TIMESTAMP = StringType(), DoubleType(), DateType(), TimestampType()

BARS_BRONZE = _struct(
    {
        "symbol": STRING,
        "date": STRING,
        "open": DOUBLE,
        "high": DOUBLE,
        "low": DOUBLE,
        "close": DOUBLE,
        "volume": LongType(),
    }
)

TICKERS = _struct({"ticker": STRING, "company_name": STRING, "abbrev1": STRING, "abbrev2": STRING})

QUOTES = _struct(
    {
        "open": ArrayType(DOUBLE),
        "high": ArrayType(DOUBLE),
        "low": ArrayType(DOUBLE),
        "close": ArrayType(DOUBLE),
        "volume": ArrayType(LongType()),
    }
)
CHART = _struct(
    {
        "chart": _struct(
            {
                "result": ArrayType(
                    _struct(
                        {
                            "timestamp": ArrayType(LongType()),
                            "indicators": _struct({"quote": ArrayType(QUOTES)}),
                        }
                    )
                ),
                "error": _struct({"code": STRING, "description": STRING}),
            }
        )
    }
)
NEWS_PAYLOAD = _struct(
    {
        "data": ArrayType(
            _struct(
                {
                    "title": STRING,
                    "text": STRING,
                    "date": STRING,
                    "url": STRING,
                    "news_url": STRING,
                    "sentiment": STRING,
                    "source": STRING,
                    "topics": ArrayType(STRING),
                }
            )
        ),
        "message": STRING,
    }
)

# The Silver tables as their consumers expect them.
FLAGS = ("is_doji", "is_hammer", "is_bullish_engulfing", "is_bearish_engulfing")
PRICE_COLUMNS = (
    "open", "high", "low", "close", "volume", "prev_close", "price_change", "price_change_pct", "sma_5", "sma_10",
    "sma_20", "sma_50", "ema_5", "ema_10", "ema_20", "ema_50", "daily_range", "daily_range_pct", "volatility_5d",
    "volatility_10d", "volatility_20d", "volume_sma_5", "volume_sma_10", "volume_sma_20", "volume_ratio",
    "vwap_cumulative", "vwap_20d", "rsi_14", "momentum_5d", "momentum_5d_pct", "momentum_20d", "momentum_20d_pct",
    "bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_percent_b", "macd", "macd_signal", "macd_histogram",
    "log_return", "cumulative_return", "sharpe_ratio_20d", "sharpe_ratio_60d", "drawdown", "drawdown_pct",
    "is_doji", "is_hammer", "is_bullish_engulfing", "is_bearish_engulfing", "price_position", "support_20d",
    "resistance_20d", "distance_to_support_20d", "distance_to_resistance_20d", "support_50d", "resistance_50d",
    "distance_to_support_50d", "distance_to_resistance_50d",
)
SILVER_PRICES = _struct(
    {
        "ticker": STRING,
        "date": DATE,
        "date_key": DATE,
        **{name: IntegerType() if name in FLAGS else DOUBLE for name in PRICE_COLUMNS},
        "ingestion_timestamp": TIMESTAMP,
    },
    required=("ticker", "date", "date_key", "close"),
)

SILVER_NEWS = _struct(
    {
        "ticker": STRING,
        "company_name": STRING,
        "date_key": DATE,
        "article_date": DATE,
        "query_date_parsed": DATE,
        "title": STRING,
        "text": STRING,
        "url": STRING,
        "search_source": STRING,
        "endpoint_used": STRING,
        "finbert_score": DOUBLE,
        "finbert_label": STRING,
        "vader_compound": DOUBLE,
        "vader_pos": DOUBLE,
        "vader_neu": DOUBLE,
        "vader_neg": DOUBLE,
        "ingestion_timestamp": TIMESTAMP,
        "sentiment_timestamp": TIMESTAMP,
        "data_source": STRING,
    },
    required=("ticker", "date_key", "title"),
)
