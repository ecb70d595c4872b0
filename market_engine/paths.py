"""Where the layers live below a root folder."""

from __future__ import annotations

# Folder of each table per layer.
LAYERS = {
    "bronze": {"news_raw": "bronze/news/stock_news_api", "prices_raw": "bronze/yfinance_prices"},
    "silver": {"news_sentiment": "silver/news_sentiment_silver", "stock_prices": "silver/stock_prices_silver"},
    "gold": {"sentiment_price_daily": "gold/sentiment_prices/daily"},
}


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{LAYERS[layer][table]}"
