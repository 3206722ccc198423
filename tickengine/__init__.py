"""tickengine: market-tick processing on Spark (ticks -> late drop -> OHLCV candles -> store, history, feed)."""

__version__ = "0.1.0"
