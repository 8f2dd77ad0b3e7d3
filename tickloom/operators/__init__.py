"""DataFrame operators over ticks and candles."""
