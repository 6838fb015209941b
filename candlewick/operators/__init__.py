"""DataFrame operators: candles, per-symbol views, detection, alert engine, market views, metrics."""
