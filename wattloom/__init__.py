"""Sensor and energy analytics on PySpark: rollups, baselines, detectors, forecasts, keyed stores."""
