"""assetlake: equipment telemetry analytics as Spark DataFrame functions."""
