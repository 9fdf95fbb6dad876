"""Vehicle telemetry analytics on Spark."""
