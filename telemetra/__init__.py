"""Room-sensor telemetry analytics on PySpark: DataFrame in, DataFrame out."""
