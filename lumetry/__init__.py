"""Smart-meter and lamp telemetry summaries on Spark.

Every transform takes a DataFrame and returns a DataFrame, so the same function serves a batch table and a
Structured Streaming source.
"""
