"""Connected-vehicle telemetry on Spark: decode, type, join, upsert and deliver topic messages."""
