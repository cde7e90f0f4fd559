"""Fleet-telemetry analytics on Spark: a date-partitioned lake and the queries over it."""
