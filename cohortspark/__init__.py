"""Clinical-cohort analytics on Spark: functions from DataFrame to DataFrame."""
