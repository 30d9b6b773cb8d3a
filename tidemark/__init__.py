"""Bank risk, compliance and customer analytics as Spark DataFrame functions."""
