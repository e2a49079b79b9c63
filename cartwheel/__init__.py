"""Weekly retail purchase-propensity analytics as Spark DataFrame jobs."""
