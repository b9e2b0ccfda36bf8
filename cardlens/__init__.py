"""Card-payment risk analytics on Spark."""
