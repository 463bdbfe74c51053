"""Urban sensor and city-service analytics on Spark."""
