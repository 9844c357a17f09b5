"""Software-delivery analytics on Spark."""
