"""Multi-channel commerce analytics on Spark: land, conform, model, reconcile, serve."""
