"""Customer-preference analytics over a table of retail purchases, on Spark."""
