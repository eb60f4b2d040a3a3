"""Column helpers built from Spark functions only."""
