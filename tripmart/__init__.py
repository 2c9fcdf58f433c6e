"""Trip analytics on Spark: conform, star schema, windowed zone counts."""
