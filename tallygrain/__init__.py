"""tallygrain: categorisation-audit analytics expressed as lazy Spark DataFrame transforms."""
