"""Column functions and small grouped functions built from Spark built-ins."""
