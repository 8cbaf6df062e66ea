"""Small Spark ML recipes."""
