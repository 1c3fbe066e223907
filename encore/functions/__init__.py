"""Column builders. Every one is a composition of built-in Spark expressions."""
