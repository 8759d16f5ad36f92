"""DataFrame operators the table builds need and Spark has no single call for."""
