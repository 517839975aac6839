"""Text analytics over dated, attributed speeches, written as Spark DataFrame operations."""
