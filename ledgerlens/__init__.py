"""Risk scoring and document retrieval as PySpark DataFrame operators."""
