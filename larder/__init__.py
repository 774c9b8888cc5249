"""Sales-operations analytics expressed as PySpark DataFrame jobs."""
