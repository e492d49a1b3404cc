"""dimflow: dimensional-warehouse building blocks as PySpark DataFrame operators."""
