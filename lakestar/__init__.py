"""lakestar: paged API records to a star schema, as PySpark DataFrame operators."""
