"""starloom: batch ETL jobs and analytical queries as PySpark DataFrame operators."""
