"""Document adjudication analytics on PySpark."""
