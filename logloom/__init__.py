"""Log search and analytics on PySpark."""
