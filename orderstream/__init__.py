"""Order-stream analytics on PySpark: clean, extract, locate, report."""
