"""Click analytics on PySpark: landing, hourly counts, unique visitors, serving."""
