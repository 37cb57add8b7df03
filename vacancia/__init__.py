"""Job-posting analytics on PySpark: landing, cleaning, marts, matching, retrieval."""
