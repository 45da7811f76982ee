"""Document analytics on PySpark: keyspaces, scans, mutations, change streams and search as DataFrame operations."""
