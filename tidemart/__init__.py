"""Order analytics on PySpark: ingest, clean, model, query, stream, check and serve order data."""
