"""Web-archive corpus engine on PySpark: scan, map, and append crawl records."""
